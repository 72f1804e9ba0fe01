"""Record-wise projections, filters, resume and order."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.commits import decode_offset_keys, decode_offset_values
from tidelog.functions.names import parse_topic_map, target_topics
from tidelog.operators.ordering import number_records
from tidelog.schema import DEFAULT_MAX_RECORDS, HEADERS_DDL, LOG_COLUMNS, TOPIC_PARTITION
from tidelog.session import join_null_safe, small_side

KEYS = list(TOPIC_PARTITION)


def to_envelope(df: DataFrame) -> DataFrame:
    """Any record table (such as the Kafka source's) to the log columns."""
    have = dict(df.dtypes)
    stamp = F.col("timestamp")
    if have["timestamp"] in ("timestamp", "timestamp_ntz"):
        stamp = F.unix_millis(stamp.cast("timestamp"))
    headers = F.col("headers") if "headers" in have else F.lit(None)
    return df.select(
        F.col("topic").cast("string").alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        stamp.cast("bigint").alias("timestamp"),
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        headers.cast(HEADERS_DDL).alias("headers"),
    )


def encode_nulls(df: DataFrame) -> DataFrame:
    """NULL key and value to empty bytes, as in old files."""
    return df.withColumns({c: F.coalesce(c, F.lit(b"")) for c in ("key", "value")})


def decode_nulls(df: DataFrame) -> DataFrame:
    """Empty key and value of old files to NULL."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(b"")) for c in ("key", "value")})


def _topics(topics) -> list[str]:
    return [t.strip() for t in topics.split(",") if t.strip()] if isinstance(topics, str) else list(topics)


def select_topics(df: DataFrame, topics) -> DataFrame:
    """Records of the topics of a comma-separated text or a list."""
    return df.filter(F.col("topic").isin(_topics(topics)))


def union_topics(*parts: DataFrame) -> DataFrame:
    """Several logs as one."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rename_topics(df: DataFrame, mapping) -> DataFrame:
    """Target topic names. ``mapping`` is text ``a:b,c``, a dict, or rows (source_topic, target_topic).

    Topics without a mapping keep their name; a topic with several targets goes to each of them.
    An option text becomes a literal map, without a join.
    """
    if isinstance(mapping, DataFrame):
        renamed = df.join(
            small_side(mapping.select(F.col("source_topic").alias("topic"), "target_topic")), "topic", "left"
        )
        return renamed.withColumn("topic", F.coalesce("target_topic", "topic")).select(*df.columns)
    targets = parse_topic_map(mapping) if isinstance(mapping, str) else {s: [t] for s, t in mapping.items()}
    names = target_topics("topic", targets)
    single = all(len(t) == 1 for t in targets.values())
    return df.withColumn("topic", F.get(names, F.lit(0)) if single else F.explode(names))


def exclude_group(df: DataFrame, group: str) -> DataFrame:
    """Drop offset-log records of ``group`` (any case) whose key and value decode; keep all others."""
    decoded = decode_offset_values(decode_offset_keys(df))
    named = F.lower("offset_key.group") == group.lower()
    return decoded.filter(~F.coalesce(named & F.col("offset_value").isNotNull(), F.lit(False))).select(*df.columns)


def valid_offset_records(df: DataFrame) -> DataFrame:
    """Decoded offset records that name a partition of a topic."""
    # one condition on the whole struct, so that the key is decoded once
    return df.filter(F.exists(F.array("offset_key"), lambda k: (k["partition"] > -1) & (k["topic"] != "")))


def resume_after(df: DataFrame, positions: DataFrame, keys=TOPIC_PARTITION) -> DataFrame:
    """Records above the last restored offset of their topic-partition; all, where none is known."""
    last = small_side(positions.select(*keys, "last_offset"))
    return (
        join_null_safe(df, last, keys, "left")
        .filter("last_offset IS NULL OR offset > last_offset")
        .select(*df.columns)
    )


def dedupe_log(df: DataFrame) -> DataFrame:
    """One record per coordinate. For a stream see ``streaming.jobs.stream_dedupe_sink``, which forgets nothing."""
    if df.isStreaming:
        raise ValueError("a stream is deduplicated by tidelog.streaming.jobs.stream_dedupe_sink")
    return df.dropDuplicates([*KEYS, "offset"])


def poll_batches(df: DataFrame, max_records: int = DEFAULT_MAX_RECORDS) -> DataFrame:
    """Add ``poll``: 0 for the first ``max_records`` records by topic, partition and offset, 1 for the next ones, and so on."""
    numbered = number_records(df, out="_rn")
    sizes = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_size"))
    # one row per topic-partition, of which a cluster has some hundred thousand at most
    earlier = Window.orderBy(*KEYS).rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*KEYS, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    joined = join_null_safe(numbered, F.broadcast(base), KEYS)
    return joined.withColumn("poll", F.expr(f"(_base + _rn - 1) div {max_records}")).drop("_rn", "_base")


def batch_cap(df: DataFrame, max_records: int = DEFAULT_MAX_RECORDS) -> DataFrame:
    """The first poll alone: lowest topic first, then lowest partition, then lowest offset."""
    return df.orderBy(*KEYS, "offset").limit(max_records)


def restore_order(df: DataFrame) -> DataFrame:
    """Offset order inside each topic-partition.

    A range sort: a topic-partition that holds much of the log is spread over several tasks by
    offset, and reading the tasks in order replays it.
    """
    return df.orderBy(*KEYS, "offset")


def log_columns(df: DataFrame) -> DataFrame:
    return df.select(*LOG_COLUMNS)
