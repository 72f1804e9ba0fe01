"""Key-compacted topics: latest record per key, generations, coordination events, progress marks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.greedy import greedy_starts
from tidelog.schema import (
    ACTIVATE,
    COORDINATION_SCHEMA,
    DEFAULT_CYCLE_HOURS,
    DEFAULT_MARK_EVERY,
    PASSIVATE,
    TOPIC_PARTITION,
)

KEYS = list(TOPIC_PARTITION)


def latest_per_key(df: DataFrame, drop_tombstones: bool = True) -> DataFrame:
    """Last record of every key of a topic-partition; a last record without a value removes the key.

    Records without a key are all kept. Map tasks reduce every key before the shuffle, so a hot
    key costs one row per map task.
    """
    # the last offset of every key is found on narrow rows, whose buffers are numbers; records are then picked by offset
    ends = df.filter("key IS NOT NULL").groupBy(*KEYS, "key").agg(F.max("offset").alias("offset")).select(*KEYS, "offset")
    live = F.col("value").isNotNull() if drop_tombstones else F.lit(True)
    place = [*KEYS, "offset"]
    keyed = df.filter(F.col("key").isNotNull() & live).join(ends, place, "left_semi").dropDuplicates(place)
    return keyed.unionByName(df.filter(F.col("key").isNull() & live).dropDuplicates(place)).select(*df.columns)


def record_id() -> Column:
    """What a compacted log keeps one record of: a key of a topic-partition, or a record without a key (128 bits)."""
    key = F.coalesce(F.concat(F.lit("k"), F.hex("key")), F.concat(F.lit("o"), F.col("offset").cast("string")))
    return F.md5(F.concat(F.length("topic").cast("string"), F.lit(":"), "topic", F.lit("/"), F.col("partition").cast("string"), F.lit("/"), key))


def put_run(records: DataFrame, name: str, path: str, buckets: int, placed: bool = False) -> None:
    """Write compacted records as the table ``name`` at ``path``: a run per bucket, sorted by ``record_id``.

    Records without a key have ids of their own, so they are spread like all others. ``placed``: the records are those of
    ``merged_run``, whose tasks hold a bucket each.
    """
    rows = records if placed else records.withColumn("id", record_id()).repartition(buckets, "id")
    rows.write.option("path", path).bucketBy(buckets, "id").sortBy("id").saveAsTable(name)


def merged_run(base: DataFrame, delta: DataFrame, buckets: int) -> DataFrame:
    """The records of ``base`` (a table of ``put_run``, with as many buckets) after those of ``delta``, with their ``id``.

    Only the delta is shuffled, at last its last record of every key: the base lies in the buckets that the join asks for,
    and the result does, too. A tombstone removes the key, and is not remembered: deltas have to come in the order of offsets.
    """
    last = latest_per_key(delta, drop_tombstones=False).withColumn("id", record_id())
    # the last record by offset wins, also where an old part of the log comes again
    fresh = last.select(F.col("id"), F.struct(*delta.columns).alias("_new")).repartition(buckets, "id")
    old = base.select("id", F.struct(*delta.columns).alias("_old"))
    newer = F.col("_old").isNull() | (F.col("_new.offset") >= F.col("_old.offset"))
    both = old.join(fresh.hint("merge"), "id", "full").select("id", F.when(newer & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old")).alias("_last"))
    return both.select("id", "_last.*").filter("value IS NOT NULL")


def apply_events(
    state: DataFrame | None,
    events: DataFrame,
    event: str | None = None,
    topic: str | None = None,
    order: str = "log_offset",
) -> DataFrame:
    """Current coordination event per key, after ``events`` (with their log position in ``order``).

    A row without an event deletes the key. Events of another type, another topic (any case) or of
    a partition other than the key's are ignored: they neither replace nor delete. Keys match in
    any case. ``state`` is an earlier result.
    """
    if event is not None and event not in (ACTIVATE, PASSIVATE):
        raise ValueError(f"unknown event {event!r}")
    rows = events if state is None else events.unionByName(state)
    matches = F.col("partition") == F.regexp_extract("key", r"-(\d+)$", 1).try_cast("int")
    if event is not None:
        matches &= F.col("event") == event
    if topic is not None:
        matches &= F.lower("topic") == topic.lower()
    relevant = rows.filter(F.col("event").isNull() | matches)
    return (
        relevant.groupBy(F.lower("key").alias("_key"))
        .agg(F.max_by(F.struct(*rows.columns), order).alias("_last"))
        .select("_last.*")
        .filter("event IS NOT NULL")
    )


def caught_up(progress: DataFrame, targets: DataFrame) -> DataFrame:
    """Per topic: have all announced partitions been written up to their target offset?

    ``progress`` holds written records or positions, ``targets`` (topic, partition, offset).
    """
    written = progress.groupBy(*KEYS).agg(F.max("offset").alias("_written"))
    reached = F.coalesce(F.col("_written") >= F.col("target"), F.lit(False))
    return (
        targets.select(*KEYS, F.col("offset").alias("target"))
        .join(written, KEYS, "left")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.count_if(reached).alias("reached"),
            F.bool_and(reached).alias("complete"),
        )
    )


def progress_marks(
    df: DataFrame, mark_every: int = DEFAULT_MARK_EVERY, announced: DataFrame | None = None, span: int | None = None
) -> DataFrame:
    """Offsets to announce: the first, then each that exceeds the last announced by more than ``mark_every``.

    ``announced`` (topic, partition, offset) continues from earlier announcements.
    """
    begun = None if announced is None else announced.select(*KEYS, F.col("offset").alias("start"))
    return greedy_starts(df, "offset", mark_every + 1, resume=begun, span=span)


def peer_name(instance: str, initial_status: str = ACTIVATE) -> str:
    """Name of the other instance of a pair: the part after the last dash is replaced."""
    stem, dash, _ = instance.rpartition("-")
    if not dash:
        raise ValueError(f"instance name {instance!r} has no dash")
    return f"{stem}-{(PASSIVATE if initial_status == ACTIVATE else ACTIVATE).lower()}"


def coordination_events(
    df: DataFrame, instance: str, event: str, now_ms, initial_status: str = ACTIVATE
) -> DataFrame:
    """One event per row (topic, partition, offset), addressed to the peer instance."""
    if event not in (ACTIVATE, PASSIVATE):
        raise ValueError(f"unknown event {event!r}")
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    key = F.concat(F.lit(peer_name(instance, initial_status) + "-"), F.col("partition").cast("string"))
    row = df.withColumns(
        {"key": key, "event": F.lit(event), "connectorInstanceName": key, "timestamp": now.cast("bigint")}
    )
    return row.select(*COORDINATION_SCHEMA.fieldNames())


def generation_due(manifest: DataFrame, now: Column, cycle_hours: int = DEFAULT_CYCLE_HOURS) -> DataFrame:
    """Per topic: is the newest generation older than the cycle?  ``manifest``: (topic, generation, started_at)."""
    newest = manifest.groupBy("topic").agg(
        F.max_by("generation", "started_at").alias("generation"), F.max("started_at").alias("started_at")
    )
    next_start = F.col("started_at") + F.make_interval(hours=F.lit(cycle_hours))
    return newest.withColumn("due", now > next_start)


def live_generation(manifest: DataFrame) -> DataFrame:
    """Per topic, the generation promoted last. ``manifest``: (topic, generation, promoted_at)."""
    return manifest.groupBy("topic").agg(F.max_by("generation", "promoted_at").alias("generation"))
