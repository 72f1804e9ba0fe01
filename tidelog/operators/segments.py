"""Cutting a log into segments (backup files) and describing them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.names import segment_name
from tidelog.operators.greedy import greedy_starts
from tidelog.operators.ordering import BLOCK, number_records, running_max
from tidelog.schema import OFFSET_PAD_WIDTH, TOPIC_PARTITION
from tidelog.session import checkpointed

KEYS = list(TOPIC_PARTITION)


def segment_by_count(df: DataFrame, flush_size: int, block: int = BLOCK) -> DataFrame:
    """New segment after every ``flush_size`` records of a topic-partition (records, not offsets)."""
    numbered = number_records(df, out="_rn", block=block)
    return numbered.withColumn("segment_id", F.expr(f"(_rn - 1) div {flush_size}")).drop("_rn")


def schedule_bucket(clock, schedule_ms: int, timezone: str = "UTC") -> Column:
    """Start (epoch ms) of the rotation interval that holds ``clock``, counted from local midnight."""
    t = F.col(clock) if isinstance(clock, str) else clock
    day_ms = 86_400_000
    local = F.unix_millis(F.from_utc_timestamp(F.timestamp_millis(t), timezone))
    midnight = (F.floor(local / day_ms) * day_ms).cast("bigint")
    start = F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(midnight), timezone))
    return start + (t - start) - F.pmod(t - start, F.lit(schedule_ms))


def segment_by_schedule(
    df: DataFrame, schedule_ms: int, timezone: str = "UTC", clock: str = "timestamp"
) -> DataFrame:
    """Segments that end at fixed clock times aligned to local midnight. A projection, no shuffle."""
    return df.withColumn("segment_id", schedule_bucket(clock, schedule_ms, timezone))


def arrival_clock(df: DataFrame, clock: str = "timestamp", out: str = "arrival", block: int = BLOCK) -> DataFrame:
    """Add a clock that never goes back along the offsets: the latest ``clock`` seen so far."""
    return running_max(df, F.col(clock), out=out, block=block)


def segment_by_interval(
    df: DataFrame, interval_ms: int, clock: str = "timestamp", block: int = BLOCK, span: int | None = None
) -> DataFrame:
    """A segment ends when a record arrives ``interval_ms`` or more after its first record.

    ``segment_id`` is the arrival time of the segment's first record.
    """
    # one row per arrival time, with its first record, and one row per segment: both are read twice,
    # hence the checkpoints
    ticks = checkpointed(
        arrival_clock(df.select(*KEYS, "offset", clock), clock, "_arrival", block)
        .filter("_arrival IS NOT NULL")
        .groupBy(*KEYS, "_arrival")
        .agg(F.min("offset").alias("offset"))
    )
    starts = checkpointed(greedy_starts(ticks, "_arrival", interval_ms, extra="offset", span=span))
    # starts join the records as extra rows at their offsets: no join that could meet a hot key
    marked = df.withColumn("_start", F.lit(None).cast("bigint")).unionByName(
        starts.withColumnRenamed("_arrival", "_start"), allowMissingColumns=True
    ).withColumn("_added", F.col("_start").isNotNull())
    filled = running_max(marked, F.col("_start"), out="segment_id", block=block)
    return filled.filter("NOT _added").drop("_start", "_added")


def segment(
    df: DataFrame,
    flush_size: int,
    schedule_ms: int | None = None,
    timezone: str = "UTC",
    clock: str = "timestamp",
    monotone: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Rotate by count or by schedule, whichever comes first; either one restarts the count.

    Records without a clock before the first one that has it are cut by count alone, in segments ``none-…``.

    ``monotone=True`` promises that the clock never goes back along the offsets, which saves the
    pass that computes the arrival clock.
    """
    if schedule_ms is None or schedule_ms <= 0:
        return segment_by_count(df, flush_size, block).withColumn(
            "segment_id", F.concat(F.lit("all-"), F.col("segment_id"))
        )
    timed = df.withColumn("_arrival", F.col(clock)) if monotone else arrival_clock(df, clock, "_arrival", block)
    bucket = F.coalesce(schedule_bucket("_arrival", schedule_ms, timezone).cast("string"), F.lit("none"))
    bucketed = timed.withColumn("_bucket", bucket)
    numbered = number_records(bucketed, keys=[*KEYS, "_bucket"], out="_rn", block=block)
    part = F.expr(f"(_rn - 1) div {flush_size}")
    return numbered.withColumn("segment_id", F.concat_ws("-", F.col("_bucket"), part)).drop(
        "_arrival", "_bucket", "_rn"
    )


def segment_manifest(df: DataFrame, generation: str | None = None, pad: int = OFFSET_PAD_WIDTH) -> DataFrame:
    """One row per segment: offsets, record count, last timestamp and file name."""
    return (
        df.groupBy(*KEYS, "segment_id")
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count(F.lit(1)).alias("records"),
            F.max_by("timestamp", "offset").alias("last_timestamp"),
            F.max("timestamp").alias("max_timestamp"),
        )
        .withColumn(
            "name",
            segment_name(
                "topic", "partition", "first_offset", None if generation is None else F.lit(generation), pad
            ),
        )
    )


def commit_offsets(
    manifest: DataFrame,
    flush_size: int,
    schedule_ms: int | None = None,
    now_ms=None,
    timezone: str = "UTC",
) -> DataFrame:
    """Offset to commit per topic-partition: last offset of the closed segments + 1, NULL if none is.

    Every segment but the newest is closed. The newest one is closed if it is full, or, given a
    schedule and the time, if a rotation has passed since its last record: an idle segment is not
    kept open.
    """
    def closed(records, max_timestamp):
        full = F.col(records) >= flush_size
        if not schedule_ms or now_ms is None:
            return full
        now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
        passed = schedule_bucket(now, schedule_ms, timezone) > schedule_bucket(max_timestamp, schedule_ms, timezone)
        return full | F.coalesce(passed, F.lit(False))

    # both sides of the join read the same columns, so Spark builds the manifest once and reuses it
    needed = manifest.select(*KEYS, "first_offset", "last_offset", "records", "max_timestamp")
    newest = needed.groupBy(*KEYS).agg(
        F.max("first_offset").alias("_first"),
        F.max("last_offset").alias("_last"),
        F.max_by("records", "first_offset").alias("_records"),
        F.max_by("max_timestamp", "first_offset").alias("_max_timestamp"),
    )
    last = F.when(closed("_records", "_max_timestamp"), F.col("_last")).otherwise(
        F.when(F.col("first_offset") < F.col("_first"), F.col("last_offset"))
    )
    # one row per topic-partition, of which a cluster has some hundred thousand at most
    return needed.join(F.broadcast(newest), KEYS).groupBy(*KEYS).agg((F.max(last) + 1).alias("commit_offset"))
