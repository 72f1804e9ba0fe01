"""The three batch jobs end to end, and the generation cycle."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.headers import stamp_restore_headers
from tidelog.functions.names import parse_topic_map
from tidelog.operators.commits import (
    committed_from_log,
    committed_from_table,
    offset_source,
    starting_offsets_json,
    translate_offsets,
)
from tidelog.operators.compaction import caught_up, latest_per_key, live_generation, merged_run, put_run
from tidelog.operators.inventory import require_layout
from tidelog.operators.records import dedupe_log, exclude_group, rename_topics, resume_after, select_topics, to_envelope
from tidelog.operators.retention import expired_files
from tidelog.operators.segments import segment, segment_manifest
from tidelog.sources.backup import list_files, scan_backup, written_ends
from tidelog.sources.sinks import write_backup, write_segments

GENERATION_COLUMNS = "topic string, generation string, promoted_at timestamp"


def backup(df: DataFrame, root: str, topics, codec: str = "zstd", batch_id: int | None = None) -> None:
    """Back up the given topics of a log: what comes after the offsets that the backup at ``root`` holds already.

    So a run may be repeated, and a later one adds. With ``batch_id`` all records are written, instead of those of an earlier
    run with the same.
    """
    rows = to_envelope(select_topics(df, topics))
    write_backup(rows if batch_id is not None else _new(rows, root), root, codec=codec, batch_id=batch_id)


def backup_offsets(df: DataFrame, root: str, group: str, batch_id: int | None = None) -> None:
    """Back up the consumer-offset log, without the commits of the backup's own ``group``; runs go on as in ``backup``."""
    rows = exclude_group(to_envelope(df), group)
    write_backup(rows if batch_id is not None else _new(rows, root), root, batch_id=batch_id)


def _new(rows: DataFrame, root: str) -> DataFrame:
    ends = written_ends(rows.sparkSession, root)
    return rows if ends is None else resume_after(rows, ends)


def plan_segments(df: DataFrame, flush_size: int, schedule_ms: int | None = None, timezone: str = "UTC") -> DataFrame:
    """Manifest of the segments a log is cut into."""
    return segment_manifest(segment(df, flush_size, schedule_ms, timezone))


def restore(
    df: DataFrame, topic_map, now_ms, positions: DataFrame | None = None, dedupe: bool = True
) -> DataFrame:
    """Records to produce: not restored yet, once each, under the target topic, with stamped headers.

    ``positions`` holds (topic, partition, last_offset), or, for topics with several targets, what
    ``restore_positions`` gives. ``dedupe=False`` saves a shuffle of all records, for backups written with batch ids, which hold
    every record once.
    """
    by_target = positions is not None and "target_topic" in positions.columns
    rows = df if positions is None or by_target else resume_after(df, positions)
    rows = dedupe_log(rows) if dedupe else rows
    rows = rename_topics(rows.withColumn("source_topic", F.col("topic")), topic_map)
    if by_target:
        known = positions.withColumn("topic", F.col("target_topic"))
        rows = resume_after(rows, known, ("source_topic", "topic", "partition"))
    return stamp_restore_headers(rows.select(*df.columns), now_ms)


def restore_positions(df: DataFrame, topic_map) -> DataFrame:
    """How far the records ``df`` bring a restore: (source_topic, target_topic, partition, last_offset)."""
    ends = df.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))
    renamed = rename_topics(ends.withColumn("source_topic", F.col("topic")), topic_map)
    return renamed.select("source_topic", F.col("topic").alias("target_topic"), "partition", "last_offset")


def restore_from(
    spark: SparkSession, root: str, topic_map: str, now_ms, generation: str | None = None,
    positions: DataFrame | None = None, dedupe: bool = True,
) -> DataFrame:
    """Records to produce from the backup at ``root``: the topics of ``topic_map`` (``a:b,c``).

    A backup without files of a topic or of the generation, or with files at another depth, is refused.
    """
    topics = list(parse_topic_map(topic_map))
    require_layout(list_files(spark, root, topics=topics), generation, "relative", topics)
    log = scan_backup(spark, root, topics, generation)
    return restore(log, topic_map, now_ms, positions, dedupe)


def expire_files(spark: SparkSession, root: str, policy: DataFrame, now: Column) -> DataFrame:
    """Files of the backup at ``root`` that a rule lets go. Deleting them is a second, explicit call."""
    return expired_files(list_files(spark, root), policy, now)


def translate(
    offset_log: DataFrame, restored: DataFrame, group: str, old_topic: str, new_topic: str,
    policy: str = "first_at_or_after",
) -> DataFrame:
    """Offsets a group continues from in the restored topic."""
    committed = committed_from_log(offset_log, group, old_topic)
    return translate_offsets(committed, select_topics(restored, [new_topic]), policy)


def translate_group(
    restored: DataFrame, group: str, old_topic: str, new_topic: str, manual: DataFrame | None = None,
    offset_log: DataFrame | None = None, live: DataFrame | None = None, policy: str = "first_at_or_after",
) -> DataFrame:
    """Start offsets of a group in the restored topic, as the JSON that a Kafka source takes.

    Offsets come from ``manual`` (partition, committed) if given, else from the backup's offset log, else from a table of
    live commits.
    """
    backup = None if offset_log is None else committed_from_log(offset_log, group, old_topic)
    current = None if live is None else committed_from_table(live, group, old_topic)
    committed = offset_source(manual, backup, current)
    return starting_offsets_json(translate_offsets(committed, select_topics(restored, [new_topic]), policy), new_topic)


def merge_batches(
    spark: SparkSession, root: str, target: str, flush_size: int, schedule_ms: int | None = None, timezone: str = "UTC",
    open_tail: bool = False,
) -> None:
    """The many small files of a streamed backup as one file per segment below ``target``; repeated, it replaces itself."""
    write_segments(scan_backup(spark, root), target, flush_size, schedule_ms, timezone, open_tail=open_tail)


def new_generation(df: DataFrame, root: str, name: str) -> None:
    """Full backup of compacted topics, beside the live one: the latest record of every key.

    Written again under its name, a generation holds what the last run wrote and nothing else.
    """
    write_backup(latest_per_key(df), root, generation=name, label=f"generation:{name}")


def compact(log: DataFrame, name: str, path: str, buckets: int) -> None:
    """The compacted records of a log as the table ``name`` of sorted runs, for ``compact_incremental`` to go on from."""
    put_run(latest_per_key(log), name, path, buckets)


def compact_incremental(spark: SparkSession, base: str, delta: DataFrame, name: str, path: str, buckets: int) -> None:
    """The table ``base`` after the records of ``delta``, as the table ``name`` at ``path``.

    The base is merged run by run, without a shuffle; the same number of buckets is needed.
    """
    put_run(merged_run(spark.table(base), delta, buckets), name, path, buckets, placed=True)


def promote_generations(
    spark: SparkSession, manifest: str, generation: str, progress: DataFrame, targets: DataFrame, now: Column
) -> DataFrame:
    """Make a generation live for every topic in which it has caught up. Returns (topic, generation) that it retires.

    ``manifest`` is the path of the promotions table; the caller drops retired generations. Topics are judged
    together: one aggregation, one append.
    """
    ready = caught_up(progress, targets).filter("complete")
    rows = ready.select("topic", F.lit(generation).alias("generation"), now.alias("promoted_at"))
    rows.coalesce(1).write.mode("append").parquet(manifest)
    promotions = spark.read.schema(GENERATION_COLUMNS).parquet(manifest)
    last = promotions.groupBy("topic").agg(F.max_by("generation", "promoted_at").alias("live")).filter(F.col("live") == generation)
    return promotions.filter(F.col("generation") != generation).join(last, "topic", "left_semi").select("topic", "generation").distinct()


def promote_generation(
    spark: SparkSession, manifest: str, topic: str, generation: str, progress: DataFrame, targets: DataFrame, now: Column
) -> DataFrame | None:
    """``promote_generations`` for one topic: the generations it retires, None if it has not caught up."""
    here = F.col("topic") == topic
    if not caught_up(progress.filter(here), targets.filter(here)).filter("complete").count():
        return None
    return promote_generations(spark, manifest, generation, progress.filter(here), targets.filter(here), now).filter(here)


def current_generation(spark: SparkSession, manifest: str) -> DataFrame:
    """Live generation per topic."""
    return live_generation(spark.read.schema(GENERATION_COLUMNS).parquet(manifest))
