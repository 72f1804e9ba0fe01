"""Continuous backup and restore.

A micro-batch is written and committed (``sources.snapshots``) before the checkpoint moves on. Its label is the checkpoint's own
name and the number of the batch, so a batch that is repeated after a failure stands in for itself, and a query with another
checkpoint adds to what is there. An unfinished batch is never seen and read again. Failed tasks are retried by Spark with their
input. Back-pressure is set at the source (``max_per_trigger``, ``max_files``); the clock that
closes idle segments is the trigger.
"""

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions.headers import stamp_restore_headers
from tidelog.operators.compaction import progress_marks
from tidelog.operators.generator import generate_log, generate_log_of_parts, message_block
from tidelog.operators.ordering import BLOCK
from tidelog.operators.records import rename_topics
from tidelog.schema import DEFAULT_POLL_SECONDS, TOPIC_PARTITION
from tidelog.session import join_null_safe, small_side
from tidelog.sources import snapshots
from tidelog.sources.backup import committed_records, exists, scan_backup, stream_commits
from tidelog.sources.sinks import assign_offsets, log_ends, put_files, write_backup, write_log
from tidelog.streaming.dedupe import first_seen, state_store

KEYS = list(TOPIC_PARTITION)


def _start(df: DataFrame, run, checkpoint: str, poll_seconds: float | None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}
    return writer.trigger(**trigger).start()


def query_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint, given at its first use and kept in it."""
    store = snapshots._Store(spark, f"{checkpoint.rstrip('/')}/tidelog")
    store.put("name", uuid.uuid4().hex)
    return store.read("name")


def stream_backup_sink(
    df: DataFrame, root: str, checkpoint: str, poll_seconds: float | None = DEFAULT_POLL_SECONDS, codec: str = "zstd"
) -> StreamingQuery:
    """Append a stream of records to a backup. ``poll_seconds=None`` stops when all input is read."""
    name = query_name(df.sparkSession, checkpoint)
    return _start(
        df, lambda batch, batch_id: write_backup(batch, root, batch_id=batch_id, codec=codec, label=f"{name}:{batch_id}"),
        checkpoint, poll_seconds,
    )


def stream_restore(
    df: DataFrame,
    target,
    checkpoint: str,
    topic_map="",
    positions: DataFrame | None = None,
    now_ms=None,
    poll_seconds: float | None = DEFAULT_POLL_SECONDS,
) -> StreamingQuery:
    """Restore a stream of backup records: skip what is done, rename, stamp, produce.

    The checkpoint holds the restart position. ``positions`` skips records that an earlier restore,
    without this checkpoint, has produced. A table target gets one commit per batch, so a repeated
    batch stands in for itself; its records get new offsets, which continue those of the commits before, whichever query
    made them, and keep the old one in their header.
    """
    done = None if positions is None else small_side(positions.select(*KEYS, "last_offset"))
    produce = _producer(df.sparkSession, target, checkpoint, topic_map, done, now_ms)
    return _start(df, produce, checkpoint, poll_seconds)


def stream_restore_commits(
    spark: SparkSession, root: str, target, checkpoint: str, topic_map="", topics=None, generation: str | None = None,
    positions: DataFrame | None = None, now_ms=None, max_commits: int | None = None,
    poll_seconds: float | None = DEFAULT_POLL_SECONDS,
) -> StreamingQuery:
    """``stream_restore`` of the writes that count in the backup at ``root``, as they are committed."""
    done = None if positions is None else small_side(positions.select(*KEYS, "last_offset"))
    produce = _producer(spark, target, checkpoint, topic_map, done, now_ms)

    def run(commits, batch_id):
        produce(committed_records(commits, root, topics, generation), batch_id)

    return _start(stream_commits(spark, root, max_commits), run, checkpoint, poll_seconds)


def _producer(spark, target, checkpoint, topic_map, done, now_ms):
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    name = query_name(spark, checkpoint)

    def run(batch, batch_id):
        rows = batch if done is None else join_null_safe(batch, done, KEYS, "left").filter(
            "last_offset IS NULL OR offset > last_offset"
        ).select(*batch.columns)
        out = stamp_restore_headers(rename_topics(rows, topic_map), now)
        if isinstance(target, Mapping):
            write_log(out, target)
        else:
            append_batch(out, target, f"{name}:{batch_id}")

    return run


def append_batch(rows: DataFrame, target: str, label: str, block: int = BLOCK) -> None:
    """Add records to a table with offsets that continue those of the commits before.

    With each commit goes a table of the next offset of every topic-partition, which the next commit reads. A batch that is
    repeated goes on from what was there without it. A log that has no commits yet is read for its last offsets.
    """
    spark = rows.sparkSession
    before = [c.batch_id for c in snapshots.commits(spark, target) or [] if c.label != label]
    ends = None
    if before and exists(spark, _ends(target, before[-1])):
        ends = spark.read.schema("topic string, partition int, next_offset bigint").parquet(_ends(target, before[-1]))
    elif before or snapshots.commits(spark, target) is None:
        ends = log_ends(spark, target)
    sizes = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("next_offset"))
    both = sizes if ends is None else sizes.unionByName(ends)
    folder = snapshots.reserve(spark, target)
    put_files(assign_offsets(rows, ends, block), target, folder, block=block)
    both.groupBy(*KEYS).agg(F.sum("next_offset").alias("next_offset")).write.parquet(_ends(target, folder))
    snapshots.commit(spark, target, folder, label)


def _ends(target: str, batch_id: int) -> str:
    return f"{target.rstrip('/')}/{snapshots.FOLDER}/ends/batch_id={batch_id}"


def stream_dedupe_sink(
    df: DataFrame, root: str, checkpoint: str, poll_seconds: float | None = DEFAULT_POLL_SECONDS
) -> StreamingQuery:
    """Append a stream of records to a backup, each coordinate once, however late it comes again.

    The state store remembers the offsets that were seen, as one bitmap per block of offsets (``streaming.dedupe``): a
    micro-batch reads and writes the bitmaps of its own blocks, never the backup. A query with a new checkpoint begins with
    what the backup holds.
    """
    spark, name = df.sparkSession, query_name(df.sparkSession, checkpoint)
    own = {c.label for c in snapshots.commits(spark, root) or [] if c.label.startswith(f"{name}:")}
    seen = None
    if not own and exists(spark, root) and snapshots.live_batches(spark, root) != []:
        seen = scan_backup(spark, root).select(*KEYS, "offset")

    def run(batch, batch_id):
        write_backup(batch, root, batch_id=batch_id, label=f"{name}:{batch_id}")

    with state_store(spark):
        return _start(first_seen(df, seen), run, checkpoint, poll_seconds)


def stream_files(
    files: DataFrame, target: str, checkpoint: str, topic: str, size: int, partitions: int, weights=None,
    poll_seconds: float | None = DEFAULT_POLL_SECONDS, part_name: str | None = None,
) -> StreamingQuery:
    """New files of a watched folder (``sources.files.watch_files``) as messages, keyed by file name, appended to a log.

    Weighted round robin begins anew in every batch; offsets continue. With ``part_name``, a pattern of the end of a path,
    paths alike without it are the parts, in name order, of one file; its parts have to come in one batch.
    """

    name = query_name(files.sparkSession, checkpoint)

    def run(batch, batch_id):
        if part_name is None:
            log = generate_log(batch, topic, size, partitions, weights)
        else:
            parts = batch.select(F.regexp_replace("path", part_name, "").alias("path"), F.col("path").alias("part"), "content")
            log = generate_log_of_parts(parts, topic, size, partitions, weights)
        append_batch(log, target, f"{name}:{batch_id}", message_block(size))

    return _start(files, run, checkpoint, poll_seconds)


def stream_progress_marks(
    df: DataFrame, marks: str, checkpoint: str, mark_every: int, poll_seconds: float | None = DEFAULT_POLL_SECONDS
) -> StreamingQuery:
    """Append announced offsets under ``marks/announced``, one folder per batch.

    ``marks/last`` holds, per batch, the last announcement of every topic-partition: the state the
    next batch continues from, also the first one of a query with a new checkpoint. A repeated batch goes on from what was
    there without it and stands in for its own; ``announced_marks`` reads what counts.
    """
    name = query_name(df.sparkSession, checkpoint)

    def run(batch, batch_id):
        spark, label = batch.sparkSession, f"{name}:{batch_id}"
        before = [c.batch_id for c in snapshots.commits(spark, marks) or [] if c.label != label]
        folder = snapshots.reserve(spark, marks)

        def put(rows, kind):
            rows.write.parquet(f"{marks}/{kind}/batch_id={folder}")

        last = None
        if before:
            schema = "topic string, partition int, offset bigint"
            last = spark.read.schema(schema).parquet(f"{marks}/last/batch_id={before[-1]}")
        put(progress_marks(batch, mark_every, last), "announced")
        told = spark.read.parquet(f"{marks}/announced/batch_id={folder}").select(*KEYS, "offset")
        both = told if last is None else told.unionByName(last)
        put(both.groupBy(*KEYS).agg(F.max("offset").alias("offset")), "last")
        snapshots.commit(spark, marks, folder, label)

    return _start(df, run, checkpoint, poll_seconds)


def announced_marks(spark: SparkSession, marks: str) -> DataFrame:
    """The announcements of ``stream_progress_marks`` that count."""
    found = spark.read.schema("topic string, partition int, offset bigint, batch_id bigint").parquet(f"{marks}/announced")
    return snapshots.only_batches(found, snapshots.live_batches(spark, marks)).select(*KEYS, "offset")
