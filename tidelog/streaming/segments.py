"""Rotation while the log is streamed: a segment is one file, written when it closes.

The records of the open segment of a topic-partition wait in the state store, at most ``flush_size`` of them. A segment closes
when it is full, when a record's arrival clock enters the next rotation interval, or when nothing came for a while, which a
timer tells without new input. Only then are its records written, below the segment's first offset, so a repeated
micro-batch writes the same files again. What is open when the query stops is in its checkpoint, not in the backup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import Row

from tidelog.operators.segments import schedule_bucket
from tidelog.schema import DEFAULT_POLL_SECONDS, HEADERS_DDL, LOG_COLUMNS, TOPIC_PARTITION
from tidelog.sources import snapshots
from tidelog.streaming.dedupe import state_store

KEYS = list(TOPIC_PARTITION)
RECORD_DDL = f"offset bigint, timestamp bigint, key binary, value binary, headers {HEADERS_DDL}"
CLOSED_DDL = f"topic string, partition int, {RECORD_DDL}, batch_id bigint"
#: Fields of a record in the state.
FIELDS = ["offset", "timestamp", "key", "value", "headers"]


class OpenSegments(StatefulProcessor):
    """State of a topic-partition: the records of its open segment, and the clock and rotation interval they reached."""

    def __init__(self, flush_size: int, idle_ms: int | None):
        self.flush_size, self.idle_ms = flush_size, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.reached = handle.getValueState("reached", "arrival bigint, bucket bigint, count int")
        self.records = handle.getListState("records", RECORD_DDL)

    def handleInputRows(self, key, rows, timerValues):
        arrival, bucket, count = self.reached.get() if self.reached.exists() else (None, None, 0)
        # a trigger's records come in any order; the source bounds how many there are
        fresh = []
        for r in sorted(rows, key=lambda r: r["offset"]):
            later = r["bucket"] is not None and (arrival is None or r["timestamp"] > arrival)
            if later:
                if r["bucket"] != bucket and count + len(fresh):
                    yield from self._closed(key, count, fresh)
                    count, fresh = 0, []
                arrival, bucket = r["timestamp"], r["bucket"]
            fresh.append(tuple(r[f] for f in FIELDS))
            if count + len(fresh) == self.flush_size:
                yield from self._closed(key, count, fresh)
                count, fresh = 0, []
        if fresh:
            self.records.appendList(fresh)
        self.reached.update((arrival, bucket, count + len(fresh)))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if count + len(fresh):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        arrival, bucket, count = self.reached.get() if self.reached.exists() else (None, None, 0)
        if count:
            yield from self._closed(key, count, [])
            self.reached.update((arrival, bucket, 0))

    def _closed(self, key, count: int, fresh: list):
        waiting = [tuple(r) for r in self.records.get()] if count else []
        if waiting:
            self.records.clear()
        first = (waiting or fresh)[0][0]
        for record in [*waiting, *fresh]:
            yield Row(topic=key[0], partition=key[1], **dict(zip(FIELDS, record, strict=True)), batch_id=first)

    def close(self) -> None:
        pass


def closed_segments(
    df: DataFrame, flush_size: int, schedule_ms: int | None = None, timezone: str = "UTC", idle_ms: int | None = None
) -> DataFrame:
    """The records of segments as they close, with the first offset of their segment as ``batch_id``.

    Needs the RocksDB state store, which ``stream_segments`` sets for its query.
    """
    bucket = F.lit(None).cast("bigint")
    if schedule_ms is not None and schedule_ms > 0:
        bucket = schedule_bucket("timestamp", schedule_ms, timezone).cast("bigint")
    timed = df.select(*LOG_COLUMNS, bucket.alias("bucket"))
    return timed.groupBy(*KEYS).transformWithState(
        statefulProcessor=OpenSegments(flush_size, idle_ms), outputStructType=CLOSED_DDL, outputMode="Append",
        timeMode="None" if idle_ms is None else "ProcessingTime",
    )


def stream_segments(
    df: DataFrame, root: str, checkpoint: str, flush_size: int, schedule_ms: int | None = None, timezone: str = "UTC",
    idle_ms: int | None = None, codec: str = "zstd", poll_seconds: float | None = DEFAULT_POLL_SECONDS,
) -> StreamingQuery:
    """Write a stream of records as ``sources.sinks.write_segments`` writes a log, one file per segment that has closed.

    ``idle_ms`` closes a segment to which nothing came for so long; it needs a query that goes on, so no ``poll_seconds=None``.
    Bound the records of a trigger at the source. ``root`` must be a folder without commits: segments are named by their
    first offset.
    """
    spark = df.sparkSession
    if idle_ms is not None and poll_seconds is None:
        raise ValueError("a query that stops at the end of its input waits for no idle segment")
    if snapshots.live_batches(spark, root) is not None:
        raise ValueError(f"{root} holds batches with commits; write segments to a folder of their own")
    folders = [*KEYS, "batch_id"]

    def put(closed, _):
        # the records of a segment come out of one task: sort, no shuffle
        writer = closed.sortWithinPartitions(*folders, "offset").write.option("compression", codec).partitionBy(*folders)
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)

    with state_store(spark):
        writer = closed_segments(df, flush_size, schedule_ms, timezone, idle_ms).writeStream.foreachBatch(put)
        trigger = {"availableNow": True} if poll_seconds is None else {"processingTime": f"{poll_seconds} seconds"}
        return writer.outputMode("append").option("checkpointLocation", checkpoint).trigger(**trigger).start()
