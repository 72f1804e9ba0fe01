"""A sparse time index of a backup: the least and the largest timestamp of every block of offsets in every file.

Clocks follow offsets only roughly, so an offset range says little of a time range. The index is written beside the commits,
for the batches that it does not have yet, and read instead of the footers of all files. A time range opens the files with
blocks that may hold it, and of these the row groups between the offsets of such blocks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.ordering import BLOCK, offset_block
from tidelog.schema import LOG_COLUMNS, LOG_SCHEMA
from tidelog.sources import snapshots
from tidelog.sources.backup import _schema, exists, scan_batches, scan_time_range

INDEX_DDL = (
    "topic string, partition int, path string, batch_id bigint, least bigint, most bigint, first_offset bigint, last_offset bigint"
)


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/{snapshots.FOLDER}/times"


def _indexed(spark: SparkSession, root: str) -> set[int]:
    names = snapshots._Store(spark, f"{_folder(root)}/names")
    return {i for name in names.names() for i in names.read(name)}


def index_times(spark: SparkSession, root: str, generation: str | None = None, block: int = BLOCK) -> int:
    """Index the files of the batches that count and are not indexed yet; returns how many batches those are.

    Only timestamps and offsets are read. A run that dies is repeated by the next one; entries that come twice do no harm.
    """
    live = [c.batch_id for c in snapshots.commits(spark, root) or [] if c.generation == generation]
    fresh = sorted(set(live) - _indexed(spark, root))
    if fresh:
        rows = snapshots.only_batches(spark.read.schema(_schema(generation is not None, True)).parquet(root), fresh)
        keys = ["topic", "partition", F.col("_metadata.file_path").alias("path"), "batch_id", offset_block("offset", block).alias("block")]
        blocks = rows.groupBy(*keys).agg(
            F.min("timestamp").alias("least"), F.max("timestamp").alias("most"),
            F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        )
        # sorted, so that a reader of one topic-partition skips the rest
        blocks.drop("block").sort("topic", "partition", "least").write.mode("append").parquet(f"{_folder(root)}/files")
        snapshots._Store(spark, f"{_folder(root)}/names").put(uuid.uuid4().hex, fresh)
    return len(fresh)


def time_index(spark: SparkSession, root: str) -> DataFrame | None:
    """The index of the batches that count; None without one."""
    if not exists(spark, f"{_folder(root)}/files"):
        return None
    entries = spark.read.schema(INDEX_DDL).parquet(f"{_folder(root)}/files")
    return snapshots.only_batches(entries, snapshots.live_batches(spark, root))


def scan_time_range_indexed(spark: SparkSession, root: str, topic: str, partition: int, from_ms: int, to_ms: int) -> DataFrame:
    """``sources.backup.scan_time_range`` that opens only the files which may hold the range, and those not indexed yet."""
    index, live = time_index(spark, root), snapshots.live_batches(spark, root)
    if index is None or live is None:
        return scan_time_range(spark, root, topic, partition, from_ms, to_ms)
    here = index.filter((F.col("topic") == topic) & (F.col("partition") == partition))
    maybe = here.filter((F.col("most") >= from_ms) & (F.col("least") <= to_ms))
    files = maybe.groupBy("path").agg(F.min("first_offset").alias("low"), F.max("last_offset").alias("high")).collect()
    parts = []
    if files:
        read = spark.read.schema(_schema(False, True)).option("basePath", root).parquet(*[r.path for r in files])
        parts.append(read.filter(F.col("offset").between(min(r.low for r in files), max(r.high for r in files))).select(*LOG_COLUMNS))
    late = sorted(set(live) - _indexed(spark, root))
    if late:
        parts.append(scan_batches(spark, root, late, topics=[topic]))
    found = spark.createDataFrame([], LOG_SCHEMA)
    for part in parts:
        found = part if part is parts[0] else found.unionByName(part)
    return found.filter((F.col("partition") == partition) & F.col("timestamp").between(from_ms, to_ms))
