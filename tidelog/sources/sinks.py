"""Writing backups and restored logs."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.headers import add_header
from tidelog.operators.ordering import BLOCK, number_records, offset_block
from tidelog.operators.segments import segment
from tidelog.schema import LOG_COLUMNS, LOG_SCHEMA, TOPIC_PARTITION, file_format
from tidelog.session import join_null_safe
from tidelog.sources import snapshots
from tidelog.sources.backup import escaped, exists

KEYS = list(TOPIC_PARTITION)
#: Bytes of a block of an Avro file.
AVRO_BLOCK = 1 << 20


def write_backup(
    df: DataFrame,
    root: str,
    generation: str | None = None,
    batch_id: int | None = None,
    codec: str = "zstd",
    fmt: str = "parquet",
    block: int = BLOCK,
    label: str | None = None,
) -> snapshots.Commit:
    """Add records to a backup, under ``topic=/[generation=/]partition=/batch_id=/``, sorted by offset.

    One shuffle, by topic, partition and offset block: records that belong together meet in one
    file, and a topic-partition that holds much of the log is still written by many tasks. There is
    at most one file per block, however many small topic-partitions a task writes.

    The records count from the moment that all of them are there (``sources.snapshots``). A write never touches what another
    one wrote. One with a ``label`` stands in for an earlier one with the same, as a whole; ``batch_id`` alone is a label, too,
    and the name of the folder where no other write has it. ``codec`` and ``fmt`` go to the writer: Parquet takes none,
    snappy, gzip and zstd; Avro takes uncompressed, snappy, bzip2, deflate and xz.
    """
    spark = df.sparkSession
    if label is None and batch_id is not None:
        label = f"batch:{batch_id}" if generation is None else f"generation:{generation}/batch:{batch_id}"
    folder = snapshots.reserve(spark, root, batch_id)
    put_files(df, root, folder, generation, codec, fmt, block)
    return snapshots.commit(spark, root, folder, label, generation)


def put_files(
    df: DataFrame, root: str, batch_id: int, generation: str | None = None, codec: str = "zstd", fmt: str = "parquet",
    block: int = BLOCK,
) -> None:
    """The files of a write whose folder is reserved; they count once it is committed."""
    rows, folders = df.select(*LOG_COLUMNS), ["topic"]
    if generation is not None:
        rows = rows.withColumn("generation", F.lit(generation))
        folders.append("generation")
    rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    folders += ["partition", "batch_id"]
    placed = rows.repartition(*KEYS, offset_block("offset", block)).sortWithinPartitions(*folders, "offset")
    # an Avro block is compressed on its own: the default of 64 KB makes a new compressor for every few hundred records
    writer = placed.write.format(file_format(fmt)).option("avro.mapred.sync.interval", AVRO_BLOCK)
    writer.option("compression", codec).partitionBy(*folders).mode("append").save(root)


def write_segments(
    df: DataFrame, root: str, flush_size: int, schedule_ms: int | None = None, timezone: str = "UTC",
    generation: str | None = None, open_tail: bool = True, codec: str = "zstd",
) -> None:
    """One file per segment, in the layout of ``write_backup`` with the segment's first offset as batch.

    Segments are cut by count and clock (``operators.segments.segment``). A repeated write replaces the same segments.
    Without ``open_tail`` the newest segment of a topic-partition waits until it is full or another follows. Segments are
    named by their first offset alone, so they need a folder without commits.
    """
    if snapshots.live_batches(df.sparkSession, root) is not None:
        raise ValueError(f"{root} holds batches with commits; write segments to a folder of their own")
    cut = segment(df, flush_size, schedule_ms, timezone)
    whole = Window.partitionBy(*KEYS, "segment_id")
    rows = cut.withColumn("batch_id", F.min("offset").over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))
    if not open_tail:
        newest = cut.groupBy(*KEYS).agg(F.max("offset").alias("_end"))
        # one row per topic-partition, of which a cluster has some hundred thousand at most
        rows = join_null_safe(rows.withColumn("_last", F.max("offset").over(whole)), F.broadcast(newest), KEYS)
        rows = rows.filter((F.col("_last") < F.col("_end")) | (F.col("_n") >= flush_size))
    folders = ["topic", "partition", "batch_id"]
    if generation is not None:
        rows = rows.withColumn("generation", F.lit(generation))
        folders.insert(1, "generation")
    # the windows have brought the records of a segment together; a segment has at most flush_size
    placed = rows.select(*LOG_COLUMNS, *[c for c in folders if c not in LOG_COLUMNS]).sortWithinPartitions(*folders, "offset")
    writer = placed.write.option("compression", codec).partitionBy(*folders)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def assign_offsets(df: DataFrame, ends: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """New offsets as the target topic gives them: consecutive in each topic-partition.

    ``ends`` (topic, partition, next_offset) continues a target that already holds records.
    """
    numbered = number_records(df, out="_rn", block=block)
    base = F.lit(0)
    if ends is not None:
        # one row per topic-partition, of which a cluster has some hundred thousand at most: no count first, which a stream
        # would make for each of its batches
        numbered = join_null_safe(numbered, F.broadcast(ends.select(*KEYS, "next_offset")), KEYS, "left")
        base = F.coalesce("next_offset", F.lit(0))
    return numbered.withColumn("offset", base + F.col("_rn") - 1).select(*df.columns)


def offset_waves(df: DataFrame, wave_rows: int, block: int = BLOCK) -> list[tuple[int, int]]:
    """Offset ranges in order, each with about ``wave_rows`` records of a topic-partition at most.

    A range is made of whole offset blocks, so it holds at most ``wave_rows + block`` of them. One
    row per range comes to the driver.
    """
    per_block = (
        df.groupBy(*KEYS, offset_block("offset", block).alias("_block"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("_block")
        .agg(F.max("_n").alias("_n"))
    )
    before = F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")
    waves = (
        per_block.withColumn("_wave", F.floor(before / wave_rows))
        .groupBy("_wave")
        .agg(F.min("_block").alias("lo"), F.max("_block").alias("hi"))
        .orderBy("_wave")
    )
    return [(r.lo * block, (r.hi + 1) * block - 1) for r in waves.collect()]


def _write_kafka(df: DataFrame, options: Mapping, wave_rows: int) -> None:
    # The order inside a partition must hold, so a topic-partition is produced by one task at a
    # time. Waves of offset ranges bound what that task handles; the range is pushed to the scan.
    stamped = add_header(df, "x-old-timestamp", F.col("timestamp").cast("string"))
    for lo, hi in offset_waves(df.select(*KEYS, "offset"), wave_rows):
        (
            stamped.filter(F.col("offset").between(lo, hi))
            .repartition(*KEYS)
            .sortWithinPartitions(*KEYS, "offset")
            .select("topic", "partition", "key", "value", "headers")
            .write.format("kafka")
            .options(**{"includeHeaders": "true", **options})
            .save()
        )


def write_log(df: DataFrame, target, ends: DataFrame | None = None, wave_rows: int = BLOCK) -> None:
    """Produce restored records: to Kafka (a dict of options) or to a Parquet log (a path).

    Topic, partition, key, value and headers are kept. A Kafka sink cannot set the timestamp, so it
    travels in the header ``x-old-timestamp``; a table keeps it and gets new offsets here, which continue what the
    table holds unless ``ends`` says otherwise.
    """
    if isinstance(target, Mapping):
        _write_kafka(df, target, wave_rows)
    else:
        # numbering has brought neighbours together already: sort, no further shuffle
        ends = log_ends(df.sparkSession, target) if ends is None else ends
        assign_offsets(df, ends).sortWithinPartitions(*KEYS, "offset").write.mode("append").parquet(target)


def log_ends(spark: SparkSession, target: str) -> DataFrame | None:
    """Next offset of every topic-partition of a Parquet log, None if there is no log yet."""
    if not exists(spark, target):
        return None
    log = spark.read.schema(LOG_SCHEMA).parquet(target)
    return log.groupBy(*KEYS).agg((F.max("offset") + 1).alias("next_offset"))


def drop_generation(
    spark: SparkSession, root: str, topic: str, generation: str, partition: int | None = None
) -> bool:
    """Remove one generation of a topic, or one partition of it. Only that one folder is touched."""
    for name in (topic, generation):
        if not name or "/" in name or name in (".", ".."):
            raise ValueError(f"not a folder name: {name!r}")
    folder = f"{root}/topic={escaped(spark, topic)}/generation={escaped(spark, generation)}"
    if partition is not None:
        folder += f"/partition={int(partition)}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete_files(files: DataFrame, path: str = "path") -> int:
    """Delete the listed files, for instance of ``expired_files``; returns how many are gone.

    Paths are streamed to the driver one task at a time; deletion is a call to the store per file.
    """
    spark = files.sparkSession
    conf, gone = spark._jsc.hadoopConfiguration(), 0
    for row in files.select(path).toLocalIterator():
        target = spark._jvm.org.apache.hadoop.fs.Path(row[0])
        gone += bool(target.getFileSystem(conf).delete(target, False))
    return gone
