"""Reading a backup: ``root/topic=/[generation=/]partition=/[batch_id=/]`` Parquet files.

Topic, generation and partition are folders, so filters on them prune files. Files are sorted by
offset, so filters on the offset skip row groups. Of a backup with commits only the batches that count are read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.records import _topics
from tidelog.schema import LOG_COLUMNS, LOG_SCHEMA, file_format
from tidelog.sources import snapshots


def _schema(generation: bool, batches: bool = False) -> T.StructType:
    extra = [T.StructField("generation", T.StringType())] if generation else []
    extra += [T.StructField("batch_id", T.LongType())] if batches else []
    return T.StructType([*LOG_SCHEMA.fields, *extra])


def scan_backup(
    spark: SparkSession, root: str, topics=None, generation: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Records of a backup, of some topics or all. A backup with generations needs the name of one.

    Topics and generations that the backup never had are refused.
    """
    wanted = None if topics is None else _topics(topics)
    require_topics(spark, root, wanted, generation)
    return _scan(spark, root, wanted, generation, None, fmt)


def require_topics(spark: SparkSession, root: str, topics: list[str] | None, generation: str | None) -> None:
    """Raise an error where a topic, or its generation, was never written. A dropped generation was."""
    unknown = [t for t in topics or [] if not exists(spark, f"{root.rstrip('/')}/topic={escaped(spark, t)}")]
    if unknown:
        raise ValueError(f"no backup of topic {', '.join(unknown)}")
    if generation is None or generation in {c.generation for c in snapshots.commits(spark, root) or []}:
        return
    folder = f"generation={escaped(spark, generation)}"
    above = [f"{root.rstrip('/')}/topic={escaped(spark, t)}" for t in topics] if topics else [f"{root.rstrip('/')}/topic=*"]
    if not any(_matches(spark, f"{a}/{folder}") for a in above):
        raise ValueError(f"the backup has no generation {generation}")


def _matches(spark: SparkSession, pattern: str) -> bool:
    store, path = _store(spark, pattern)
    return bool(store.globStatus(path))


def _scan(spark, root, topics, generation, partition, fmt="parquet") -> DataFrame:
    """Only the folders of the topics, the generation and the partition are listed."""
    live = snapshots.live_batches(spark, root)
    schema = _schema(generation is not None, live is not None)
    if topics is None:
        folders = [root]
    else:
        above = [f"{root.rstrip('/')}/topic={escaped(spark, t)}" for t in topics]
        inner = "" if generation is None else f"/generation={escaped(spark, generation)}"
        inner += "" if partition is None else f"/partition={int(partition)}"
        folders = [a + inner for a in above if exists(spark, a + inner)]
        if not folders and generation is None and any(_has_generations(spark, a) for a in above):
            raise ValueError("the backup contains generations, name one")
        if not folders:
            return spark.createDataFrame([], LOG_SCHEMA)
    df = spark.read.format(file_format(fmt)).schema(schema).option("basePath", root).load(folders)
    if generation is None and "generation" in df.columns:
        raise ValueError("the backup contains generations, name one")
    if generation is not None:
        df = df.filter(F.col("generation") == generation)
    return snapshots.only_batches(df, live).select(*LOG_COLUMNS)


def scan_batches(spark: SparkSession, root: str, batches: list[int], generation: str | None = None, topics=None) -> DataFrame:
    """Records of single batches; of the folders of the other batches not even the names are listed."""
    above = ["topic=*"] if topics is None else [f"topic={escaped(spark, t)}" for t in _topics(topics)]
    inner = "" if generation is None else f"/generation={escaped(spark, generation)}"
    patterns = [f"{root.rstrip('/')}/{a}{inner}/partition=*/batch_id={b}" for a in above for b in batches]
    found = [p for p in patterns if _matches(spark, p)]
    if not found:
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(_schema(generation is not None, True)).option("basePath", root).parquet(*found).select(*LOG_COLUMNS)


def written_ends(spark: SparkSession, root: str, topics=None) -> DataFrame | None:
    """Last offset of every topic-partition that the batches which count hold; None without any. Only offsets are read."""
    named = None if topics is None else [t for t in _topics(topics) if exists(spark, f"{root.rstrip('/')}/topic={escaped(spark, t)}")]
    if not exists(spark, root) or not (named if named is not None else _matches(spark, f"{root.rstrip('/')}/topic=*")):
        return None
    return _scan(spark, root, named, None, None).groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))


def escaped(spark: SparkSession, name: str) -> str:
    """``name`` as Spark writes it in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _store(spark, folder)
    return store.exists(path)


def _has_generations(spark: SparkSession, folder: str) -> bool:
    store, path = _store(spark, folder)
    return store.exists(path) and any(s.getPath().getName().startswith("generation=") for s in store.listStatus(path))


def scan_generation(spark: SparkSession, root: str, topic: str, generation: str) -> DataFrame:
    """Records of one named generation of a compacted topic."""
    return scan_backup(spark, root, [topic], generation)


def scan_partition(spark, root: str, topic: str, partition: int, generation: str | None = None) -> DataFrame:
    """Records of one partition."""
    return _scan(spark, root, [topic], generation, partition)


def lookup_record(spark, root: str, topic: str, partition: int, offset: int, generation=None) -> DataFrame:
    """The record of one coordinate; no row if there is none."""
    return scan_partition(spark, root, topic, partition, generation).filter(F.col("offset") == offset)


def scan_time_range(spark, root: str, topic: str, partition: int, from_ms: int, to_ms: int, generation=None) -> DataFrame:
    """Records of a partition between two timestamps, both included."""
    return scan_partition(spark, root, topic, partition, generation).filter(
        F.col("timestamp").between(from_ms, to_ms)
    )


def scan_offset_range(spark, root: str, topic: str, partition: int, from_offset: int, to_offset: int, generation=None) -> DataFrame:
    """Records of a partition between two offsets, both included."""
    return scan_partition(spark, root, topic, partition, generation).filter(
        F.col("offset").between(from_offset, to_offset)
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet", topics=None) -> DataFrame:
    """Files of a backup: path, relative path of plain names, topic, generation, partition, age, size.

    Only the listing is read, no file content, and of ``topics`` only their folders.
    """
    folders: str | list[str] = root
    if topics is not None:
        named = [f"{root.rstrip('/')}/topic={escaped(spark, t)}" for t in topics]
        folders = [f for f in named if exists(spark, f)]
        if not folders:
            raise ValueError(f"no backup of topic {', '.join(topics)}")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folders)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    )

    def folder(name):
        # a plus sign is itself here, but stands for a blank in URL texts
        text = F.replace(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("+"), F.lit("%2B"))
        return F.nullif(F.url_decode(text), F.lit(""))

    live = snapshots.live_batches(spark, root)
    if live is not None:
        # files outside of batch folders are listed, too: they show a wrong layout
        batch = F.regexp_extract("path", "/batch_id=(-?[0-9]+)/", 1).try_cast("bigint")
        counts = F.expr(f"_batch IS NULL OR _batch IN ({', '.join(map(str, live)) or 'NULL'})")
        files = files.withColumn("_batch", batch).filter(counts).drop("_batch")

    parts = F.concat_ws("/", folder("topic"), folder("generation"), folder("partition"), F.element_at(F.split("path", "/"), -1))
    return files.withColumns(
        {
            "topic": folder("topic"),
            "generation": folder("generation"),
            "partition": folder("partition").cast("int"),
            "relative": parts,
        }
    )


def stream_backup(
    spark: SparkSession, root: str, topics=None, generation: str | None = None, max_files: int | None = None,
    batches: bool = False,
) -> DataFrame:
    """New records of a backup as they arrive; the query's checkpoint remembers the files read.

    The whole root is listed at each trigger, and files are read as they appear. Where writes may fail or be repeated use
    ``stream_commits``.
    """
    reader = spark.readStream.schema(_schema(generation is not None, batches))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(root)
    if topics is not None:
        df = df.filter(F.col("topic").isin(_topics(topics)))
    if generation is not None:
        df = df.filter(F.col("generation") == generation)
    return df.select(*LOG_COLUMNS)


def stream_commits(spark: SparkSession, root: str, max_commits: int | None = None) -> DataFrame:
    """The commits of a backup as they come, in order: a trigger lists one folder with one small file each.

    ``committed_records`` gives the records of a micro-batch of them.
    """
    reader = spark.readStream.schema("version bigint, batch_id bigint, label string, generation string, replaces bigint")
    if max_commits:
        reader = reader.option("maxFilesPerTrigger", max_commits)
    return reader.option("pathGlobFilter", "*.commit").json(f"{root.rstrip('/')}/{snapshots.FOLDER}")


def committed_records(commits: DataFrame, root: str, topics=None, generation: str | None = None) -> DataFrame:
    """The records that a micro-batch of ``stream_commits`` adds to those of the commits before it.

    A write that repeats another one adds what that one did not have.
    """
    spark = commits.sparkSession
    rows = commits.filter(F.col("generation").eqNullSafe(F.lit(generation))).collect()  # one row per commit of a trigger
    here = {r.batch_id for r in rows}
    known = {r.replaces for r in rows} - {None} - here
    gone = {r.replaces for r in rows if r.replaces in here}
    found = scan_batches(spark, root, sorted(here - gone), generation, topics)
    if not known:
        return found
    return found.join(scan_batches(spark, root, sorted(known), generation, topics), ["topic", "partition", "offset"], "left_anti").select(*LOG_COLUMNS)
