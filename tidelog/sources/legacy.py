"""Importing backups in the two Avro layouts."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.envelopes import decode_envelopes
from tidelog.operators.records import _topics, decode_nulls
from tidelog.schema import HEADERS_DDL, LOG_COLUMNS, file_format

# old files keep headers as a map
_ENVELOPE_DDL = (
    "topic string, partition int, offset bigint, timestamp bigint, key binary, value binary,"
    " headers map<string,binary>"
)


def import_record_objects(spark: SparkSession, root: str, empty_as_null: bool = False) -> DataFrame:
    """One object per record, named ``topic/partition/offset``; the body is the record's Avro datum.

    The coordinate is taken from the path. Objects whose body does not decode keep a NULL payload.
    ``empty_as_null`` reads empty keys and values as NULL, which old files could not tell apart.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    )
    decoded = decode_envelopes(files, "content")
    coordinate = r"([^/]+)/(\d+)/(\d+)$"
    part = lambda i: F.regexp_extract("path", coordinate, i)
    log = decoded.filter(F.col("path").rlike(coordinate)).select(
        part(1).alias("topic"),
        part(2).cast("int").alias("partition"),
        part(3).cast("bigint").alias("offset"),
        "record.timestamp",
        "record.key",
        "record.value",
        "record.headers",
    )
    return decode_nulls(log) if empty_as_null else log


def import_avro_segments(
    spark: SparkSession, root: str, empty_as_null: bool = False, topics=None, generation: str | None = None
) -> DataFrame:
    """Avro container files below ``root``, in any codec. Spark splits large files.

    ``topics`` reads ``topic/partition`` folders only, or ``topic/generation/partition`` ones of a ``generation``; a topic
    without such files is refused. Without ``topics`` all files are read, so name them where a topic has generations.
    """
    reader = spark.read.format(file_format("avro")).schema(_ENVELOPE_DDL).option("pathGlobFilter", "*.avro")
    if topics is None:
        rows = reader.option("recursiveFileLookup", "true").load(root)
    else:
        inner = "" if generation is None else f"/{generation}"
        folders = [f"{root.rstrip('/')}/{t}{inner}/[0-9]*" for t in _topics(topics)]
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.avro")
            if not path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path):
                raise ValueError(f"no segments in {folder}")
        rows = reader.load(folders)
    log = rows.withColumn("headers", F.map_entries("headers").cast(HEADERS_DDL)).select(*LOG_COLUMNS)
    return decode_nulls(log) if empty_as_null else log


def strip_folder_names(spark: SparkSession, source: str, target: str, names) -> None:
    """Move what ``partitionBy(*names)`` wrote below ``source`` to folders of the values alone, as old files have them.

    One rename per folder of files.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for status in store.globStatus(path("/".join([source, *(f"{n}=*" for n in names)]))) or []:
        parts = status.getPath().toString().split("/")[-len(names):]
        values = [plain(p.split("=", 1)[1]) for p in parts]
        above = path("/".join([target, *values[:-1]]))
        store.mkdirs(above)
        if not store.rename(status.getPath(), path(above, values[-1])):
            raise OSError(f"cannot move {status.getPath()}")
