"""Session helpers: shared scratch folder, checkpoints, null-safe joins."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side that is ever broadcast, in rows. A row of the sides in question (partition
#: positions, topic maps, policies) is far below 1 KB, so this stays under about 100 MB.
BROADCAST_ROWS = 100_000

_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    ``spark.checkpoint.dir`` of the session, else the checkpoint folder of its context, else the warehouse, which a
    cluster shares as well. Never a temporary folder of one machine: a warehouse on a local disk serves a local session alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not configured and warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return configured or warehouse


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path (not created) in this application's part of the shared folder, which goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        folder = f"{shared_dir(spark).rstrip('/')}/tidelog-{app}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _folders[app] = folder
    return f"{_folders[app]}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and fixes the partition layout."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right`` where all ``keys`` are equal, null to null."""
    keys = list(keys)
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once, with a broadcast hint if what was written has at most ``max_rows`` rows.

    Without the hint the join is a sort-merge join, whose hot keys adaptive execution splits. Streams cannot be written
    here and are returned as they are.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    path = scratch(spark, "side")
    df.write.parquet(path)
    side = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(side) if side.count() <= max_rows else side
