import os
import sys

import pytest
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.schema import LOG_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    def build(rows):
        """Rows as dicts; missing fields get a plain default."""
        full = []
        for i, r in enumerate(rows):
            full.append(
                (
                    r.get("topic", "t"), r.get("partition", 0), r.get("offset", i), r.get("timestamp", 1000 * i),
                    r.get("key", b"k"), r.get("value", b"v"),
                    None if r.get("headers") is None else [Row(key=k, value=v) for k, v in r["headers"]],
                )
            )
        return spark.createDataFrame(full, LOG_SCHEMA)

    return build


@pytest.fixture(scope="session")
def skewed_log(spark):
    """20,000 records; one topic-partition holds half, offsets have gaps, the clock goes back at times."""
    n = 20_000
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 3).cast("string"))).alias("topic"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).cast("int").alias("partition"),
        (F.col("id") * 3 + F.col("id") % 2).alias("offset"),
        (F.col("id") * 40 + F.pmod(F.hash("id"), F.lit(500))).cast("bigint").alias("timestamp"),
        F.when(F.col("id") % 17 != 0, (F.col("id") % 301).cast("string").cast("binary")).alias("key"),
        F.when(F.col("id") % 11 != 0, F.col("id").cast("string").cast("binary")).alias("value"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
