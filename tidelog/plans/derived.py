"""Logs made from the driver's tables. Each is a projection of a whole table.

Offsets are row ids that grow with time, so every topic-partition has increasing offsets with gaps,
as a compacted or transactional topic has.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.commits import encode_offset_key, encode_offset_value
from tidelog.functions.headers import stamp_restore_headers
from tidelog.operators.records import rename_topics
from tidelog.schema import HEADERS_DDL, LOG_SCHEMA
from tidelog.session import scratch
from tidelog.sources.sinks import assign_offsets, write_backup

RESTORED_AT = 1_735_689_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(column: str):
    # the tables hold timestamps without a zone, which are taken as UTC whatever the session's zone
    local = F.col(column).cast("timestamp")
    return F.unix_millis(F.from_utc_timestamp(local, F.current_timezone()))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: a topic per type, four partitions by user; small values are tombstones."""

    def header(key, value):
        return F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))

    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("ev-"), "event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        epoch_ms("ts").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("value") >= 5, F.col("props").cast("binary")).alias("value"),
        F.array(
            header("event.id", F.col("event_id").cast("string")),
            header("seq", F.lit("1")),
            header("seq", F.lit("2")),
        ).cast(HEADERS_DDL).alias("headers"),
    )


def event_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every topic of the event log and its name ``r-…`` after a restore."""
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    return types.select(F.concat(F.lit("ev-"), "event_type").alias("source_topic"), F.concat(F.lit("r-"), "event_type").alias("target_topic"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders``: a topic per status, eight partitions by customer; the clock goes back and forth."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("or-"), "o_orderstatus").alias("topic"),
        (F.col("o_custkey") % 8).cast("int").alias("partition"),
        F.col("o_orderkey").alias("offset"),
        epoch_ms("o_orderdate").alias("timestamp"),
        F.col("o_custkey").cast("string").cast("binary").alias("key"),
        F.col("o_orderpriority").cast("binary").alias("value"),
        F.lit(None).cast(HEADERS_DDL).alias("headers"),
    )


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``: a topic per return flag, eight partitions; coordinates repeat, as after a redelivery."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("li-"), "l_returnflag").alias("topic"),
        (F.col("l_orderkey") % 8).cast("int").alias("partition"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("offset"),
        epoch_ms("l_shipdate").alias("timestamp"),
        F.col("l_partkey").cast("string").cast("binary").alias("key"),
        F.col("l_linestatus").cast("binary").alias("value"),
        F.lit(None).cast(HEADERS_DDL).alias("headers"),
    )


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored offset log."""
    path = once(spark, sf_dir, "commits", lambda p: _commits(spark, sf_dir).repartitionByRange("offset").write.parquet(p))
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def _commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as binary offset commits: every key and value version, tombstones, unknown versions."""
    event, user = F.col("event_id"), F.col("user_id")
    ms = epoch_ms("ts")
    key_version = F.when(event % 10 == 0, 2).when(event % 10 == 1, 9).otherwise((event % 2).cast("int"))
    value_version = F.when(event % 6 == 5, 7).otherwise((event % 6).cast("int"))
    value = encode_offset_value(
        event, F.col("event_type"), ms, ms + 86_400_000, (user - 10).cast("int"), value_version
    )
    return table(spark, sf_dir, "events").select(
        F.lit("__consumer_offsets").alias("topic"),
        (user % 7 % 3).cast("int").alias("partition"),
        event.alias("offset"),
        ms.alias("timestamp"),
        encode_offset_key(
            F.concat(F.lit("Grp-"), (user % 7).cast("string")),
            F.concat(F.lit("ev-"), "event_type"),
            (user % 4).cast("int"),
            key_version,
        ).alias("key"),
        F.when(event % 6 != 4, value).alias("value"),
        F.lit(None).cast(HEADERS_DDL).alias("headers"),
    )


def restored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log without tombstones, produced again to topics ``r-…`` with new offsets."""
    mapping = event_topics(spark, sf_dir)
    alive = event_log(spark, sf_dir).filter("value IS NOT NULL")
    return assign_offsets(rename_topics(stamp_restore_headers(alive, RESTORED_AT), mapping))


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as files, named so that name order is id order."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc/"), F.lpad(F.col("doc_id").cast("string"), 18, "0")).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )


_written: dict = {}


def once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of a table that ``write(path)`` writes at its first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def event_backup(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "backup", lambda path: write_backup(event_log(spark, sf_dir), path))
