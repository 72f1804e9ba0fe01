"""Reading a live or exported log, as a batch or as a stream."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.records import _topics, log_columns, select_topics, to_envelope
from tidelog.schema import LOG_SCHEMA


def _position(side) -> Mapping | None:
    return side if isinstance(side, Mapping) else None


def _bounded(df: DataFrame, start, end) -> DataFrame:
    """Offset bounds {topic: {partition: offset}} on a table, as a Kafka source reads them: -2 earliest, -1 latest."""
    if any(at == -2 for offsets in (_position(end) or {}).values() for at in offsets.values()):
        raise ValueError("a log cannot end at its earliest offset")

    def bound(spec, inside):
        cond = F.lit(True)
        for topic, offsets in spec.items():
            for partition, offset in offsets.items():
                here = (F.col("topic") == topic) & (F.col("partition") == int(partition))
                cond &= ~here | inside(F.col("offset"), offset)
        return cond

    if _position(start):
        df = df.filter(bound(start, lambda o, at: F.lit(False) if at == -1 else o >= at))
    if _position(end):
        df = df.filter(bound(end, lambda o, at: F.lit(True) if at == -1 else o < at))
    return df


def _kafka_options(source: Mapping, topics) -> dict:
    return {"subscribe": ",".join(_topics(topics)), "includeHeaders": "true", **source}


def _as_json(side):
    import json

    return json.dumps(side) if isinstance(side, Mapping) else side


def read_log(spark: SparkSession, source, topics, start="earliest", end="latest") -> DataFrame:
    """Records of topics from a Kafka cluster or from a Parquet log.

    ``source`` is a dict of Kafka options, or the path of a table with the log columns. ``start``
    and ``end`` are ``earliest``/``latest`` or offsets per topic and partition.
    """
    if isinstance(source, Mapping):
        reader = spark.read.format("kafka").options(**_kafka_options(source, topics))
        return to_envelope(
            reader.option("startingOffsets", _as_json(start)).option("endingOffsets", _as_json(end)).load()
        )
    table = select_topics(spark.read.schema(LOG_SCHEMA).parquet(source), topics)
    return log_columns(_bounded(table, start, end))


def stream_log(spark: SparkSession, source, topics, start="earliest", max_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream. ``max_per_trigger`` (records or files) is the back-pressure."""
    if isinstance(source, Mapping):
        reader = spark.readStream.format("kafka").options(**_kafka_options(source, topics))
        reader = reader.option("startingOffsets", _as_json(start))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return to_envelope(reader.load())
    reader = spark.readStream.schema(LOG_SCHEMA)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return log_columns(select_topics(reader.parquet(source), topics))
