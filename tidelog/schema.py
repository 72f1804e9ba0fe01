"""Table shapes shared by every job."""

from pyspark.sql import types as T

HEADER = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
)
HEADERS = T.ArrayType(HEADER)
HEADERS_DDL = "array<struct<key:string,value:binary>>"

#: One log record. ``offset`` is unique inside (topic, partition); a NULL value is a tombstone.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), False),
        T.StructField("partition", T.IntegerType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("timestamp", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("headers", HEADERS),
    ]
)
LOG_COLUMNS = LOG_SCHEMA.fieldNames()

COORDINATION_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("event", T.StringType()),
        T.StructField("connectorInstanceName", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

POLICY_SCHEMA = T.StructType(
    [
        T.StructField("rule_id", T.StringType(), False),
        T.StructField("topic", T.StringType(), False),
        T.StructField("generation", T.StringType()),
        T.StructField("days", T.IntegerType(), False),
        T.StructField("enabled", T.BooleanType(), False),
    ]
)

TOPIC_PARTITION = ("topic", "partition")

# Names and defaults that existing backups and consumers rely on.
OLD_OFFSET_HEADER = "x-old-offset"
RESTORED_HEADER = "x-restored"
MESSAGE_NUMBER_HEADER = "message.number"
OFFSET_PAD_WIDTH = 15
DEFAULT_CYCLE_HOURS = 6
DEFAULT_MARK_EVERY = 1000
DEFAULT_RETENTION_DAYS = 1
DEFAULT_POLL_SECONDS = 5
DEFAULT_MAX_RECORDS = 100
ACTIVATE, PASSIVATE = "ACTIVATE", "PASSIVATE"


def file_format(name: str) -> str:
    """Data source name. Spark 4.1 ships its Avro source, but registers no short name for it."""
    return "org.apache.spark.sql.avro.AvroFileFormat" if name == "avro" else name
