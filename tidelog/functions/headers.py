"""Record headers: an ordered list of (key, value) pairs in which names may repeat."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import HEADERS_DDL, OLD_OFFSET_HEADER, RESTORED_HEADER

# Stream magic + version of a Java-serialized object, as hex, followed by the type
# code of a short string, of a long string, or the class description of a byte array.
JAVA_SHORT_STRING = "ACED000574"
JAVA_LONG_STRING = "ACED00057C"
JAVA_BYTE_ARRAY = "ACED0005757200025B42ACF317F8060854E00200007870"


def headers_map(headers="headers") -> Column:
    """Map view of a header list. The last value of a repeated name wins."""
    h = F.col(headers) if isinstance(headers, str) else headers
    later = lambda x, i: F.exists(F.slice(h, i + 2, F.size(h)), lambda y: y["key"] == x["key"])
    return F.map_from_entries(F.filter(h, lambda x, i: ~later(x, i)))


def add_header(df: DataFrame, key, value) -> DataFrame:
    """Append one header to every record. ``value`` is a column or a text."""
    name = key if isinstance(key, Column) else F.lit(key)
    data = value if isinstance(value, Column) else F.lit(value)
    item = F.array(F.struct(name.alias("key"), data.cast("binary").alias("value"))).cast(HEADERS_DDL)
    return df.withColumn("headers", F.concat(F.coalesce("headers", F.array().cast(HEADERS_DDL)), item))


def has_headers(headers="headers") -> Column:
    """True if the list is neither null nor empty."""
    return F.coalesce(F.size(headers) > 0, F.lit(False))


def stamp_restore_headers(df: DataFrame, now_ms) -> DataFrame:
    """Put the old offset and the restore time (epoch ms), both as text, before the other headers."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)

    def item(name, value):
        return F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))

    stamps = F.array(item(OLD_OFFSET_HEADER, F.col("offset")), item(RESTORED_HEADER, now)).cast(HEADERS_DDL)
    return df.withColumn("headers", F.concat(stamps, F.coalesce("headers", F.array().cast(HEADERS_DDL))))


def old_offset(headers="headers") -> Column:
    """Offset in the source topic that a restored record carries, -1 if none.

    The name is matched in any case; the last of several wins.
    """
    h = F.col(headers) if isinstance(headers, str) else headers
    found = F.filter(h, lambda x: F.lower(x["key"]) == OLD_OFFSET_HEADER)
    text = F.try_element_at(found, F.lit(-1))["value"].cast("string")
    return F.coalesce(F.trim(text).try_cast("bigint"), F.lit(-1).cast("bigint"))


def unwrap_java(value: Column) -> Column:
    """Payload of a Java-serialized String or byte[]; any other bytes are returned unchanged."""
    head = F.hex(F.substring(value, 1, 23))

    def after(prefix, length_bytes):
        start = len(prefix) // 2 + 1
        size = F.conv(F.hex(F.substring(value, start, length_bytes)), 16, 10).try_cast("bigint")
        body = F.substr(value, F.lit(start + length_bytes), size.try_cast("int"))
        return F.when(F.length(body) == size, body)

    plain = F.when(head.startswith(JAVA_SHORT_STRING), after(JAVA_SHORT_STRING, 2)).when(
        head.startswith(JAVA_LONG_STRING), after(JAVA_LONG_STRING, 8)
    ).when(head == JAVA_BYTE_ARRAY, after(JAVA_BYTE_ARRAY, 4))
    return F.coalesce(plain, value)


def unwrap_legacy_headers(df: DataFrame) -> DataFrame:
    """Recover header bytes that an old backup stored as Java-serialized objects."""
    plain = F.transform(
        "headers", lambda x: F.struct(x["key"].alias("key"), unwrap_java(x["value"]).alias("value"))
    )
    return df.withColumn("headers", plain)
