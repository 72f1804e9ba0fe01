"""Keys and values of the binary consumer-offset log, with built-in expressions only.

All numbers are big-endian; a string is a 16-bit byte length followed by UTF-8.

key 0, 1   group STRING, topic STRING, partition INT32
key 2      group STRING
value 0, 2 offset INT64, metadata STRING, timestamp INT64
value 1    offset INT64, metadata STRING, commit timestamp INT64, expire timestamp INT64
value 3    offset INT64, leader epoch INT32, metadata STRING, commit timestamp INT64
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes beyond the end read as nothing or as a wrong number. That is harmless, because a struct is
# only made if the data reach its last field. Every helper names its inputs once, which keeps the
# expressions small where one position depends on the lengths before it.


def _number(data: Column, at: Column, size: int) -> Column:
    return F.conv(F.hex(F.substr(data, at, F.lit(size))), 16, 10)


def _size(data, at):
    return _number(data, at, 2).try_cast("int")


def _int16(data, at):
    return ((_number(data, at, 2).try_cast("int") + 32768) % 65536 - 32768).cast("int")


def _int32(data, at):
    raw = _number(data, at, 4).try_cast("bigint")
    return ((raw + 2147483648) % 4294967296 - 2147483648).cast("int")


def _int64(data, at):
    return F.conv(F.hex(F.substr(data, at, F.lit(8))), 16, -10).try_cast("bigint")


def _text(data, at, size):
    return F.substr(data, at, size).cast("string")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside filters, which share nothing."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is(data, *versions):
    return F.substring(data, 1, 2).isin(*[F.lit(v.to_bytes(2, "big")) for v in versions])


def decode_offset_keys(df: DataFrame, column: str = "key") -> DataFrame:
    """Add ``key_version`` and ``offset_key``; the struct is NULL if the bytes do not decode."""
    data = F.col(column)

    def row(group, topic, partition):
        return F.struct(group.alias("group"), topic.alias("topic"), partition.alias("partition"))

    def with_topic(group_size, topic_size):
        partition_at = group_size + topic_size + 7
        complete = (topic_size < 32768) & (F.length(data) >= partition_at + 3)
        topic = _text(data, group_size + 7, topic_size)
        return F.when(complete, row(_text(data, F.lit(5), group_size), topic, _int32(data, partition_at)))

    def with_group(group_size):
        complete = (group_size < 32768) & (F.length(data) >= group_size + 4)
        partition_key = _let(_size(data, group_size + 5), lambda topic_size: with_topic(group_size, topic_size))
        group_key = row(_text(data, F.lit(5), group_size), F.lit(None).cast("string"), F.lit(None).cast("int"))
        return F.when(complete & _is(data, 0, 1), partition_key).when(complete & _is(data, 2), group_key)

    version = F.when(F.length(data) >= 2, _int16(data, F.lit(1)))
    return df.withColumns({"key_version": version, "offset_key": _let(_size(data, F.lit(3)), with_group)})


def decode_offset_values(df: DataFrame, column: str = "value") -> DataFrame:
    """Add ``value_version`` and ``offset_value``; the struct is NULL if the bytes do not decode."""
    data = F.col(column)
    none_int, none_long = F.lit(None).cast("int"), F.lit(None).cast("bigint")

    def layout(metadata_at: int, epoch: Column, expires):
        def row(size):
            end = size + (metadata_at + 2)
            complete = (size < 32768) & (F.length(data) >= end + (15 if expires else 7))
            fields = F.struct(
                _int64(data, F.lit(3)).alias("offset"),
                epoch.alias("leader_epoch"),
                _text(data, F.lit(metadata_at + 2), size).alias("metadata"),
                _int64(data, end).alias("commit_timestamp"),
                (_int64(data, end + 8) if expires else none_long).alias("expire_timestamp"),
            )
            return F.when(complete, fields)

        return _let(_size(data, F.lit(metadata_at)), row)

    version = F.when(F.length(data) >= 2, _int16(data, F.lit(1)))
    value = (
        F.when(_is(data, 0, 2), layout(11, none_int, False))
        .when(_is(data, 1), layout(11, none_int, True))
        .when(_is(data, 3), layout(15, _int32(data, F.lit(11)), False))
    )
    return df.withColumns({"value_version": version, "offset_value": value})


def _hex_number(value: Column, digits: int) -> Column:
    # hex() of a bigint is its two's complement; the right-most digits are the narrower number
    return F.right(F.concat(F.repeat(F.lit("0"), F.lit(digits)), F.hex(value.cast("bigint"))), F.lit(digits))


def _hex_string(value: Column) -> Column:
    data = value.cast("binary")
    return F.concat(_hex_number(F.length(data), 4), F.hex(data))


def encode_offset_key(group: Column, topic: Column, partition: Column, version: Column) -> Column:
    """Bytes of an offset-log key."""
    name = F.concat(_hex_number(version, 4), _hex_string(group))
    return F.unhex(
        F.when(version == 2, name).otherwise(F.concat(name, _hex_string(topic), _hex_number(partition, 8)))
    )


def encode_offset_value(
    offset: Column, metadata: Column, commit_ts: Column, expire_ts: Column, epoch: Column, version: Column
) -> Column:
    """Bytes of an offset-log value."""
    none = F.lit("")
    return F.unhex(
        F.concat(
            _hex_number(version, 4),
            _hex_number(offset, 16),
            F.when(version == 3, _hex_number(epoch, 8)).otherwise(none),
            _hex_string(metadata),
            _hex_number(commit_ts, 16),
            F.when(version == 1, _hex_number(expire_ts, 16)).otherwise(none),
        )
    )
