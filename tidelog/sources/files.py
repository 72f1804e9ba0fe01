"""Folders of files as generator input."""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.session import join_null_safe, small_side

_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: Bytes of pieces that are compressed together on their way to a digest.
PACKED_BYTES = 1 << 22


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files (path, length, content) of a folder."""
    return spark.read.format("binaryFile").load(folder).select("path", "length", "content")


def watch_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Every new file of a folder, as a stream."""
    reader = spark.readStream.format("binaryFile").schema(_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("path", "content")


def _packed(columns: list[str]):
    """Pieces (key, order …, value) that follow each other, put together and compressed: (key, order …, _size, value)."""
    names = [*columns, "_size", "value"]

    def pack(batches):
        codec, first, last, held, size = pa.Codec("zstd", 12), None, None, [], 0

        def row():
            packed = codec.compress(b"".join(held), asbytes=True)
            return pa.RecordBatch.from_pylist([dict(zip(names, [*first, size, packed], strict=True))], schema=schema)

        for batch in batches:
            fields = [batch.schema.field(i) for i in range(len(columns))]
            schema = pa.schema([*fields, ("_size", pa.int64()), ("value", pa.binary())])
            for *at, value in zip(*batch.columns, strict=True):
                at = [a.as_py() for a in at]
                if held and (size >= PACKED_BYTES or at != [*last[:-1], last[-1] + 1]):
                    yield row()
                    held, size = [], 0
                if not held:
                    first = at
                last = at
                held.append(value.as_buffer())
                size += len(held[-1])
        if held:
            yield row()

    return pack


def digests(pieces: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``key`` (text), ``bytes`` and ``digest``: the MD5 of the ``value`` of each key's ``pieces``, joined in ``order``.

    ``order`` ends in a number that grows by one from piece to piece. MD5 goes from byte to byte, so a task follows a key; it
    holds the state of the digest and one batch of pieces. What it reads are compressed runs of pieces, and the largest keys go
    to tasks of their own.
    """
    spark, columns = pieces.sparkSession, [key, *order]

    def follow(batches):
        codec, name, state, total = pa.Codec("zstd"), None, None, 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([total], pa.int64()), pa.array([state.hexdigest()])], names=[key, "bytes", "digest"]
            )

        for batch in batches:
            for own, size, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if state is None or own != name:
                    if state is not None:
                        yield row()
                    name, state, total = own, hashlib.md5(), 0
                state.update(codec.decompress(value.as_buffer(), size))
                total += size
        if state is not None:
            yield row()

    # one row per key
    by_size = Window.orderBy(F.desc("_n"), key)
    ranks = pieces.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(key, (F.row_number().over(by_size) - 1).alias("_rank"))
    ranks = small_side(ranks)
    tasks = max(1, min(ranks.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    types = dict(pieces.dtypes)
    ddl = ", ".join(f"`{c}` {types[c]}" for c in columns) + ", _size bigint, value binary"
    runs = pieces.select(*columns, "value").mapInArrow(_packed(columns), ddl)
    placed = join_null_safe(runs, ranks, [key]).repartitionById(tasks, (F.col("_rank") % tasks).cast("int"))
    rows = placed.sortWithinPartitions(key, *order).select(key, "_size", "value")
    return rows.mapInArrow(follow, f"{key} string, bytes bigint, digest string")
