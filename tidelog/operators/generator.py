"""Synthetic logs: files cut into messages, spread over partitions and numbered."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.headers import add_header
from tidelog.operators.ordering import BLOCK, number_records, prefix_sum
from tidelog.schema import HEADERS_DDL, MESSAGE_NUMBER_HEADER
from tidelog.session import small_side


#: Repetitions of one chunk that are generated together in one task.
PAGE = 1 << 16
#: Bytes of the messages that are numbered and written together.
BLOCK_BYTES = 1 << 26
#: Messages, and bytes of them, that a task hands over at once.
HANDED_ROWS, HANDED_BYTES = 10_000, 1 << 24


def _slices(content: pa.Scalar, first: int, size: int):
    """Cuts of the bytes of ``content``, which begin at ``first`` of their file, at its multiples of ``size``.

    Arrays of the number of the first cut and the cuts, which share the memory of ``content``: time is linear in its length.
    """
    data = content.as_buffer()
    numbers = range(first // size, (first + len(data) - 1) // size + 1)
    step = max(1, min(HANDED_ROWS, HANDED_BYTES // size))
    for at in range(0, len(numbers), step):
        own = numbers[at : at + step]
        edges = np.clip(np.arange(own[0], own[-1] + 2, dtype=np.int64) * size - first, 0, len(data))
        part = data.slice(int(edges[0]), int(edges[-1] - edges[0]))
        offsets = pa.py_buffer((edges - edges[0]).astype(np.int32))
        yield own[0], pa.Array.from_buffers(pa.binary(), len(own), [None, offsets, part])


def _repeated(value: pa.Scalar, n: int) -> pa.Array:
    return pa.repeat(value.cast(pa.string()), n)


def chunk_files(files: DataFrame, size: int, messages: int | None = None) -> DataFrame:
    """Messages (path, pos, value) of ``size`` bytes each; the rest of a file is a last, shorter one.

    ``files`` has (path, content). With ``messages`` the chunks of every file are repeated until
    it gave at least that many, always in whole passes; an empty file gives none.
    """
    usable = files.filter(F.length("content") > 0).select("path", "content")

    def cut(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                count = pa.scalar(-(-len(content.as_buffer()) // size), pa.int32())
                for first, values in _slices(content, 0, size):
                    n = len(values)
                    pos = pa.array(np.arange(first, first + n, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([_repeated(path, n), pa.repeat(count, n), pos, values], names=["path", "_n", "pos", "value"])

    chunks = usable.mapInArrow(cut, "path string, _n int, pos int, value binary")
    if messages is None:
        return chunks.select("path", "pos", "value")
    return repeat_to(chunks.withColumnRenamed("pos", "_chunk"), messages)


def chunk_parts(parts: DataFrame, size: int) -> DataFrame:
    """What ``chunk_files`` gives for the files that ``parts`` (path, part, content) make when joined in order of ``part``.

    A chunk that goes over the edge of a part is put together from its pieces; only those are shuffled. One narrow row
    per part tells where in its file a part begins.
    """
    usable = parts.filter(F.length("content") > 0).withColumn("_size", F.length("content").cast("bigint"))
    earlier = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = usable.select("path", "part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    placed = usable.join(bases, ["path", "part"]).select("path", "part", "_base", "content")

    def cut(batches):
        for batch in batches:
            for path, part, base, content in zip(*batch.columns, strict=True):
                for first, values in _slices(content, base.as_py(), size):
                    n = len(values)
                    pos = pa.array(np.arange(first, first + n, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([_repeated(path, n), _repeated(part, n), pos, values], names=["path", "part", "pos", "value"])

    pieces = placed.mapInArrow(cut, "path string, part string, pos bigint, value binary")
    edges = pieces.filter(F.length("value") < size).groupBy("path", "pos").agg(F.sort_array(F.collect_list(F.struct("part", "value"))).alias("_all"))
    joined = F.aggregate("_all", F.lit(b""), lambda done, p: F.concat(done, p["value"]))
    return pieces.filter(F.length("value") == size).select("path", "pos", "value").unionByName(edges.select("path", "pos", joined.alias("value")))


def repeat_to(chunks: DataFrame, messages: int) -> DataFrame:
    """Message ``pos`` of a file is its chunk ``pos % _n``, in as many whole passes as give ``messages``.

    ``chunks``: (path, _n, _chunk, value), ``_n`` being the file's number of chunks.
    """
    rounds = F.expr(f"({messages - 1}) div _n")
    pages = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(({messages - 1}) div _n) div {PAGE}"))
    # many repetitions of few chunks: spread the pages before they grow
    paged = chunks.withColumn("_page", F.explode(pages)).repartition("path", "_chunk", "_page")
    first = F.col("_page") * PAGE
    turn = F.explode(F.sequence(first, F.least(rounds, first + (PAGE - 1))))
    return paged.withColumn("_round", turn).select(
        "path", (F.col("_round") * F.col("_n") + F.col("_chunk")).alias("pos"), "value"
    )


def messages_per_file(files: DataFrame, size: int, messages: int | None = None) -> DataFrame:
    """Rows (path, _n): how many messages a file gives. Uses a ``length`` column, where there is one."""
    length = F.col("length") if "length" in files.columns else F.length("content").cast("bigint")
    chunks = F.ceil(length / size)
    sent = F.col("_c") if messages is None else F.ceil(F.lit(messages) / F.col("_c")) * F.col("_c")
    return files.select("path", chunks.alias("_c")).filter("_c > 0").select("path", sent.cast("bigint").alias("_n"))


def message_index(messages: DataFrame, per_file: DataFrame) -> DataFrame:
    """Add ``index``: 0, 1, 2 … over all messages, files by path, then by position in the file."""
    base = prefix_sum(per_file, "path", "_n").select("path", F.col("base").alias("_base"))
    return messages.join(small_side(base), "path").withColumn("index", F.col("_base") + F.col("pos")).drop("_base")


def partition_of(index: Column, partitions: int, weights=None) -> Column:
    """Weighted round robin as a formula of the message index: partition i gets w_i messages in a row."""
    given = list(weights or [])[:partitions]
    weights = given + [1] * (partitions - len(given))
    if min(weights) < 1:
        raise ValueError("weights must be at least 1")
    ends = [sum(weights[: i + 1]) for i in range(partitions)]
    slot = F.pmod(index, F.lit(ends[-1]))
    return F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda end: end <= slot)).cast("int")


def assign_partitions(df: DataFrame, partitions: int, weights=None, index: str = "index") -> DataFrame:
    """Add ``partition`` by weighted round robin."""
    return df.withColumn("partition", partition_of(F.col(index), partitions, weights))


def message_block(size: int) -> int:
    """Offsets of a block of messages of ``size`` bytes, so that a block has ``BLOCK_BYTES`` at most."""
    return max(1, min(BLOCK, BLOCK_BYTES // size))


def number_messages(df: DataFrame, index: str = "index", block: int = BLOCK) -> DataFrame:
    """Header ``message.number``: 1, 2, 3 … per partition, as text."""
    numbered = number_records(df, keys=["partition"], order=index, out="_number", block=block)
    if "headers" not in numbered.columns:
        numbered = numbered.withColumn("headers", F.array().cast(HEADERS_DDL))
    return add_header(numbered, MESSAGE_NUMBER_HEADER, F.col("_number").cast("string")).drop("_number")


def generate_log(
    files: DataFrame, topic: str, size: int, partitions: int, weights=None, messages: int | None = None
) -> DataFrame:
    """Messages of all files, keyed by file name, as rows of a log."""
    indexed = message_index(chunk_files(files, size, messages), messages_per_file(files, size, messages))
    return _as_log(indexed, topic, size, partitions, weights)


def generate_log_of_parts(parts: DataFrame, topic: str, size: int, partitions: int, weights=None) -> DataFrame:
    """``generate_log`` for files that come in parts (path, part, content)."""
    sizes = parts.groupBy("path").agg(F.sum(F.length("content").cast("bigint")).alias("length"))
    indexed = message_index(chunk_parts(parts, size), messages_per_file(sizes, size))
    return _as_log(indexed, topic, size, partitions, weights)


def _as_log(indexed: DataFrame, topic: str, size: int, partitions: int, weights) -> DataFrame:
    spread = assign_partitions(indexed, partitions, weights)
    return number_messages(spread, block=message_block(size)).select(
        F.lit(topic).alias("topic"),
        "partition",
        F.col("index").alias("offset"),
        F.lit(None).cast("bigint").alias("timestamp"),
        F.element_at(F.split("path", "/"), -1).cast("binary").alias("key"),
        "value",
        "headers",
    )
