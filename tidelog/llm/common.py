"""What the operators of this package share: tables, scratch tables, words and their hashes."""

from __future__ import annotations

import gc
import time
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidelog.session import scratch

#: A word, wherever this package counts words: only ASCII white space divides words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"

#: Bytes that the vectorised steps look at together; their memory is a small multiple of it.
BLOCK_BYTES = 1 << 18

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: Folders of the tables that are stored.
_paths: dict[int, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, safe against lost executors."""
    spark, schema = df.sparkSession, df.schema
    path = scratch(spark, label)
    df.write.parquet(path, compression=codec)
    del df
    release(spark)
    out = spark.read.schema(schema).parquet(path)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, where nothing that is still to run reads it."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(_paths.pop(id(df)))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)



def release(spark: SparkSession, wait: float = 0) -> None:
    """Let Spark drop the shuffle files that no plan refers to any more.

    Its cleaner acts when the driver's JVM collects garbage, which a driver that only plans does rarely. The JVM learns
    within a second or so which plans Python has let go; ``wait`` for it where files of just now are to go.
    """
    gc.collect()
    time.sleep(wait)
    spark.sparkContext._jvm.System.gc()


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 * BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` in which ``column`` holds about ``limit`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: dict = {}


def _powers(n: int):
    """Values of bytes, and powers of an odd number and of its inverse modulo 2**64."""
    if n > _tables.get("n", 0):
        n = max(n, BLOCK_BYTES + 4096)
        base, inverse = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
        up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
        for out, by in ((up, base), (down, inverse)):
            out[:] = np.uint64(by)
            out[0] = 1
            np.multiply.accumulate(out, out=out)
        _tables.update(n=n, up=up, down=down, byte=mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD)))
    return _tables["byte"], _tables["up"], _tables["down"]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the words of ``data`` (unsigned bytes) and the bytes after their ends."""
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``text``, in order; the memory besides them is bounded, however long the text is."""
    if not text:
        return np.empty(0, np.uint64)
    out, start = [], 0
    while start < len(text):
        end = min(start + BLOCK_BYTES, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        data = np.frombuffer(text, np.uint8, end - start, start)
        out.append(_hash_spans(data, *word_spans(data)))
        start = end
    return out[0] if len(out) == 1 else np.concatenate(out)


def _hash_spans(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    byte, up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(byte[data] * up[: len(data)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(_ODD))


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all ``texts`` one after another, and where each text's words begin (one more entry)."""
    parts = [word_hashes(t.as_py().encode() if t.is_valid else b"") for t in texts]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), bounds


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; entry i is for the run that begins at word i."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(total + np.uint64(size))
