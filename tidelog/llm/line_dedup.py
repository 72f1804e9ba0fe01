"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A batch's line hashes are aggregated, merge-anti-joined with
the runs that earlier batches left, and written as a run of their own: a table bucketed and sorted by hash. ``fanout``
runs of a level are compacted into one of the next, so there are few runs however many batches come. A line that enough
documents hold loses all its copies except those in the document with the largest id.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import SPACE_CHARS, scratch, slices, stored, table

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3

_SPACE = SPACE_CHARS.encode()


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of a line without outer white space and with A-Z lowered; None if it has under ``min_chars`` code points."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` and ``key`` of every long line, once a row of ``docs``."""

    def keys(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                ids, found = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = {line_key(x, min_chars) for x in (text or "").encode().split(b"\n")} - {None}
                    ids += [doc_id] * len(own)
                    found += own
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], names=["doc_id", "key"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(keys, "doc_id bigint, key binary")


class LineRuns:
    """The runs: ``key``, ``n_docs``, ``top_doc`` (largest id, null below all)."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, "key").sortWithinPartitions("key").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", scratch(self.spark, name)).saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> None:
        """Take in a batch (``doc_id``, ``key``) whose ids are below those of all earlier batches."""
        docs = F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))
        fresh = keys.groupBy("key").agg(docs.cast("bigint").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        for run in self.runs():
            # a line that earlier batches have settled needs no more counting
            fresh = fresh.join(run.filter(F.col("n_docs") >= self.min_docs), "key", "left_anti")
        self._place(0, self._write(fresh))

    def _place(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged = self._write(self._merge([self.spark.table(x) for x in self.levels[level]]))
            for old in self.levels[level]:
                self.spark.sql(f"DROP TABLE {old}")
            self.levels[level] = []
            self._place(level + 1, merged)

    def close(self) -> None:
        """Forget the runs' tables."""
        for name in [x for level in self.levels for x in level]:
            self.spark.sql(f"DROP TABLE {name}")
        self.levels = []

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        # keys are unique in a run, and all runs are bucketed and sorted alike: a merge, with no shuffle
        merged = runs[0]
        for run in runs[1:]:
            other = run.select("key", F.col("n_docs").alias("n"), F.col("top_doc").alias("top"))
            total = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))
            merged = merged.join(other, "key", "full").select("key", total.alias("n_docs"), F.greatest("top_doc", "top").alias("top_doc"))
        return merged

    def settled(self) -> DataFrame:
        """``key`` and ``top_doc`` of the lines that enough documents hold."""
        return self._merge(self.runs()).filter(F.col("n_docs") >= self.min_docs).select("key", "top_doc")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` as column ``row`` (a struct), with its ``text`` after the dedup, ``n_lines`` before it and ``n_dropped``.

    A null text is one empty line and stays null. A null ``doc_id`` is one document below all others. Rows with one
    ``doc_id`` count as one document and are treated alike. A document that loses all lines has an empty text.
    """
    spark = docs.sparkSession
    keys = stored(line_keys(docs, min_chars), "line-keys")
    # a few quantiles of the ids, as bounds of the batches; any bounds give the same result
    cuts = keys.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
    edges = [None, *sorted({int(x) for x in cuts}, reverse=True), None]
    runs = LineRuns(spark, min_docs)
    for high, low in zip(edges, edges[1:], strict=False):
        mine = F.lit(True) if low is None else F.col("doc_id") >= low
        if high is not None:
            mine &= F.col("doc_id") < high
        runs.add(keys.filter(mine | F.col("doc_id").isNull() if low is None else mine))
    settled = stored(runs.settled(), "line-settled")
    runs.close()
    drop = keys.join(settled, "key").filter(~F.col("doc_id").eqNullSafe(F.col("top_doc")))
    drop = drop.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("key").alias("drop"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("_doc"), "text")
    joined = rows.join(drop, F.col("_doc").eqNullSafe(F.col("_id")), "left").select("row", "text", "drop")

    def without(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                texts, lines, dropped = [], [], []
                for text, drop in zip(part.column("text").to_pylist(), part.column("drop"), strict=True):
                    own = (text or "").encode().split(b"\n")
                    kept = own
                    if drop.is_valid:
                        gone = set(drop.as_py())
                        kept = [x for x in own if line_key(x, min_chars) not in gone]
                        text = b"\n".join(kept).decode()
                    texts.append(text)
                    lines.append(len(own))
                    dropped.append(len(own) - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                    names=["row", "text", "n_lines", "n_dropped"],
                )

    out = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    return joined.mapInArrow(without, out.add("n_lines", T.LongType()).add("n_dropped", T.LongType()))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", kept)


_SQL_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_SQL_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
j AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.top AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, CAST(max(n) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
