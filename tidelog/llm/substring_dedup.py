"""Removal of word windows that an earlier document holds, by super-k-mer partitioning.

Every window of words has a minimiser: the smallest hash among the short word runs in it. Consecutive windows with the
same minimiser at the same place travel as one packed string, keyed by the minimiser, so equal windows meet in one
bucket at a fraction of the volume of all windows. A bucket is sorted by document; of every window its first document is
kept, and later documents' occurrences are reported. Windows are compared by their words, not by hashes.

A minimiser that a sample shows to be common would make a hot bucket. Its windows travel one by one, each keyed by its own
words, and a task sends each of them once: what it has sent for a smaller document needs no further comparison.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import release, slices, stored, table, window_hashes, word_hashes

WINDOW = 13
#: Words of the runs among which the minimiser is chosen.
RUN = 3
#: Passes over the input, each for a part of the minimisers: the shuffle of a pass is so much smaller.
PASSES = 2
#: Documents, about, from which common minimisers are estimated, and the share of all strings that makes one common.
SAMPLE_DOCS = 5_000
COMMON_SHARE = 1 / 2_000
#: Stands for a null identifier, which comes after all others.
LAST = (1 << 63) - 1

#: Windows of common minimisers that a task remembers.
REMEMBERED = 100_000

PACKED_DDL = "bucket bigint, doc bigint, version int, start int, words binary"
RANGE_DDL = "doc bigint, version int, start int, end int"


def super_kmers(texts: list[bytes], window: int = WINDOW, run: int = RUN):
    """Super-k-mers of ``texts``, whose words are joined by blanks.

    The texts joined by blanks; minimiser, text, first window, windows in all and first word of each super-k-mer (the
    last two as numbers of windows and of words of the joined texts); where each word begins and ends.
    """
    counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
    joined = b" ".join(t for t in texts if t)
    hashes = word_hashes(joined)
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    begins = np.append(0, ends[:-1] + 1)
    n = max(len(hashes) - window + 1, 0)
    if not n:
        none = np.empty(0, np.int64)
        return joined, none, none, none, none, none, begins, ends
    runs = window_hashes(hashes, run)
    place = _smallest(runs, window - run + 1)
    after = np.cumsum(counts)
    text = np.repeat(np.arange(len(texts)), counts)[:n]
    # windows over the end of a text are none
    whole = np.arange(n) + window <= after[text]
    fresh = whole.copy()
    fresh[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    first = np.flatnonzero(fresh)
    stop = np.flatnonzero(np.append(fresh | ~whole, True))
    last = stop[np.searchsorted(stop, first, "right")]
    own = text[first]
    return joined, runs[place[first]].view(np.int64), own, first - (after - counts)[own], last - first, first, begins, ends


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first of the smallest of ``width`` neighbours is, for every run of them."""
    n = len(values) - width + 1
    at, low = np.arange(n), values[:n].copy()
    for k in range(1, width):
        smaller = values[k : k + n] < low
        at[smaller] = np.flatnonzero(smaller) + k
        np.minimum(low, values[k : k + n], out=low)
    return at


def pack(docs: DataFrame, part: int = 0, parts: int = 1, window: int = WINDOW, common: frozenset = frozenset()) -> DataFrame:
    """Super-k-mers (``PACKED_DDL``) of ``doc``, ``version``, ``text`` whose minimisers belong to ``part``.

    Those of ``common`` minimisers are cut into windows. A row without words is a window known to be covered.
    """
    hot = np.array(sorted(common), np.int64)

    def rows(batches):
        sent: dict[bytes, int] = {}
        for batch in batches:
            for piece in slices(batch, "text"):
                doc, version = (piece.column(c).to_numpy() for c in ("doc", "version"))
                texts = [b" ".join((t or "").encode().split()) for t in piece.column("text").to_pylist()]
                joined, bucket, of, start, size, first, begins, ends = super_kmers(texts, window)
                mine = np.ones(len(bucket), bool) if parts == 1 else (bucket >> 7) % parts == part
                often = mine & np.isin(bucket, hot) if len(hot) else np.zeros(len(bucket), bool)
                if often.any():
                    yield _common_windows(often, of, start, size, first, begins, ends, joined, doc, version, sent, window)
                    if len(sent) > REMEMBERED:
                        sent.clear()
                for some in np.array_split(np.flatnonzero(mine & ~often), 1 + len(bucket) // 20_000):
                    # a string ends with the last word of its last window
                    spans = zip(begins[first[some]].tolist(), ends[(first + size)[some] + window - 2].tolist(), strict=True)
                    words = pa.array([joined[a:b] for a, b in spans], pa.binary())
                    yield _packed_batch(bucket[some], doc[of[some]], version[of[some]], start[some].astype(np.int32), words)

    return docs.mapInArrow(rows, PACKED_DDL)


def _packed_batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "doc", "version", "start", "words"])


def _common_windows(often, of, start, size, first, begins, ends, joined, doc, version, sent, window) -> pa.RecordBatch:
    """Windows of the super-k-mers ``often``, keyed by their words; without words if ``sent`` has them for a smaller document."""
    rows: list[tuple] = []
    for k in np.flatnonzero(often).tolist():
        own, seen_in = int(doc[of[k]]), int(version[of[k]])
        for i in range(int(size[k])):
            word = int(first[k]) + i
            words = joined[begins[word] : ends[word + window - 1]]
            key = int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)
            if sent.setdefault(words, own) < own:
                # nothing is left to find out, so it goes anywhere
                rows.append((key ^ own, own, seen_in, int(start[k]) + i, None))
            else:
                sent[words] = own
                rows.append((key, own, seen_in, int(start[k]) + i, words))
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return _packed_batch(*(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)))


def _covered(words: bytes, doc: int, seen: dict, window: int) -> list[tuple[int, int]]:
    """Ranges of words of a packed string covered by windows that smaller documents hold; notes new windows in ``seen``."""
    own = words.split(b" ")
    found: list[tuple[int, int]] = []
    for i in range(len(own) - window + 1):
        if seen.setdefault(b" ".join(own[i : i + window]), doc) < doc:
            if found and i <= found[-1][1]:
                found[-1] = (found[-1][0], i + window)
            else:
                found.append((i, i + window))
    return found


def bucket_ranges(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Covered ranges (``RANGE_DDL``) of super-k-mers; buckets of one document never leave the JVM."""
    same = Window.partitionBy("bucket")
    shared = packed.withColumn("low", F.min("doc").over(same)).withColumn("high", F.max("doc").over(same))
    rows = shared.filter("low < high OR words IS NULL").drop("low", "high").sortWithinPartitions("bucket", "doc")

    def ranges(batches):
        bucket, seen, whole = None, {}, {}
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "doc", "version", "start", "words")]
            for key, doc, version, start, words in zip(*columns, strict=True):
                if words is None:
                    out.append((doc, version, start, start + window))
                    continue
                if key != bucket:
                    bucket, seen, whole = key, {}, {}
                if whole.setdefault(words, doc) < doc:
                    # an earlier document has the same string, and so all its windows
                    out.append((doc, version, start, start + words.count(b" ") + 1))
                else:
                    out += [(doc, version, start + a, start + b) for a, b in _covered(words, doc, seen, window)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            found = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds, strict=True)], names=["doc", "version", "start", "end"])

    return rows.mapInArrow(ranges, RANGE_DDL)


def common_buckets(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, share: float = COMMON_SHARE) -> frozenset:
    """Minimisers of at least ``share`` of the strings of a sample, so never more than ``1 / share``. They steer the plan, not the result."""
    total = docs.count()
    if not total:
        return frozenset()
    sample = pack(docs.sample(min(1.0, sample_docs / total), seed=7)).groupBy("bucket").count()
    sample = stored(sample, "bucket-sample")
    strings = sample.agg(F.sum("count")).first()[0] or 0
    return frozenset(r["bucket"] for r in sample.filter(F.col("count") >= max(50, strings * share)).collect())


def dedup_windows(docs: DataFrame, window: int = WINDOW, passes: int = PASSES, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` as column ``row`` with ``kept`` (words left, joined by blanks), ``n_words`` and ``n_removed``.

    A word goes if a window over it also starts in a document with a smaller ``doc_id``; all windows are judged on the
    input. A null text has no words. A null ``doc_id`` comes after all others. Rows with one ``doc_id`` are one
    document: their windows do not count against each other. Texts shorter than a window stay.
    """
    keyed = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), F.hash("text").alias("version"), "text"
    )
    narrow = keyed.select("doc", "version", "text")
    common = common_buckets(narrow, sample_docs)
    ranges = None
    for part in range(passes):
        found = stored(bucket_ranges(pack(narrow, part, passes, window, common), window), "ranges")
        ranges = found if ranges is None else ranges.unionByName(found)
        # the next pass writes as much again
        release(docs.sparkSession, wait=2)
    per_doc = ranges.groupBy(F.col("doc").alias("_doc"), F.col("version").alias("_version")).agg(
        F.collect_list(F.struct("start", "end")).alias("ranges")
    )
    joined = keyed.join(per_doc, (F.col("doc") == F.col("_doc")) & (F.col("version") == F.col("_version")), "left").select("row", "text", "ranges")

    def without(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                kept, n_words, n_removed = [], [], []
                for text, ranges in zip(piece.column("text").to_pylist(), piece.column("ranges"), strict=True):
                    words = (text or "").encode().split()
                    n = len(words)
                    if ranges.is_valid:
                        flat = ranges.values.flatten()
                        edges = np.zeros(n + 1, np.int32)
                        np.add.at(edges, flat[0].to_numpy(), 1)
                        np.add.at(edges, flat[1].to_numpy(), -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
                    kept.append(b" ".join(words).decode())
                    n_words.append(n)
                    n_removed.append(n - len(words))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                    names=["row", "kept", "n_words", "n_removed"],
                )

    out = T.StructType([keyed.schema["row"]]).add("kept", T.StringType()).add("n_words", T.LongType()).add("n_removed", T.LongType())
    return joined.mapInArrow(without, out)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_windows(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_SPACE = "\\x20\\x09-\\x0D"
OP9_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS ws FROM documents),
x AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 0) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM x),
f AS (SELECT g, min(doc_id) AS first_id FROM g GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS at FROM g JOIN f ON g.g = f.g WHERE first_id < doc_id),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS at FROM w),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.at) AS kept, count(*) AS n
      FROM e LEFT JOIN c ON e.doc_id = c.doc_id AND e.at = c.at WHERE c.at IS NULL GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
