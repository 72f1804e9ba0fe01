"""Near-duplicate classes of documents by BagMinHash over multisets of word shingles.

A shingle of weight w takes part in the Poisson processes on (0, 1], (1, 2], (2, 4] ... up to w, of the last of which it
keeps the points below w. A signature component is the earliest point that falls to it, so two documents agree in a
component with the probability of their weighted Jaccard similarity. Bands of components make buckets.

Buckets are worked off without listing their pairs. First a pivot of each bucket, the member that shares most with others,
is compared with the rest, then a few more pivots where several classes are left. Groups of near copies are one class by
then. What is left are crowds of texts that are alike but below the threshold: their members get longer signatures, which
are compared in blocks inside tasks, and only pairs that could be a link by them come out. Every pair that comes out of
either way is verified on its whole multisets, and no two classes of a bucket are left uncompared.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import mix, slices, stored, table, window_hashes, word_hashes
from tidelog.llm.components import components

SHINGLE_WORDS = 5
#: Weighted Jaccard similarity of a link, as a fraction.
SIMILARITY = (4, 5)
COMPONENTS = 240
#: At a similarity of 0.8 a pair misses all forty bands with a probability of 5e-6.
BAND = 6
#: Pivots of the first rounds.
PIVOTS = (1, 3)
#: Components of a crowd's signatures, of which a byte each is compared, and how many need to be equal: at a similarity of
#: 0.8 a pair has fewer with a probability of 2e-6.
CROWD_COMPONENTS = 1024
EQUAL = 761
#: Members of a crowd, about, whose signatures a task holds as one block.
CROWD_BLOCK = 512

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 0xD1B54A32D192ED03


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the runs of ``size`` words of a text; a shorter text is one run."""
    words = word_hashes((text or "").encode())
    return window_hashes(words, size if len(words) >= size else max(len(words), 1))


def multiset(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(text), return_counts=True)


def similar(one: tuple, other: tuple, least: tuple[int, int] = SIMILARITY) -> bool:
    """Whether the sum of the smaller weights is at least ``least`` of the sum of the larger ones."""
    _, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(one[1][i], other[1][j]).sum())
    return both > 0 and both * least[1] >= (int(one[1].sum()) + int(other[1].sum()) - both) * least[0]


def bag_signatures(bags: Sequence[np.ndarray], size: int = COMPONENTS) -> np.ndarray:
    """Signatures of multisets of 64-bit values, a row each: the earliest times, infinite for an empty multiset."""
    first = np.full(len(bags) * size, np.inf)
    of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    values = np.concatenate(bags) if len(bags) else np.empty(0, np.uint64)
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    head = np.flatnonzero(np.concatenate([[True], (values[1:] != values[:-1]) | (of[1:] != of[:-1])])) if len(values) else np.empty(0, np.int64)
    weights = np.diff(np.append(head, len(values)))
    of, values = of[head], values[head]
    # one process for each element and level of the weights that it reaches
    parts, level, low, width = [], 0, 0, 1
    while len(weights) and (reach := np.flatnonzero(weights > low)).size:
        seed = mix(values[reach] ^ np.uint64((_LEVEL * (level + 1)) & ((1 << 64) - 1)))
        share = np.minimum(1.0, (weights[reach] - low) / width)
        parts.append((seed, of[reach], np.full(len(reach), 1.0 / (width * size)), share))
        level, low, width = level + 1, low + width, low + width
    if not parts:
        return first.reshape(len(bags), size)
    seed, of, step, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    time, point = np.zeros(len(seed)), 0
    scale = 2.0**-53
    while len(seed):
        point += 1
        x = mix(seed + np.uint64(point * int(_GOLDEN) & ((1 << 64) - 1)))
        y = mix(x ^ _GOLDEN)
        time = time - np.log1p(-((x >> np.uint64(11)) * scale)) * step
        mine = ((y >> np.uint64(11)) * scale) < share
        np.minimum.at(first, of[mine] * size + (y[mine] % np.uint64(size)).astype(np.int64), time[mine])
        go_on = time < first.reshape(len(bags), size).max(axis=1)[of]
        seed, of, step, share, time = (a[go_on] for a in (seed, of, step, share, time))
    return first.reshape(len(bags), size)


def bands(signatures: np.ndarray, rows: int = BAND) -> np.ndarray:
    """64-bit bucket numbers of the bands of every signature."""
    bits = mix(np.ascontiguousarray(signatures).view(np.uint64)).reshape(len(signatures), -1, rows)
    out = np.broadcast_to(np.arange(bits.shape[1], dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(rows):
        out = mix(out * _GOLDEN + bits[:, :, k])
    return out.view(np.int64)


def sketches(texts: DataFrame) -> DataFrame:
    """``key``, ``sketch`` and ``bands`` of ``texts`` (``key``, ``text``): a byte of every component of a long signature, and the buckets."""

    def sketch(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                bags = [shingles(t) for t in part.column("text").to_pylist()]
                short = (mix(bag_signatures(bags, CROWD_COMPONENTS).view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                both = [[x.tobytes() for x in rows] for rows in (short, bands(bag_signatures(bags)))]
                yield pa.RecordBatch.from_arrays([part.column("key"), *(pa.array(x, pa.binary()) for x in both)], names=["key", "sketch", "bands"])

    return texts.select("key", "text").mapInArrow(sketch, "key binary, sketch binary, bands binary")


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (hash of the text), ``n`` (shingles) and ``buckets`` of ``docs``; a text without words has none."""

    def sign(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                bags = [shingles(t) for t in part.column("text").to_pylist()]
                found = bands(bag_signatures(bags))
                lists = [b.tolist() if len(bag) else [] for b, bag in zip(found, bags, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array([len(b) for b in bags], pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                    names=["doc_id", "key", "n", "buckets"],
                )

    return keyed(docs).mapInArrow(sign, "doc_id bigint, key binary, n bigint, buckets array<bigint>")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"), "text")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (keys ``a``, ``b``) whose ``texts`` (``key``, ``text``) are similar, by their whole multisets."""
    one, other = (texts.select(F.col("key").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    # never a broadcast, as either side grows with the documents
    both = pairs.join(other.hint("merge"), "b").join(one.hint("merge"), "a").sortWithinPartitions("a")

    def check(batches):
        last, bag = None, None
        for batch in batches:
            a, b, good = batch.column("a"), batch.column("b"), []
            for i in range(batch.num_rows):
                if (key := a[i].as_py()) != last:
                    last, bag = key, multiset(batch.column("text_a")[i].as_py())
                if similar(bag, multiset(batch.column("text_b")[i].as_py())):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([a.take(pa.array(good, pa.int64())), b.take(pa.array(good, pa.int64()))], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def _alike(table: pa.Table, bucket: int, own: int, other: int) -> pa.Table:
    """Pairs between two blocks of a bucket (or inside one) with different labels and enough equal components.

    A pair comes out of the first of its common buckets only. If that one is worked off, the pair was compared there.
    """
    keys, labels = table.column("key").to_pylist(), np.unique(table.column("label").to_pylist(), return_inverse=True)[1]
    short = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(keys), -1)
    banded = np.frombuffer(b"".join(table.column("bands").to_pylist()), np.int64).reshape(len(keys), -1)
    size, block = table.column("n").to_numpy(), table.column("block").to_numpy()
    least, whole = SIMILARITY
    found: list[tuple] = []
    here, there = np.flatnonzero(block == own), np.flatnonzero(block == other)
    for i in here.tolist():
        rest = there[there > i] if own == other else there
        rest = rest[(labels[rest] != labels[i]) & (size[rest] * whole >= size[i] * least) & (size[i] * whole >= size[rest] * least)]
        rest = rest[(short[rest] == short[i]).sum(axis=1) >= EQUAL]
        rest = rest[banded[i][(banded[rest] == banded[i]).argmax(axis=1)] == bucket]
        for j in rest.tolist():
            found.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
    columns = zip(*found, strict=True) if found else [[], []]
    return pa.table([pa.array(list(c), pa.binary()) for c in columns], names=["a", "b"])


def crowd_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (``a``, ``b``) that may be links among ``rows`` (``bucket``, ``key``, ``n``, ``label``, ``sketch``, ``bands``, ``members``: size of the bucket)."""
    blocks = F.ceil(F.col("members") / CROWD_BLOCK).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.hash("key"), blocks)).withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))

    def alike(key, table):
        return _alike(table, *(k.as_py() for k in key))

    return dealt.groupBy("bucket", "low", "high").applyInArrow(alike, "a binary, b binary")


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (``node``, ``label``; other nodes are their own) after ``links`` (``a``, ``b``) have joined classes."""
    if labels is None:
        return components(links)
    old = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
    between = links.join(old("a"), "a", "left").join(old("b"), "b", "left")
    between = between.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a <> b")
    moves = components(between)
    known = labels.unionByName(moves.select("node", F.col("node").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    renamed = moves.select(F.col("node").alias("label"), F.col("label").alias("new"))
    return stored(known.join(renamed, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "classes")


def _active(buckets: DataFrame, labels: DataFrame | None, used: int) -> DataFrame:
    """Rows of buckets that hold several classes and members beyond the pivots that were used, with ``label`` and ``members``."""
    rows = buckets.withColumn("label", F.col("key"))
    if labels is not None:
        rows = buckets.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    many = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    many = many.filter((F.col("low") != F.col("high")) & (F.col("members") > used + 1)).select("bucket", "members")
    return stored(rows.join(many, "bucket"), "buckets")


def link_buckets(buckets: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Classes (``node``, ``label``) that the links between members of common buckets make, None if there is no bucket.

    ``buckets``: ``bucket``, ``key``, ``n``. Pairs whose sizes alone forbid the similarity are not compared.
    """
    labels, tested, used = None, None, 0
    # the sum of the sizes of a member's buckets tells how much it shares with others
    shared = Window.partitionBy("bucket").orderBy(F.col("weight").desc(), "key")
    weights = buckets.join(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "bucket").groupBy("key").agg(F.sum("size").alias("weight"))
    buckets = stored(buckets.join(weights, "key"), "buckets")
    least, whole = SIMILARITY
    for pivots in PIVOTS:
        rows = _active(buckets, labels, used)
        if not rows.limit(1).count():
            return labels
        buckets = rows.drop("label", "members")
        # the limit on the rank holds in each task before the shuffle
        chosen = rows.withColumn("rank", F.row_number().over(shared)).filter(F.col("rank") <= used + pivots).filter(F.col("rank") > used)
        chosen = chosen.select("bucket", F.col("key").alias("a"), F.col("n").alias("pivot_n"), F.col("label").alias("pivot_label"))
        near = (F.col("n") * whole >= F.col("pivot_n") * least) & (F.col("pivot_n") * whole >= F.col("n") * least)
        pairs = rows.join(chosen, "bucket").filter((F.col("label") != F.col("pivot_label")) & near).select("a", F.col("key").alias("b")).distinct()
        if tested is not None:
            # other buckets have brought them together before
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = both if tested is None else tested.unionByName(both)
        labels = _merged(labels, verified(pairs, texts))
        used += pivots
    rows = _active(buckets, labels, used)
    if not rows.limit(1).count():
        return labels
    long = stored(sketches(texts.join(rows.select("key").distinct(), "key", "left_semi")), "sketches")
    pairs = stored(crowd_pairs(rows.join(long, "key")).join(tested, ["a", "b"], "left_anti"), "pairs")
    return _merged(labels, verified(pairs, texts))


def near_classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``label``, ``class_id`` and ``class_size`` of every row of ``docs`` (``doc_id``, ``text``).

    A class is a connected component of links: equal texts, or a weighted Jaccard similarity of at least 0.8 between
    multisets of five-word shingles. Its ``class_id`` is its smallest ``doc_id`` (null only if all are). A text of fewer
    words is one shingle. A null text, or one without words, is in a class of its own, of size 1. Repeated rows are copies.
    ``label`` names the class by the hash of one of its texts; it is null for a document without words.
    """
    signatures = stored(signed(docs), "signatures")
    texts = signatures.groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("buckets").alias("buckets")
    )
    rows = texts.select(F.explode("buckets").alias("bucket"), "key", "n")
    crowded = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("bucket")
    buckets = stored(rows.join(crowded, "bucket"), "buckets")
    wanted = stored(buckets.select("key").distinct().join(texts.select("key", "doc_id"), "key"), "members")
    same = (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    bodies = keyed(docs).join(wanted.select(F.col("key").alias("_key"), F.col("doc_id").alias("_doc")).hint("merge"), same, "left_semi")
    bodies = stored(bodies.select("key", "text"), "texts")
    labels = link_buckets(buckets, bodies)
    found = signatures.select("doc_id", "key", "n")
    if labels is None:
        found = found.withColumn("label", F.col("key"))
    else:
        found = found.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    classes = found.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_size"))
    joined = found.withColumn("label", F.when(F.col("n") > 0, F.col("label"))).join(classes, "label", "left")
    own = F.col("n") > 0
    return joined.select(
        "doc_id", "key", "label", F.when(own, F.col("_first")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(own, F.col("_size")).otherwise(F.lit(1)).alias("class_size"),
    )


def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "class_id", "class_size")
