"""Packing of token pieces into sequences by a configuration linear program.

What fits together depends on lengths alone, so the program is over the histogram of lengths: how often to use each
configuration (a multiset of lengths that fits a sequence) so that all pieces are covered by the fewest. Multiplicative
weights give every length a price, a knapsack dynamic program finds the configurations of highest price, and those within
a small factor of the best are used a little more. The solution is rounded to whole uses, what is left is filled best
fit first, and the pieces of a length are dealt to its places by their rank. The driver holds the histogram and the
plan, whose sizes depend on the sequence length only.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import slices, stored, table

SEQUENCE = 2048
END_ID = 0
#: Rounds of multiplicative weights, their rate, and how near to the best price a configuration must be.
ROUNDS = 24
RATE = 4.0
#: Price that a piece loses, so that of equally full configurations that of fewer pieces is used.
FEW = 1e-3
SLACK = 0.0002
#: Pieces that one window ranks, about.
BUCKET_ROWS = 4_096


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_encoders: dict = {}


def encoder(path: str):
    """Byte-level BPE of the file of ranks at ``path``, with the added tokens of the ``.json`` beside it.

    With ``allowed_special="all"`` it gives the ids that the tokenizers library gives for that file, several times faster.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as file:
            added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
        _encoders[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return _encoders[path]


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """Starts and lengths of the pieces of ``n`` ids: whole ones, but for the first, which takes what is over."""
    first = n % size or min(n, size)
    edges = [0, *range(first, n + 1, size)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def token_pieces(docs: DataFrame, path: str, size: int = SEQUENCE, ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` of every piece of ``docs`` (``doc_id``, ``text``).

    A document is its text's ids and then the end id. A null text is empty, so it is the end id alone. Every row of
    ``docs`` is a document of its own, also one whose ``doc_id`` is null or repeated.
    """

    def pieces(batches):
        encode = encoder(path).encode
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []
                held = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = np.array([*encode(text or "", allowed_special="all"), END_ID], "<u4")
                    for i, (start, length) in enumerate(cut(len(own), size)):
                        piece = own[start : start + length]
                        rows.append((doc_id, i, start, length, zlib.crc32(piece.tobytes())))
                        if ids:
                            held.append(piece.astype(np.int32))
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    columns, names = [*columns, pa.array(held, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces, ddl)


def _best_fill(prices: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``size`` the highest price of ``lengths`` (ascending) that fit it, and the index of the longest with which to begin (-1: none)."""
    best, choice = np.zeros(size + 1, prices.dtype), np.full(size + 1, -1)
    upto = np.searchsorted(lengths, np.arange(size + 1), "right")
    for room in range(1, size + 1):
        fits = upto[room]
        if fits:
            values = (best[room - lengths[:fits]] + prices[:fits])[::-1]
            top = int(values.argmax())
            best[room], choice[room] = values[top], fits - 1 - top
        if best[room - 1] > best[room]:
            best[room], choice[room] = best[room - 1], -1
    return best, choice


def _fill(choice: np.ndarray, lengths: np.ndarray, room: int) -> list[int]:
    """Indexes of the lengths of the best fill of ``room``."""
    found = []
    while room > 0:
        i = int(choice[room])
        if i < 0:
            room -= 1
        else:
            found.append(i)
            room -= int(lengths[i])
    return found


def fractional(counts: dict[int, int], size: int = SEQUENCE, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Uses of configurations (tuples of lengths) that cover ``counts`` in part or whole, by multiplicative weights.

    In every round each length may be covered a little further; a configuration is used as often as none of its lengths
    gets ahead of that.
    """
    lengths = np.array(sorted(counts), np.int64)
    need = np.array([counts[x] for x in lengths.tolist()], float)
    covered, uses = np.zeros(len(lengths)), Counter()
    for turn in range(rounds if counts else 0):
        done = turn / rounds
        limit = min(1.0, done + 2 / rounds)
        # a length is worth its room, less where it is covered beyond the others, and nothing at the limit
        prices = (lengths / size - FEW) * np.exp(-RATE * (covered - done)) * (covered < limit - 1e-9)
        best, choice = _best_fill(prices, lengths, size)
        values = prices + best[size - lengths]
        for seed in np.flatnonzero((values >= best[size] * (1 - SLACK)) & (covered < limit))[::-1].tolist():
            items = Counter([seed, *_fill(choice, lengths, size - int(lengths[seed]))])
            at, each = np.array(list(items)), np.array(list(items.values()), float)
            times = float(((limit - covered[at]) * need[at] / each).min())
            if times > 0:
                covered[at] += times * each / need[at]
                uses[tuple(sorted(lengths[list(items.elements())].tolist(), reverse=True))] += times
    return dict(uses)


def whole_plan(counts: dict[int, int], size: int = SEQUENCE, rounds: int = ROUNDS) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how often each is used, so that every piece has exactly one place."""
    left = Counter(counts)
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(items: tuple[int, ...], times: int) -> None:
        own = Counter(items)
        times = min([times, *(left[x] // n for x, n in own.items())])
        if times > 0:
            plan.append((items, times))
            for x, n in own.items():
                left[x] -= n * times

    uses = fractional(counts, size, rounds)
    for items, times in uses.items():
        use(items, int(times))
    # one more of those that lost most by rounding, if they are nearly full and their pieces are left
    for items, _ in sorted(uses.items(), key=lambda x: (-(x[1] - int(x[1])), x[0])):
        if sum(items) >= size * (1 - SLACK):
            use(items, 1)
    _rest(left, use, size)
    return plan


def _rest(left: Counter, use, size: int) -> None:
    """Use configurations until nothing is ``left``: the longest piece first, then each time the longest that fits."""
    rest = sorted(x for x, n in left.items() if n)
    while rest:
        items, room = Counter(), size
        at = len(rest)
        while (at := bisect_right(rest, room, 0, at)) > 0:
            x = rest[at - 1]
            n = min(room // x, left[x])
            items[x] += n
            room -= n * x
            at -= 1
        use(tuple(sorted(items.elements(), reverse=True)), max(left.values()))
        rest = [x for x in rest if left[x]]


class Places:
    """For every length, where the pieces of each rank go."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: Counter = Counter()
        sequence = 0
        for items, times in plan:
            offset = 0
            for x, n in Counter(items).items():
                rows.setdefault(x, []).append((used[x], n, sequence, offset))
                used[x] += n * times
                offset += x * n
            sequence += times
        self.sequences = sequence
        self.by_length = {x: np.array(r, np.int64).T for x, r in rows.items()}

    def of(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, each, sequence, offset = self.by_length[length]
        at = np.searchsorted(first, ranks, "right") - 1
        within = ranks - first[at]
        return sequence[at] + within // each[at], offset[at] + within % each[at] * length


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``size``) with ``sequence_id`` and ``offset``; pass a stored table, it is read several times."""
    if {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError("the pieces have a column sequence_id or offset already")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark = pieces.sparkSession
    places = spark.sparkContext.broadcast(Places(whole_plan(counts, size)))
    # ranks among equal lengths: inside buckets, then one row per bucket carries the earlier buckets' counts
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))
    rows = pieces.select(F.struct("*").alias("row"), "length", F.xxhash64(*[c for c in pieces.columns if c != "ids"]).alias("hash"))
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("hash")) - 1
    ranked = rows.withColumn("inside", inside).join(before, ["length", "bucket"])
    ranked = ranked.select("row", "length", (F.col("before") + F.col("inside")).alias("rank"))

    def place(batches):
        own = places.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length).tolist():
                mine = length == x
                sequence[mine], offset[mine] = own.of(x, rank[mine])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"])

    from pyspark.sql import types as T

    out = T.StructType([rows.schema["row"]]).add("sequence_id", T.LongType()).add("offset", T.LongType())
    return ranked.mapInArrow(place, out).select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, ids: bool = False) -> DataFrame:
    return pack(stored(token_pieces(docs, path or vocabulary_path(), size, ids), "pieces"), size)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
