"""Removal of byte strings that an earlier document holds, by distributed prefix doubling.

Suffixes are sorted by Spark: first by their leading ``START`` bytes, then by pairs of ranks at growing offsets, and
ranked anew after every sort, until their rank is unique or stands for ``threshold`` bytes. Ranking all positions of a
corpus would move many times its volume, so positions that need no sort leave before:

1. Every window of ``threshold`` bytes has an anchor, the least hash among its strings of half that length. Equal windows
   have equal anchors at the same place. Consecutive windows with one anchor travel together, as a stretch, and anchors of
   a single document are unique: their windows leave.
2. A stretch that a smaller document holds as a whole is a hit; so are all stretches of whole copies. Of the first
   document that holds it, a stretch is settled unless another one, of another first document, shares its anchor. Both
   steps are done again for what is left, with longer anchors.
3. What then is left, mostly the edges of shared passages, is sorted position by position.

All groupings are by content or its 128-bit names. Stretches are many and small, so they travel in packed arrays, a row
per bucket of hashes and some megabytes of text, and are judged there. Anchors that a sample shows to be common are
spread over buckets: of these only hits are settled at once, the rest goes on. Joins with hot keys are split by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import BLOCK_BYTES, _powers, discard, mix, release, slices, stored, table

THRESHOLD = 50
#: Lengths of the anchors of documents, and of those of the stretches that are left, as shares of the threshold.
ANCHOR = 0.5
LONG_ANCHOR = 0.8
#: Bytes that the first sort of positions looks at.
START = 25
#: Documents, about, from which common anchors are estimated, and the share of all anchors that makes one common.
SAMPLE_DOCS = 5_000
COMMON_SHARE = 1 / 2_000
#: Buckets, at most, that a common anchor's stretches are spread over, and those that equal ones are spread over.
SALTS = 1_000
SPREAD = 16
#: Stands for a null identifier, which comes after all others.
LAST = (1 << 63) - 1

#: Stretches that a task packs together, and those of a bucket, about, which a task looks at together.
PACK_ROWS = 1_000_000
BUCKET_ROWS = 500_000
#: Rows that a task hands over at once, and documents, about, whose stretches travel together.
ROWS = 50_000
PART_DOCS = 2_048

_LENGTH = 1 << 10  # a stretch and its place go into one number; stretches are far shorter than this


def stretches(texts: list[bytes], anchor: int, threshold: int = THRESHOLD):
    """Runs of windows with one anchor: text, first window, number of windows, anchor's hash, hash of the whole stretch."""
    found = []
    pieces, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - threshold + 1, BLOCK_BYTES):
            piece = text[at : at + BLOCK_BYTES + threshold - 1]
            if size + len(piece) > BLOCK_BYTES and pieces:
                found.append(_stretches(pieces, anchor, threshold))
                pieces, size = [], 0
            pieces.append((i, at, piece))
            size += len(piece)
    if pieces:
        found.append(_stretches(pieces, anchor, threshold))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _stretches(pieces, anchor: int, threshold: int):
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    n, lengths = len(data), np.array([len(p) for _, _, p in pieces])
    ends = np.cumsum(lengths)
    byte, up, down = _powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(byte[data] * up[:n], out=sums[1:])
    hashes = mix((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
    # the least hash of every window, the first of equal ones; the low bits of a key are its place
    low = np.uint64((1 << 20) - 1)
    least, width, size = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), threshold - anchor + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    owner = np.repeat(np.arange(len(pieces)), lengths)[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + threshold <= ends[owner])
    place, owner = (least[windows] & low).astype(np.int64), owner[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(windows)))
    start, place, owner = windows[first], place[first], owner[first]
    stop = start + counts - 1 + threshold
    # the anchor's place within the stretch is a part of the name: equal bytes with other anchors have other windows
    spread = (stop - start).astype(np.uint64) * np.uint64(_LENGTH) + (place - start).astype(np.uint64)
    names = mix((sums[stop] - sums[start]) * down[start] + mix(spread + np.uint64(1)))
    starts = ends - lengths
    texts, offsets = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    return texts[owner], start - starts[owner] + offsets[owner], counts, hashes[place].view(np.int64), names.view(np.int64)


def anchor_bytes(share: float, threshold: int) -> int:
    return max(1, int(share * threshold))


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _rows(batch: pa.RecordBatch):
    """Rows as dicts; few at a time, as a packed row is large."""
    for k in range(0, batch.num_rows, 64):
        yield from batch.slice(k, 64).to_pylist()


def _bytes(texts: pa.Array) -> list[bytes]:
    return [x if isinstance(x, bytes) else (x or "").encode() for x in texts.to_pylist()]


PACKED = {"h": np.uint64, "name": np.uint64, "start": np.uint32, "count": np.uint16, "new": np.uint8, "docs": np.int64, "versions": np.int64}
PACKED_DDL = "bucket bigint, " + ", ".join(f"{c} binary" for c in PACKED) + ", bytes binary"
FOUND = {"docs": np.int64, "versions": np.int64, "at": np.int64}
FOUND_DDL = "part bigint, hit boolean, n bigint, " + ", ".join(f"{c} binary" for c in FOUND)
LEFT_DDL = FOUND_DDL + ", doc bigint, version bigint, first bigint, bytes binary"


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows of ``columns`` begin."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.append(True, new)) if len(columns[0]) else np.empty(0, np.int64)


def _packed(arrays, texts, common: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Stretches by buckets of their anchors' hashes: ``arrays`` are hashes, names, first windows, numbers of windows, and
    the documents and versions. ``texts`` has the bytes of all, or is None. Common anchors have many buckets below 0."""
    h, name, _, _, doc, _ = arrays
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    hot = np.isin(h.view(np.int64), common)
    bucket[hot] = -1 - (mix(h[hot] ^ name[hot] + (doc[hot] % SPREAD).astype(np.uint64)) % np.uint64(SALTS)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, (h, name, start, count, doc, version) = bucket[order], [x[order] for x in arrays]
    first = _runs(bucket)
    new = np.zeros(len(bucket), bool)
    new[_runs(doc, version)] = True
    new[first] = True
    columns, blobs = {c: [] for c in PACKED}, []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
        heads = a + np.flatnonzero(new[a:b])
        own = {"h": h[a:b], "name": name[a:b], "start": start[a:b], "count": count[a:b], "new": new[a:b], "docs": doc[heads], "versions": version[heads]}
        for c, kind in PACKED.items():
            columns[c].append(own[c].astype(kind, copy=False).tobytes())
        blobs.append(None if texts is None else b"".join([texts[k] for k in order[a:b].tolist()]))
    return _batch(["bucket", *PACKED, "bytes"], bucket[first], *[pa.array(columns[c], pa.binary()) for c in PACKED], pa.array(blobs, pa.binary()))


def _anchors(texts: DataFrame, threshold: int, common: np.ndarray, buckets: int) -> DataFrame:
    """The stretches of all texts, packed: a row has those of some texts whose anchors fall into one bucket."""

    def emit(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                i, start, count, h, name = stretches(_bytes(part.column("text")), anchor_bytes(ANCHOR, threshold), threshold)
                held.append((h.view(np.uint64), name.view(np.uint64), start, count, *(part.column(c).to_numpy()[i] for c in ("doc", "version"))))
                size += len(h)
                if size > PACK_ROWS:
                    yield _packed([np.concatenate(x) for x in zip(*held, strict=True)], None, common, buckets)
                    held, size = [], 0
        if size:
            yield _packed([np.concatenate(x) for x in zip(*held, strict=True)], None, common, buckets)

    return texts.select("doc", "version", "text").mapInArrow(emit, PACKED_DDL)


def _sub_stretches(pieces: DataFrame, threshold: int, common: np.ndarray, buckets: int) -> DataFrame:
    """The stretches with longer anchors, packed with their bytes, of the windows ``at`` of texts. Windows that follow each
    other are looked at together, whichever stretch they were of."""

    def emit(batches):
        held, cuts, size = [], [], 0
        for batch in batches:
            for runs in part_runs(batch):
                texts, firsts, docs, versions = ([x for r in runs for x in r[c]] for c in range(4))
                i, start, count, h, name = stretches(texts, anchor_bytes(LONG_ANCHOR, threshold), threshold)
                firsts, docs, versions = (np.array(x, np.int64)[i] for x in (firsts, docs, versions))
                held.append((h.view(np.uint64), name.view(np.uint64), firsts + start, count, docs, versions))
                cuts += [texts[k][a : a + c + threshold - 1] for k, a, c in zip(i.tolist(), start.tolist(), count.tolist(), strict=True)]
                size += len(h)
                if size > PACK_ROWS // 4:
                    yield _packed([np.concatenate(x) for x in zip(*held, strict=True)], cuts, common, buckets)
                    held, cuts, size = [], [], 0
        if size:
            yield _packed([np.concatenate(x) for x in zip(*held, strict=True)], cuts, common, buckets)

    def part_runs(batch):
        held, size = [], 0
        texts = _bytes(batch.column("text"))
        for row, (doc, version) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist(), strict=True)):
            places = batch.column("at")[row].values.to_numpy()
            for k in range(0, len(places), ROWS):
                start = places[k : k + ROWS] // _LENGTH
                stop = start + places[k : k + ROWS] % _LENGTH
                new = np.flatnonzero(np.append(True, start[1:] > stop[:-1]))
                ends = stop[np.append(new[1:], len(stop)) - 1]
                cuts = [texts[row][a : b + threshold - 1] for a, b in zip(start[new].tolist(), ends.tolist(), strict=True)]
                held.append((cuts, start[new].tolist(), [doc] * len(new), [version] * len(new)))
                size += len(start)
                if size >= ROWS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    return pieces.mapInArrow(emit, PACKED_DDL)


def _common(texts: DataFrame, threshold: int) -> tuple[list[np.ndarray], int, int]:
    """Anchors, short and long ones, with more than a share of the stretches of a sample of documents, of which there are
    at most 1 / share; the number of buckets that all short anchors need, and the number of documents."""
    docs, size = texts.agg(F.count("*"), F.sum(F.octet_length("text").cast("bigint"))).first()
    share = min(1.0, SAMPLE_DOCS / max(1, docs))
    chosen = F.pmod(F.xxhash64("doc", "version", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    anchors = [anchor_bytes(x, threshold) for x in (ANCHOR, LONG_ANCHOR)]

    def hashes(batches):
        held = [[(np.empty(0, np.int64), np.empty(0, np.int64))] for _ in anchors]
        for batch in batches:
            for part in slices(batch, "text"):
                for own, anchor in zip(held, anchors, strict=True):
                    own.append(np.unique(stretches(_bytes(part.column("text")), anchor, threshold)[3], return_counts=True))
        for kind, own in enumerate(held):
            h, n = (np.concatenate(x) for x in zip(*own, strict=True))
            order = np.argsort(h)
            h, n, first = h[order], n[order], _runs(h[order])
            h, n = h[first], np.add.reduceat(n, first) if len(first) else n
            # the total goes along; what a quarter of the sample has once is not common
            yield _batch(["kind", "h", "n"], np.full(1 + (n > 1).sum(), kind), pa.array([None, *h[n > 1].tolist()], pa.int64()), np.append(n.sum(), n[n > 1]))

    counts = texts.filter(chosen).select("text").repartition(4).mapInArrow(hashes, "kind bigint, h bigint, n bigint").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    total = F.sum(F.when(F.col("h").isNull(), F.col("n"))).over(Window.partitionBy("kind"))
    found = counts.filter("n > 8").withColumn("total", total).filter(F.col("h").isNotNull() & (F.col("n") > F.floor(F.col("total") * COMMON_SHARE)))
    found = found.select("kind", "h").toArrow()
    kinds, h = found.column("kind").to_numpy(), found.column("h").to_numpy()
    width = threshold - anchors[0] + 1
    return [np.sort(h[kinds == k]) for k in range(2)], 1 + 2 * (size or 0) // (width + 1) // BUCKET_ROWS, docs


def _judged(h, name, doc, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of stretches the places of those that a smaller document holds as a whole, and of those that are contested: the
    first document of a stretch may lose windows of it to another stretch, whose first document is smaller. Unless all
    stretches of their anchors are there (``whole``), all that are no hits are contested."""
    order = np.argsort(h)
    if whole:
        first = _runs(h[order])
        several = np.minimum.reduceat(doc[order], first) < np.maximum.reduceat(doc[order], first)
        order = order[np.repeat(several, np.diff(np.append(first, len(h))))]
    order = order[np.lexsort((name[order], h[order]))]
    if not len(order):
        return order, order
    first = _runs(h[order], name[order])
    low = np.minimum.reduceat(doc[order], first)
    above = doc[order] > np.repeat(low, np.diff(np.append(first, len(order))))
    rest = ~above
    if whole:
        group = np.flatnonzero(np.append(True, np.diff(h[order][first].view(np.int64)) != 0))
        contested = np.minimum.reduceat(low, group) < np.maximum.reduceat(low, group)
        contested = np.repeat(contested, np.diff(np.append(group, len(first))))
        rest &= np.repeat(contested, np.diff(np.append(first, len(order))))
    return np.sort(order[above]), np.sort(order[rest])


def _settled(anchors: DataFrame, threshold: int, parts: int, cut: bool) -> DataFrame:
    """Stretches that are hits, and those that are contested, packed by parts of the documents. With ``cut`` the contested
    ones are rows of their own, with their bytes."""
    names = ["part", "hit", "n", *FOUND]
    whole_rows = {"doc": pa.int64(), "version": pa.int64(), "first": pa.int64(), "bytes": pa.binary()} if cut else {}

    def unpacked(row: dict):
        own = {c: np.frombuffer(row[c], kind) for c, kind in PACKED.items()}
        owner = np.cumsum(own["new"], dtype=np.int64) - 1
        return own["h"], own["name"], own["docs"][owner], own["versions"][owner], own["start"].astype(np.int64) * _LENGTH + own["count"]

    def dealt(hit: bool, doc, version, at):
        part = (mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        first = _runs(part[order])
        bounds = [*first.tolist(), len(part)]
        columns = [[x[order[a:b]].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)] for x in (doc, version, at)]
        own = [part[order][first].astype(np.int64), np.full(len(first), hit), np.diff(bounds).astype(np.int64), *(pa.array(c, pa.binary()) for c in columns)]
        return _batch([*names, *whole_rows], *own, *(pa.nulls(len(first), kind) for kind in whole_rows.values()))

    def judged(rows: list, whole: bool):
        h, name, doc, version, at = (np.concatenate(x) for x in zip(*[r[:5] for r in rows], strict=True))
        hits, rest = _judged(h, name, doc, whole)
        if len(hits):
            yield dealt(True, doc[hits], version[hits], at[hits])
        if not len(rest):
            return
        if not cut:
            yield dealt(False, doc[rest], version[rest], at[rest])
            return
        ends = np.cumsum(at % _LENGTH + threshold - 1)
        starts, text = ends - (at % _LENGTH + threshold - 1), b"".join(r[5] for r in rows)
        for k in range(0, len(rest), ROWS):
            some = rest[k : k + ROWS]
            cuts = pa.array([text[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)], pa.binary())
            empty = [pa.nulls(len(some), pa.binary())] * len(FOUND)
            yield _batch([*names, *whole_rows], pa.nulls(len(some), pa.int64()), np.full(len(some), False), np.ones(len(some), np.int64), *empty, doc[some], version[some], at[some], cuts)

    def keep(batches):
        bucket, held, size = None, [], 0
        for batch in batches:
            for row in _rows(batch):
                # stretches of common anchors need not meet: what is not found here is looked at again
                if held and (row["bucket"] != bucket or bucket < 0 and size > BUCKET_ROWS):
                    yield from judged(held, bucket >= 0)
                    held, size = [], 0
                bucket = row["bucket"]
                held.append((*unpacked(row), row["bytes"]))
                size += len(held[-1][0])
        if held:
            yield from judged(held, bucket >= 0)

    rows = anchors.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(keep, LEFT_DDL if cut else FOUND_DDL)


def _by_document(found: DataFrame) -> DataFrame:
    """``doc``, ``version`` and their ``at``, in order and once each, of what ``_settled`` has packed."""

    def unpack(batches):
        part, held = None, []
        for batch in batches:
            for row in _rows(batch):
                if row["part"] != part and held:
                    yield from lists(held)
                    held = []
                part = row["part"]
                held.append([np.frombuffer(row[c], kind) for c, kind in FOUND.items()])
        if held:
            yield from lists(held)

    def lists(held):
        doc, version, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((at, version, doc))
        order = order[_runs(doc[order], version[order], at[order])]
        doc, version, at = doc[order], version[order], at[order]
        first = _runs(doc, version)
        for k in range(0, len(first), 1_000):
            some = np.append(first[k : k + 1_000], first[k + 1_000] if k + 1_000 < len(first) else len(doc))
            own = pa.ListArray.from_arrays(pa.array(some - some[0], pa.int32()), pa.array(at[some[0] : some[-1]]))
            yield _batch(["doc", "version", "at"], doc[some[:-1]], version[some[:-1]], own)

    rows = found.select("part", *FOUND).repartition("part").sortWithinPartitions("part")
    return rows.mapInArrow(unpack, "doc bigint, version bigint, at array<bigint>")


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored, in little space; shuffle files of before are gone when the next one runs."""
    out = stored(df, label, "zstd")
    del df
    release(out.sparkSession, 0.3)
    return out


def ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``key``, ``rank`` and ``low`` of the keys that more than one document has; ranks are in the order of the keys.

    Equal keys are aggregated before they are sorted, so a hot key is one row of the sort.
    """
    ordered = _several(rows, key).orderBy(*key).select(*key, F.monotonically_increasing_id().alias("rank"), "low")
    return _kept(ordered, "ranks")


def _several(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select(*key, "low")


def doubled(texts: DataFrame, threshold: int = THRESHOLD, start: int = START) -> DataFrame:
    """``id``, ``pos``, ``low``, the smallest document, and their own ``high`` of windows of ``texts`` (``id``, ``bytes``,
    ``low``, ``high``) that are in more than one document, by prefix doubling. Windows with a unique rank leave after each sort."""
    lengths = [min(start, threshold)]
    while lengths[-1] < threshold:
        lengths.append(min(2 * lengths[-1], threshold))
    # offsets within a window at which each round's ranks are needed: those of the next round, and as far behind as it looks
    needed = [[0]]
    for shorter, longer in zip(lengths[-2::-1], lengths[:0:-1], strict=True):
        needed.insert(0, sorted({*needed[0], *(x + longer - shorter for x in needed[0])}))

    def windows(batches):
        for batch in batches:
            ids, pos, lows, highs, grams = [], [], [], [], [[] for _ in needed[0]]
            for i, text, low, high in zip(*(batch.column(c).to_pylist() for c in ("id", "bytes", "low", "high")), strict=True):
                n = len(text) - threshold + 1
                ids += [i] * n
                lows += [low] * n
                highs += [high] * n
                pos += range(n)
                for x, own in zip(needed[0], grams, strict=True):
                    own += [text[p + x : p + x + lengths[0]] for p in range(n)]
            yield _batch(["id", "pos", "low", "high", *names(0)], pa.array(ids, pa.int64()), pa.array(pos, pa.int32()), pa.array(lows, pa.int64()), pa.array(highs, pa.int64()), *(pa.array(g, pa.binary()) for g in grams))

    def names(k: int) -> list[str]:
        return [f"at{x}" for x in needed[k]]

    ddl = "id bigint, pos int, low bigint, high bigint, " + ", ".join(f"{c} binary" for c in names(0))
    rows = texts.select("id", "bytes", "low", "high").mapInArrow(windows, ddl)
    rows, keys = _kept(rows, "positions"), {c: F.col(c) for c in names(0)}
    for k in range(len(lengths)):
        parts = ["first", "second"] if k else ["gram"]
        fields = ["key.*"] if k else [F.col("key").alias("gram")]
        if k + 1 == len(lengths):
            own = rows.select("id", "pos", "low", "high", keys["at0"].alias("key")).select("id", "pos", "low", "high", *fields)
            # stored, so that Spark can split the join where many windows are equal
            return own.drop("low").join(_kept(_several(own, parts), "repeated"), parts).select("id", "pos", "low", "high")
        ranks = ranked(rows.select(F.explode(F.array(*keys.values())).alias("key"), "low", "high").select(*fields, "low", "high"), parts)
        live = rows.select("id", "pos", "low", "high", *(x.alias(c) for c, x in keys.items()))
        for c in names(k):
            own = ranks.select((F.struct(*parts) if k else F.col("gram")).alias(c), F.col("rank").alias("found"))
            live = live.join(own, c).drop(c).withColumnRenamed("found", c)
        live = _kept(live, "ranked")
        discard(rows, ranks)
        step = lengths[k + 1] - lengths[k]
        rows, keys = live, {f"at{x}": F.struct(F.col(f"at{x}").alias("first"), F.col(f"at{x + step}").alias("second")) for x in needed[k + 1]}


def repeated_spans(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc``, ``version`` and ``spans``: stretches (first byte times 1,024 plus windows, overlapping) of the texts of
    ``docs`` (``doc``, ``version``, ``text``) that windows of smaller documents cover."""
    texts = docs.filter(F.octet_length("text") >= threshold).select("doc", "version", "text")
    (common, long_common), buckets, n_docs = _common(texts, threshold)
    parts = 1 + n_docs // PART_DOCS
    found = _kept(_settled(_anchors(texts, threshold, common, buckets), threshold, parts, False), "found")
    contested = found.filter("NOT hit").agg(F.sum("n")).first()[0] or 0
    pieces = texts.join(_by_document(found.filter("NOT hit")), ["doc", "version"])
    # some four stretches come of one, and their bytes take as much again
    inner = _settled(_sub_stretches(pieces, threshold, long_common, 1 + 8 * contested // BUCKET_ROWS), threshold, parts, True)
    del pieces
    inner = _kept(inner, "inner")
    own = inner.filter("doc IS NOT NULL").select("doc", "version", "first", "bytes", F.col("doc").alias("low"), F.col("doc").alias("high"))
    left = _kept(own.withColumn("id", F.monotonically_increasing_id()), "left")
    lost = doubled(left, threshold).filter("low < high").select("id", "pos").join(left.select("id", "doc", "version", "first"), "id")
    at = (F.floor(F.col("first") / _LENGTH) + F.col("pos")) * _LENGTH + 1
    lost = _kept(lost.groupBy("doc", "version").agg(F.collect_list(at).alias("at")), "lost")
    discard(left)
    hits = _by_document(found.filter("hit").select("part", *FOUND).unionByName(inner.filter("hit").select("part", *FOUND)))
    return hits.unionByName(lost).groupBy("doc", "version").agg(F.flatten(F.collect_list("at")).alias("spans"))


def dedup_substrings(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` as column ``row`` (a struct), with ``kept`` (the bytes left), ``n_bytes``, ``n_removed`` and ``removed``,
    the maximal runs of removed bytes as structs of ``start`` and ``end``.

    A byte goes if a string of ``threshold`` bytes around it also starts in a document with a smaller ``doc_id``. A null
    text is empty. A null ``doc_id`` comes after all others. Rows with one ``doc_id`` take nothing from each other, and
    rows alike get the same result. Texts shorter than the threshold stay whole. What is left may be no valid UTF-8.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text"))
    texts = rows.select("doc", "version", "text")
    joined = rows.join(repeated_spans(texts, threshold), ["doc", "version"], "left").select("row", "text", "spans")
    names = ["row", "kept", "n_bytes", "n_removed", "removed"]
    run = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def remove(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                kept, sizes, gone, runs = [], [], [], []
                for text, spans in zip(_bytes(part.column("text")), part.column("spans"), strict=True):
                    sizes.append(len(text))
                    if not spans.is_valid:
                        kept.append(text)
                        gone.append(0)
                        runs.append([])
                        continue
                    at = spans.values.to_numpy()
                    change = np.zeros(len(text) + 1, np.int32)
                    np.add.at(change, at // _LENGTH, 1)
                    np.add.at(change, at // _LENGTH + at % _LENGTH + threshold - 1, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes())
                    gone.append(int(covered.sum()))
                    edges = np.flatnonzero(np.diff(covered, prepend=False, append=False))
                    runs.append([{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
                yield _batch(names, part.column("row"), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.list_(run)))

    out = T.StructType([rows.schema["row"], T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType())])
    out = out.add("n_removed", T.LongType()).add("removed", T.ArrayType(T.StructType().add("start", T.LongType()).add("end", T.LongType())))
    return joined.mapInArrow(remove, out)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 50 bytes in documents with smaller ids cover, and a digest of the rest."""
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (SELECT doc_id, c, substr(x, CAST(2 * c + 1 AS BIGINT), {2 * (1024 + THRESHOLD - 1)}) AS x
      FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2, 1024)) AS c FROM d)),
w AS (SELECT doc_id, c, x, unnest(range(0, least(1024, length(x) // 2 - {THRESHOLD - 1}))) AS p FROM c WHERE length(x) >= {2 * THRESHOLD}),
s AS (SELECT doc_id, c + p AS p, substr(x, CAST(2 * p + 1 AS BIGINT), {2 * THRESHOLD}) AS g FROM w),
f AS (SELECT g, min(doc_id) AS low FROM s GROUP BY g),
h AS (SELECT s.doc_id, s.p FROM s JOIN f ON s.g = f.g WHERE f.low < s.doc_id),
o AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {THRESHOLD} THEN 0 ELSE 1 END AS fresh FROM h),
g AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM o),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + {THRESHOLD} AS b FROM g GROUP BY doc_id, run),
e AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM (SELECT doc_id, a, b FROM r UNION ALL SELECT doc_id, -1, 0 FROM d)),
k AS (SELECT e.doc_id, string_agg(substr(d.x, CAST(2 * e.a + 1 AS BIGINT), CAST(2 * (coalesce(e.b, length(d.x) // 2) - e.a) AS BIGINT)), '' ORDER BY e.a) AS x
      FROM e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id),
n AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n.gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k.x)) AS kept_sha256
FROM d JOIN k ON d.doc_id = k.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
