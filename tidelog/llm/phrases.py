"""Mining of phrases by counts, after Toivonen: a sample proposes, one full pass counts, failures of the border go on.

A sample of the documents proposes the phrases that are frequent at a lowered threshold. The full pass counts these and
their negative border: every phrase that was not proposed, though its first words and its last words were; all single words
belong to one or the other. A frequent phrase of the border is a failure: longer phrases around it may have been left out.
The failures join the proposed phrases, and another pass counts what is new of these and of the border, until nothing fails.
By then every frequent phrase has been proposed and counted in full, as a part of a phrase is never rarer than the phrase.

Passes count hashes of 63 bits, in packed arrays that are added up in tasks before they are shuffled. A last pass names the
phrases of frequent hashes, each once per task. Where a hash should have two names, these are counted by their words, so the
numbers are exact. Which phrases are proposed the tasks know by a filter of a fixed size, as Bloom's: what it lets through by
mistake is counted like the rest, and costs nothing but time.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BLOCK_BYTES, _hash_spans, mix, slices, stored, table

MIN_COUNT = 30
MAX_WORDS = 4
#: Percentage of a phrase's occurrences within a longer one from which the shorter one goes.
INSIDE_PERCENT = 80
PER_LANGUAGE = 2_000
SCORE_SCALE = 2_000_000
#: One document in so many is in the sample, in which so many occurrences propose a phrase.
SAMPLE_EVERY = 4
SAMPLE_COUNT = 2
#: Bits of the filter, as a power of two: 16 MB, whatever the corpus.
FILTER_BITS = 27
#: Phrases, and hashes, that a task gathers before it hands them over.
TALLIED, PACKED = 200_000, 2_000_000
#: Hashes of a bucket, about, which a task adds up together, and hashes that a byte of text gives, about.
BUCKET_HASHES, HASHES_A_BYTE = 500_000, 0.15
#: Parts that the first rows of a language are looked for in.
RANK_PARTS = 16
NO_LANGUAGE = "und"

BREAKS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
_AHEAD = re.compile(rb"(?:[ \t]+[^ \t.,;:!?\n\x0b\x0c\r]+){0,%d}" % (MAX_WORDS - 1))
_DIVIDES = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")

PASS_DDL = "bucket bigint, hashes binary, numbers binary"


def chunks(text: bytes, size: int = BLOCK_BYTES):
    """Parts of ``text`` and how many of their bytes are their own; the words beyond only end phrases that begin before."""
    start = 0
    while start < len(text):
        divide = _DIVIDES.search(text, start + size)
        stop = divide.start() if divide else len(text)
        yield text[start : _AHEAD.match(text, stop).end()], stop - start
        start = stop


class Words:
    """The words of some chunks, in order: hashes, places, whether a phrase may begin at one, and go on after one."""

    def __init__(self, parts: list[tuple[bytes, int]]):
        self.data = np.frombuffer(b"\n".join(p for p, _ in parts) + b"\n", np.uint8).copy()
        upper = (self.data >= 65) & (self.data <= 90)
        self.data[upper] += 32
        self.text = self.data.tobytes()
        kind = np.zeros(256, np.uint8)
        kind[list(BLANKS)], kind[list(BREAKS)] = 1, 2
        kinds = kind[self.data]
        outside = np.ones(len(kinds) + 1, bool)
        outside[1:] = kinds > 0
        edges = np.flatnonzero(outside[1:] != outside[:-1])
        self.first, self.last = edges[::2], edges[1::2]
        self.hashes = _hash_spans(self.data, self.first, self.last) if len(self.first) else np.empty(0, np.uint64)
        breaks = np.cumsum(kinds == 2)
        piece = breaks[self.first]
        self.on = np.append(piece[1:] == piece[:-1], False)[: len(piece)]
        lengths = np.array([len(p) + 1 for p, _ in parts])
        limits = np.cumsum(lengths) - lengths + np.array([own for _, own in parts])
        self.begins = self.first < np.repeat(limits, lengths)[self.first]

    def phrase(self, word: int, size: int) -> str:
        return b" ".join(self.text[a:b] for a, b in zip(self.first[word : word + size].tolist(), self.last[word : word + size].tolist(), strict=True)).decode()


def seed(lang: str) -> np.uint64:
    name = np.frombuffer(lang.encode() + b"\0", np.uint8)
    return _hash_spans(name, np.array([0]), np.array([len(name)]))[0]


def longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more at their end."""
    return mix(hashes * np.uint64(0xD6E8FEB86659FD93) + words)


def fingerprints(words: Words, lang: str, at: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the phrases of ``k`` words at the places ``at`` that have nothing to do with those of ``longer``."""
    out = np.full(len(at), seed(lang) ^ np.uint64(k))
    for i in range(k):
        out = mix(out ^ (words.hashes[at + i] * np.uint64(0xC2B2AE3D27D4EB4F)))
    return out


def has(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(hashes), bool)
    slot = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def looked_at(words: Words, lang: str, proposed: np.ndarray | None, before: np.ndarray | None, most: int):
    """Per length: the hashes of phrases at the places of ``words``, and where there is a proposed one, or any of which both
    parts are proposed but were not ``before``. Without ``proposed`` these are all."""
    n = len(words.hashes)
    hashes, valid, now, old = longer(np.full(n, seed(lang)), words.hashes), np.ones(n, bool), np.ones(n, bool), np.zeros(n, bool)
    if before is not None:
        old = np.ones(n, bool)
    named = named_before = valid
    for k in range(1, most + 1):
        if k > 1:
            # both parts of a phrase have to be proposed; of the parts at a place the last round knows it
            m = len(hashes) - 1
            if m <= 0:
                return
            valid = valid[:m] & words.on[k - 2 : k - 2 + m]
            now, old = valid & named[:m] & named[1:], valid & named_before[:m] & named_before[1:]
            hashes = longer(hashes[:m], words.hashes[k - 1 : k - 1 + m])
        named = now if proposed is None else now & has(proposed, hashes)
        named_before = old & has(before, hashes)
        begins = words.begins[: len(hashes)]
        # the last bit tells the longest phrases, out of which none grows
        yield k, hashes & ~np.uint64(1) | np.uint64(k == MAX_WORDS), named & begins, now & ~old & begins


def _by_language(part: pa.RecordBatch):
    """Languages of ``part`` and their words, about a megabyte at once."""
    by_lang: dict = {}
    for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
        by_lang.setdefault(lang, []).append(text.encode())
    for lang, texts in by_lang.items():
        for group in _groups(c for text in texts for c in chunks(text)):
            yield lang, Words(group)


def _shared_filters(docs: DataFrame, *filters):
    sc = docs.sparkSession.sparkContext
    sent = [None if x is None else sc.broadcast(x) for x in filters]
    return lambda: [None if x is None else x.value for x in sent]


def frequent_hashes(
    docs: DataFrame, least: int, bucket_bits: int, proposed: np.ndarray | None = None, before: np.ndarray | None = None, most: int = MAX_WORDS
) -> DataFrame:
    """One pass over ``docs`` (``lang``, ``text``): the ``hash`` and number ``n`` of the phrases found ``least`` times, of those
    whose parts are ``proposed`` and were not ``before``, and whether one is a ``failure``: not proposed, though it may grow."""
    filters = _shared_filters(docs, proposed, before)

    def count(batches):
        use, gone = filters()
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, words in _by_language(part):
                    for _, hashes, _, fresh in looked_at(words, lang, use, gone, most):
                        held.append(hashes[fresh])
                        size += len(held[-1])
                if size > PACKED:
                    yield _packed(np.concatenate(held), bucket_bits)
                    held, size = [], 0
        if size:
            yield _packed(np.concatenate(held), bucket_bits)

    def add_up(batches):
        (use,) = filters()[:1]
        bucket, arrays = None, []

        def often():
            hashes, numbers = (np.concatenate(x) for x in zip(*arrays, strict=True))
            order = np.argsort(hashes)
            hashes = hashes[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            n = np.add.reduceat(numbers[order].astype(np.int64), first)
            found, n = hashes[first[n >= least]], n[n >= least]
            failure = ~has(use, found) & (found & np.uint64(1) == 0)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n), pa.array(failure)], names=["hash", "n", "failure"])

        for batch in batches:
            for own, hashes, numbers in zip(*batch.columns, strict=True):
                if own.as_py() != bucket and arrays:
                    yield often()
                    arrays = []
                bucket = own.as_py()
                arrays.append((np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(numbers.as_buffer(), np.uint32)))
        if arrays:
            yield often()

    packed = docs.select("lang", "text").mapInArrow(count, PASS_DDL)
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add_up, "hash bigint, n bigint, failure boolean")


def named(docs: DataFrame, proposed: np.ndarray, frequent: np.ndarray, bucket_bits: int) -> DataFrame:
    """``hash``, ``lang``, ``phrase`` and ``k`` of the phrases that were counted, as their parts are ``proposed``, and that the
    filter ``frequent`` lets through, once each, and rows with k = 0 and ``n``, which add up to all words of a language.

    Tasks name what they find once; names travel in lists, a row per bucket of hashes."""
    filters = _shared_filters(docs, proposed, frequent)
    columns, kinds = ["hash", "lang", "phrase", "k"], (pa.int64(), pa.string(), pa.string(), pa.int32())

    def name(batches):
        use, often = filters()
        seen, totals, rows = np.empty(0, np.uint64), {}, []

        def handed():
            hashes = np.array([r[0] for r in rows], np.int64).view(np.uint64)
            bucket = (hashes >> np.uint64(63 - bucket_bits)).astype(np.int64) >> 1
            order = np.argsort(bucket, kind="stable")
            bucket, own = bucket[order], [rows[i] for i in order.tolist()]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            edges = pa.array(np.append(first, len(own)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, pa.array([r[i] for r in own], t)) for i, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists, pa.nulls(len(first), pa.int64())], names=["bucket", *columns, "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for lang, words in _by_language(part):
                    totals[lang] = totals.get(lang, 0) + int(words.begins.sum())
                    for k, hashes, _, counted in looked_at(words, lang, use, None, MAX_WORDS):
                        at = np.flatnonzero(counted & has(often, hashes))
                        # a phrase that shares its hash with another one has another fingerprint, and is named, too
                        found, first = np.unique(fingerprints(words, lang, at, k), return_index=True)
                        place = np.searchsorted(seen, found)
                        new = np.ones(len(found), bool)
                        inside = place < len(seen)
                        new[inside] = seen[place[inside]] != found[inside]
                        seen = np.insert(seen, place[new], found[new])
                        own = zip(hashes[at[first[new]]].view(np.int64).tolist(), at[first[new]].tolist(), strict=True)
                        rows += [(h, lang, words.phrase(i, k), k) for h, i in own]
                if len(rows) > TALLIED:
                    yield handed()
                    rows.clear()
                if len(seen) > 20 * TALLIED:
                    # what comes again is named again
                    seen = np.empty(0, np.uint64)
        if rows:
            yield handed()
        langs = pa.array([[x] for x in totals], pa.list_(pa.string()))
        none = [pa.nulls(len(totals), pa.list_(t)) for t in kinds]
        yield pa.RecordBatch.from_arrays([pa.array([-1] * len(totals), pa.int64()), none[0], langs, *none[2:], pa.array(totals.values(), pa.int64())], names=["bucket", *columns, "n"])

    def once(batches):
        bucket, held = None, []

        def unique():
            table = pa.concat_tables(held).group_by(columns).aggregate([])
            for x in table.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([*(x.column(c) for c in columns), pa.nulls(len(x), pa.int64())], names=[*columns, "n"])

        for batch in batches:
            for i, own in enumerate(batch.column("bucket").to_pylist()):
                if own < 0:
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, pa.int64()), batch.column("lang")[i].values, pa.nulls(1, pa.string()), pa.array([0], pa.int32()), batch.column("n").slice(i, 1)],
                        names=[*columns, "n"],
                    )
                    continue
                if own != bucket and held:
                    yield from unique()
                    held = []
                bucket = own
                held.append(pa.table([batch.column(c)[i].values for c in columns], names=columns))
        if held:
            yield from unique()

    lists = "bucket bigint, hash array<bigint>, lang array<string>, phrase array<string>, k array<int>, n bigint"
    packed = docs.select("lang", "text").mapInArrow(name, lists).repartition("bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(once, "hash bigint, lang string, phrase string, k int, n bigint")


def counted_by_words(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``k`` and ``n`` of the phrases with these ``hashes``, place by place."""
    filters = _shared_filters(docs, filter_of(hashes))

    def count(batches):
        (use,) = filters()
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, words in _by_language(part):
                    for k, found, _, fresh in looked_at(words, lang, None, None, MAX_WORDS):
                        at = np.flatnonzero(fresh & has(use, found))
                        names = pa.array([words.phrase(i, k) for i in at.tolist()], pa.string())
                        same = [pa.array([lang] * len(at), pa.string()), names, pa.array(np.full(len(at), k, np.int32)), pa.array(found[at].view(np.int64))]
                        yield pa.RecordBatch.from_arrays(same, names=["lang", "phrase", "k", "hash"])

    rows = docs.select("lang", "text").mapInArrow(count, "lang string, phrase string, k int, hash bigint")
    return rows.join(hashes, "hash", "left_semi").groupBy("lang", "phrase", "k").agg(F.count("*").alias("n"))


def _groups(parts):
    """Chunks in lists of about a megabyte."""
    group, size = [], 0
    for part in parts:
        group.append(part)
        size += len(part[0])
        if size > 4 * BLOCK_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _packed(hashes: np.ndarray, bucket_bits: int) -> pa.RecordBatch:
    """Hashes and their numbers, a row per bucket: those with the same first bits."""
    found, number = np.unique(hashes, return_counts=True)
    bucket = (found >> np.uint64(63 - bucket_bits)).astype(np.int64) >> 1
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    ends = [*first[1:].tolist(), len(bucket)] if len(first) else []
    packed = [pa.array([x[a:b].tobytes() for a, b in zip(first.tolist(), ends, strict=True)], pa.binary()) for x in (found, number.astype(np.uint32))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *packed], names=["bucket", "hashes", "numbers"])


def filter_of(hashes: DataFrame) -> np.ndarray:
    """The filter that lets ``hash`` through: bits, of which only the words with set ones come to the driver."""
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {64 - FILTER_BITS}) & 63 AS INT))")
    found = hashes.groupBy(F.shiftrightunsigned(slot, 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, sample_every: int = SAMPLE_EVERY, sample_count: int = SAMPLE_COUNT) -> DataFrame:
    """``lang``, ``phrase``, ``k`` and ``n`` of all phrases of at most four words that ``docs`` (``doc_id``, ``lang``,
    ``text``) hold ``min_count`` times, and a row with k = 0 for all words of a language."""
    texts = docs.select("doc_id", F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), "text").filter("text IS NOT NULL AND text <> ''")
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    bucket_bits = max(1, int(size * HASHES_A_BYTE / BUCKET_HASHES)).bit_length()
    sample = texts.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(sample_every)) == 0)
    # the longest phrases propose nothing: no phrase grows out of them
    proposals = frequent_hashes(sample, sample_count, bucket_bits, most=MAX_WORDS - 1)
    before, bits, found = None, filter_of(stored(proposals, "proposed")), []
    while True:
        found.append(stored(frequent_hashes(texts, min_count, bucket_bits, bits, before), "frequent"))
        failures = found[-1].filter("failure")
        if failures.isEmpty():
            break
        before, bits = bits, bits | filter_of(failures)
    every = reduce(DataFrame.unionByName, found).groupBy("hash").agg(F.sum("n").alias("n"))
    every = stored(every, "frequent")
    names = stored(named(texts, bits, filter_of(every), bucket_bits), "names")
    rows = stored(names.filter("hash IS NOT NULL").drop("n").join(every, "hash").select("hash", "lang", "phrase", "k", "n"), "phrases")
    twice = rows.groupBy("hash").count().filter("count > 1").select("hash")
    totals = names.filter("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    out = rows.drop("hash")
    if not twice.isEmpty():
        twice = stored(twice, "twice")
        out = rows.join(twice, "hash", "left_anti").drop("hash").unionByName(counted_by_words(texts, twice).filter(F.col("n") >= min_count))
    return out.unionByName(totals.select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("k"), "n"))


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang``, ``phrase``, ``a`` (its number), ``l`` and ``r`` (those of its parts at the lowest-scoring cut), ``n`` (words of
    the language) and ``score`` of the frequent phrases of 2 to 4 words that no longer one takes the place of.

    A-Z are lowered; null and empty texts have no words; a null ``lang`` is ``und``. Rows alike count as often as they
    come, also those with one ``doc_id``.
    """
    counts = stored(frequent_phrases(docs, min_count), "counts")
    phrases = counts.filter("k > 0").select("lang", "phrase", "n")
    whole = counts.filter("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"))
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.withColumn("head", F.expr("substring_index(phrase, ' ', cut)"))
    cut = cut.withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    cut = cut.withColumns({"a20": _exact("a"), "parts": _exact("l") + _exact("r")}).withColumn("score", F.expr(f"(a20 * {SCORE_SCALE}) div parts"))
    scored = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # phrases that are inside longer ones
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("k") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " ")),
        )
    )
    inside = whole.filter("k > 2").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left")
    stays = F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * inside_percent)
    totals = counts.filter("k = 0").select("lang", F.col("n").alias("words"))
    out = left.filter(stays).join(totals, "lang")
    return out.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("words").alias("n"), F.col("best.score").alias("score"))


def first_phrases(found: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The best ``per_language`` rows of every language with their ``rank``: by score and number, then by bytes."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    # parts first, so that the last sort gets so many rows at most
    some = found.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= per_language)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= per_language)
    return ranked.withColumn("rank", F.col("rank").cast("bigint")).drop("part")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return first_phrases(collocations(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = f"""
WITH d AS (SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
             string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]') AS ps
           FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(ps) AS piece FROM d),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, {MAX_WORDS + 1}) AS t(k) WHERE len(ws) >= k),
c AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n) AS n FROM c WHERE k = 1 GROUP BY lang),
f AS (SELECT * FROM c WHERE n >= {MIN_COUNT}),
x AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM x),
s AS (SELECT u.lang, u.phrase, u.a, u.cut, l.n AS l, r.n AS r, (CAST(u.a AS HUGEINT) * {SCORE_SCALE}) // (CAST(l.n AS HUGEINT) + r.n) AS score
      FROM u JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.ws[1 : u.cut], ' ')
             JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.ws[u.cut + 1 :], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, ws, k, unnest(range(2, k)) AS size FROM x WHERE k > 2),
j AS (SELECT lang, a, ws, size, unnest(range(1, k - size + 2)) AS o FROM i),
m AS (SELECT lang, array_to_string(ws[o : o + size - 1], ' ') AS phrase, max(a) AS longer FROM j GROUP BY ALL),
z AS (SELECT b.* FROM b LEFT JOIN m ON b.lang = m.lang AND b.phrase = m.phrase
      WHERE m.longer IS NULL OR CAST(m.longer AS HUGEINT) * 100 < CAST(b.a AS HUGEINT) * {INSIDE_PERCENT}),
o AS (SELECT z.*, t.n, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z JOIN t ON z.lang = t.lang)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o WHERE rank <= {PER_LANGUAGE}
"""
