"""Operators that SQL cannot say, against plain versions of them."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import common, line_dedup, near_dedup, packing, quality, search, warc
from tidelog.llm.language import Model, held_out, learn, trigrams
from tidelog.llm.queries import QUERIES

SPACE = " \t\n\x0b\f\r"


def words(text):
    return (text or "").encode().split()


@given(st.lists(st.text(alphabet="ab é\n\t\x0b\x1c", max_size=40), max_size=6))
@settings(deadline=None, max_examples=60)
def test_words(texts):
    size = common.BLOCK_BYTES
    try:
        common.BLOCK_BYTES = 7
        small = [common.word_hashes(t.encode()) for t in texts]
    finally:
        common.BLOCK_BYTES = size
    known = {}
    for text, hashes in zip(texts, small, strict=True):
        assert (hashes == common.word_hashes(text.encode())).all() and len(hashes) == len(words(text))
        for w, h in zip(words(text), hashes.tolist(), strict=True):
            assert known.setdefault(h, w) == w


# ---- archives


@given(st.binary(max_size=300).map(lambda b: b.replace(b"z", b"WARC/1.1").replace(b"y", b"\r\n")), st.integers(1, 40))
@settings(deadline=None, max_examples=100)
def test_framing(payload, size):
    framed = warc.frame_chunks(payload, size)
    assert b"WARC/1.1" not in framed and warc.unframe_chunks(framed) == (payload, True)
    assert warc.unframe_chunks(framed[:-3])[1] is False


def test_segments_are_checked():
    payload = bytes(range(256)) * 40
    records = warc._records("urn:a", "http://a/", payload, None, warc.sha1_base32(payload), 900)
    parsed = [warc._parsed(r.removeprefix(warc.MARK.encode()) + b"\r\n\r\n") for r in records]
    assert len(parsed) > 10 and warc._payload(parsed)["payload"] == payload and warc._payload(parsed)["whole"]
    assert not warc._payload(parsed[:-1])["whole"] and not warc._payload(parsed[:3] + parsed[4:])["whole"]
    short = warc._parsed(records[1].removeprefix(warc.MARK.encode())[:-1])
    assert not warc._payload([parsed[0], short, *parsed[2:]])["whole"]


def test_archives_give_payloads_back(spark, tmp_path):
    payloads = [b"", b"x", b"WARC/1.1\r\n" * 500, b"\r\n\r\n" * 9000, bytes(range(256)) * 300]
    rows = [(f"urn:{i}", f"http://h/{i} \n", p, None) for i, p in enumerate(payloads)] * 2
    records = spark.createDataFrame(rows, "record_id string, target_uri string, payload binary, refers_to string")
    warc.write_archives(records, str(tmp_path / "w"), segment_bytes=5000)
    got = warc.read_payloads(spark, str(tmp_path / "w")).collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in got) == sorted((r[0], r[2]) for r in rows)
    assert all(r.whole and r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode() for r in got)


# ---- mixing


def test_mix(spark, tables, plain_docs):
    folder = tables(documents=plain_docs)
    got = {r.doc_id: r for r in QUERIES["op3_source_mix"](spark, folder).collect()}
    sources = sorted({d[3] for d in plain_docs}, key=lambda s: (s is None, s))
    size = {d[0]: len(words(d[1])) for d in plain_docs}
    total = {s: sum(size[d[0]] for d in plain_docs if d[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, free, left = {}, set(sources), sum(total.values())
    while stopped := [s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 3 * total[s]]:
        for s in stopped:
            target[s] = 3 * total[s]
        free -= set(stopped)
        left = sum(total.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    for s in sources:
        docs = []
        for doc_id, text, _, source, _ in plain_docs:
            if source == s:
                h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
                h = h if text is None else xxhash.xxh64_intdigest(text.encode(), h)
                docs.append((h & ((1 << 62) - 1), doc_id, size[doc_id]))
        goal, taken = round(target[s]), Counter()
        while goal > 0 and total[s]:
            for _, doc_id, n in sorted(docs):
                taken[doc_id] += min(n, goal)
                goal -= min(n, goal)
        for _, doc_id, n in docs:
            r = got[doc_id]
            assert (r.size, r.source_size, r.taken) == (n, total[s], taken[doc_id]) and r.target == pytest.approx(target[s])


# ---- near-duplicates


def plain_classes(texts):
    bags = [Counter(zip(*(words(t)[i:] for i in range(5)))) if len(words(t)) >= 5 else Counter([tuple(words(t))]) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if words(texts[i]) and words(texts[j]) and 5 * both >= 4 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def edited(text, n, seed):
    own, pick = text.split(" "), random.Random(seed)
    for _ in range(n):
        own[pick.randrange(len(own))] = f"new{pick.randrange(10**6)}"
    return " ".join(own)


def test_near_classes(spark, tables, prose):
    base, other = prose(120, 1), prose(300, 2)
    texts = [None, "", "a b", "a b", " a\tb", base, base, edited(base, 1, 1), other, other + " tail", prose(40, 3) * 4, prose(40, 3) * 5, prose(40, 3) * 6]
    texts += [edited(base, 4, s) for s in range(40)] + [edited(other, 8, s) for s in range(60)] + [prose(60, 50 + i) for i in range(20)]
    # pairs of copies inside a crowd that is alike but below the threshold
    texts += [edited(edited(other, 8, s), 2, s + 500) for s in range(0, 60, 7)]
    got = QUERIES["op4_bag_minhash"](spark, tables(documents=[(i, t, None, None, 0) for i, t in enumerate(texts)])).collect()
    wanted = plain_classes(texts)
    assert [r.class_id for r in sorted(got, key=lambda r: r.doc_id)] == wanted
    assert all(r.class_size == wanted.count(r.class_id) for r in got)


def test_signatures_are_unbiased():
    pick = np.random.default_rng(5)
    a = np.repeat(pick.integers(0, 1 << 62, 300).astype(np.uint64), pick.integers(1, 12, 300))
    b = np.concatenate([a[: len(a) // 2], a[:50], pick.integers(0, 1 << 62, 200).astype(np.uint64)])
    x, y = Counter(a.tolist()), Counter(b.tolist())
    similarity = sum((x & y).values()) / sum((x | y).values())
    one, other = near_dedup.bag_signatures([a, b], 1 << 13)
    assert abs((one == other).mean() - similarity) < 0.02
    assert np.isinf(near_dedup.bag_signatures([np.empty(0, np.uint64)], 8)).all()


# ---- packing


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=40))
@settings(deadline=None, max_examples=40)
def test_plan_places_every_piece(counts):
    plan = packing.whole_plan(counts, 64)
    placed = Counter()
    for items, times in plan:
        assert sum(items) <= 64 and times > 0
        for x in items:
            placed[x] += times
    assert placed == Counter(counts)
    places, rows = packing.Places(plan), []
    for x, n in counts.items():
        sequence, offset = places.of(x, np.arange(n))
        rows += [(s, o, x) for s, o in zip(sequence.tolist(), offset.tolist(), strict=True)]
    ends = {}
    for s, o, x in sorted(rows):
        assert o == ends.get(s, 0)
        ends[s] = o + x
    assert len(ends) == places.sequences == sum(n for _, n in plan)


def test_packing(spark, tables, plain_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = plain_docs + [(10_000, "<|endoftext|> a\u0300 \U0001f600 don't 12", None, None, 0)]
    got = QUERIES["op5_packing"](spark, tables(clashes=True, documents=docs)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text, *_ in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for i, r in enumerate(sorted(pieces.pop(doc_id), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (r.length == 2048 or i == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 2


# ---- search


def test_search(spark, tables, plain_docs, prose):
    docs = [(50 * i if i < 6 else 50 * i + 1, t) for i, t in enumerate([prose(30, 1), prose(200, 2), "", None, "nowhereelse", prose(3, 9)])]
    docs += [(d[0] * 50 + 7, d[1]) for d in plain_docs] + [(7, prose(30, 1)), (None, prose(30, 1)), (50, prose(200, 2))]
    rows = [(i, t, None, None, 0) for i, t in docs]
    got = {}
    for r in QUERIES["op7_bm25_search"](spark, tables(clashes=True, documents=rows)).collect():
        got.setdefault(r.query, []).append((r.rank, r.doc_id, round(r.score, 6)))
    bags = [(i, Counter(words(t))) for i, t in docs]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / len(bags)
    df = Counter(w for _, b in bags for w in b)
    wanted = {}
    for query, text in docs:
        if query is None or query % 50 or not words(text):
            continue
        found = []
        for i, b in bags:
            length = sum(b.values())
            score = sum(
                math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * length / mean))
                for w in set(words(text)) if w in b
            )
            if score > 0:
                found.append((-round(score, 6), i is None, i or 0))
        wanted[query] = [(k, None if none else i, round(-s, 6)) for k, (s, none, i) in enumerate(sorted(found)[:10], 1)]
    assert {q: sorted(r) for q, r in got.items()} == wanted


def test_pruning_changes_nothing():
    pick = random.Random(3)
    bags = []
    for _ in range(700):
        terms = sorted(set(pick.choices(range(1, 400), weights=[1 / x for x in range(1, 400)], k=pick.randrange(1, 40))))
        bags.append((np.array(terms, np.uint64), np.array([pick.randrange(1, 5) for _ in terms])))
    shard = search.Shard(search._shard(list(range(700)), bags)[2], 10.0)
    for _ in range(60):
        terms = np.array(sorted(set(pick.choices(range(1, 420), k=pick.randrange(1, 30)))), np.uint64)
        weights = np.array([pick.random() + 0.1 for _ in terms])
        every = dict(zip(*(x.tolist() for x in next(shard.search([(terms, weights)], 10_000))), strict=True))
        docs, scores = [*shard.search([(terms, weights)] * 3, 5)][2]
        best = sorted(every.values(), reverse=True)[:5]
        assert sorted(scores.tolist(), reverse=True)[:5] == pytest.approx(best)
        assert all(every[d] == pytest.approx(s) for d, s in zip(docs.tolist(), scores.tolist(), strict=True))


def test_products_in_single_precision_are_exact():
    """Scores closer than single precision tells apart, in two kinds of documents, by queries in any order."""
    pick = np.random.default_rng(5)
    bags = []
    texts = [np.unique(pick.integers(0, 60, 40) + 1000 * (i % 2)).astype(np.uint64) for i in range(30)]
    for i in range(600):
        bags.append((texts[i % 30], pick.integers(10_000, 10_009, len(texts[i % 30])).astype(np.uint32)))
    blob = search._shard(list(range(600)), bags)[2]
    sizes = np.array([b[1].sum() for b in bags])
    shard = search.Shard(blob, float(sizes.mean()))
    weights = 100 * pick.random(2000) + 10
    queries = [(bags[i][0], weights[bags[i][0].astype(int)]) for i in range(0, 600, 3)]
    queries += [(t, w * 1.5) for t, w in queries[:2]]  # a term need not weigh the same everywhere
    bounds = np.append(0, np.cumsum([len(t) for t, _ in queries]))
    asked = search.Asked.of(np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries]), bounds)
    order = search.alike(asked)
    kinds = [int(queries[q][0][0]) >= 1000 for q in order]
    assert sorted(order.tolist()) == list(range(len(queries))) and sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) < search.KINDS
    got = [None] * len(queries)
    for q, found in zip(order.tolist(), shard.search(asked.in_order(order), 10), strict=True):
        got[q] = found
    rows = dict(zip(shard.ids.tolist(), range(600), strict=True))
    close = 0
    for (terms, weights), (docs, scores) in zip(queries, got, strict=True):
        weight = dict(zip(terms.tolist(), weights.tolist(), strict=True))
        every = {}
        for i, (own, counts) in enumerate(bags):
            length = 1.2 * (0.25 + 0.75 * sizes[i] / sizes.mean())
            every[rows[i]] = sum(weight.get(t, 0) * c * 2.2 / (c + length) for t, c in zip(own.tolist(), counts.tolist(), strict=True))
        best = sorted(every.values(), reverse=True)[:11]
        close += any(search._CLOSE < a - b < 1e-8 * a for a, b in zip(best, best[1:], strict=False))
        assert sorted(scores.tolist(), reverse=True)[:10] == pytest.approx(best[:10], rel=1e-12)
        assert all(every[d] == pytest.approx(x, rel=1e-12) for d, x in zip(docs.tolist(), scores.tolist(), strict=True))
        # what reaches a least score is found whatever the precision
        [(few, _)] = shard.search([(terms, weights)], 10, np.array([best[4]]))
        assert set(few.tolist()) == {d for d, x in every.items() if x >= best[4] - search._CLOSE}
    assert close
    nothing = asked.in_order(np.empty(0, int))
    assert len(search.alike(nothing)) == 0 and not [*shard.search(nothing, 10)] and not [*shard.search([], 10)]


# ---- languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op8_language_mixture"](spark, "/root/testdata/sf0.01").join(docs, "doc_id")
    hits = got.filter("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert hits > 0.97 and got.filter("score < 0 OR score > 1").count() == 0


def test_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    long = {r.lang: r.text for r in docs.groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    assert model.mixture(None) == model.mixture("") == model.mixture("12 34 !?") == model.mixture("² ½ _ ①") == {}
    assert {max(m, key=m.get) for m in [model.mixture(long["fr"])]} == {"fr"}
    both = model.mixture(long["en"][:3000] + " " + long["de"][:3000])
    assert set(both) == {"en", "de"} and 0.3 < both["en"] < 0.7
    assert Model([], np.zeros((0, 1 << 15))).mixture("text") == {}


# ---- lines, rules


def test_runs_are_compacted(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fanout=2)
    for low in range(90, -1, -10):
        keys = [(low + i, b"%d" % k) for i in range(10) for k in range(5) if (low + i) % (k + 1) == 0 and (k or low < 20)]
        runs.add(spark.createDataFrame(keys, "doc_id bigint, key binary"))
    assert sum(map(len, runs.levels)) <= 4
    got = {bytes(r.key): r.top_doc for r in runs.settled().collect()}
    assert got == {b"0": 19, b"1": 98, b"2": 99, b"3": 96, b"4": 95}
    runs.close()


def test_cascade_order_changes_no_verdict(spark, plain_docs):
    docs = spark.createDataFrame([(d[0], d[1]) for d in plain_docs], "doc_id bigint, text string")
    rows, rules = quality.measured(docs), quality.document_rules()
    ordered = quality.order_rules(rows, rules, 50)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in rules)
    names = lambda rs: rows.select("doc_id", quality.first_failure(rs).alias("f")).collect()
    one, other = names(ordered), names(rules[::-1])
    assert {r.doc_id for r in one if r.f} == {r.doc_id for r in other if r.f}
    never = [quality.Rule("none", F.lit(None).cast("boolean")), quality.Rule("all", F.lit(True))]
    assert {r.f for r in names(never)} == {"all"} and [r.name for r in quality.order_rules(rows, never, 50)] == ["all", "none"]
