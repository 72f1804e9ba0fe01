"""Substring dedup against a plain version, over all the ways that windows can be found."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import suffix_dedup as S


def plain(docs, threshold):
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - threshold + 1):
            w = data[i : i + threshold]
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - threshold + 1):
            if first[data[i : i + threshold]] < doc:
                gone[i : i + threshold] = [True] * threshold
        runs = [i for i, g in enumerate(gone) if g and (not i or not gone[i - 1])]
        out.append((doc, len(data), sum(gone), len(runs), bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


def found(spark, docs, threshold):
    rows = S.dedup_substrings(spark.createDataFrame(docs, "doc_id bigint, text string"), threshold).collect()
    for r in rows:
        assert r.n_removed == sum(x.end - x.start for x in r.removed) and r.n_bytes == r.n_removed + len(r.kept)
    return sorted((r.row.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in rows)


@pytest.mark.parametrize("threshold,letters,size", [(6, "ab", 40), (10, "abé ", 120), (50, "ab", 400), (50, "abcdefgh \n", 700)])
def test_random_texts(spark, threshold, letters, size):
    pick = random.Random(threshold + size)
    pool = ["".join(pick.choices(letters, k=pick.randrange(1, size))) for _ in range(12)]
    docs = []
    for i in range(60):
        text = "".join(pick.choice(pool)[: pick.randrange(1, size)] + pick.choice(["", "x", letters[0]]) for _ in range(pick.randrange(0, 5)))
        docs.append((pick.randrange(0, 10**6) if i % 7 else i, text))
    docs += [(2_000_000, None), (2_000_001, ""), (2_000_002, letters[0] * 3 * threshold), (2_000_003, letters[0] * 2 * threshold)]
    docs = list({d: (d, t) for d, t in docs}.values())
    assert found(spark, docs, threshold) == plain(docs, threshold)


def test_long_texts_and_common_anchors(spark, monkeypatch, prose):
    monkeypatch.setattr(S, "COMMON_SHARE", 1e-9)
    monkeypatch.setattr(S, "ROWS", 7)
    monkeypatch.setattr(S, "BLOCK_BYTES", 1 << 10)
    line = prose(30, 7)
    docs = [(i, prose(40, 100 + i) + line + prose(30, 200 + i % 9)) for i in range(40)]
    docs += [(100, prose(3_000, 1)), (101, prose(200, 2) + prose(3_000, 1)[:9_000]), (102, "a" * 5_000), (103, "a" * 4_000 + "b")]
    assert found(spark, docs, 50) == plain(docs, 50)


def test_equal_identifiers_and_copies(spark, prose):
    a, b = prose(60, 1), prose(60, 2)
    rows = [(5, a), (5, a), (5, a + b), (9, a), (9, a), (None, b), (None, a), (3, "short"), (4, "short")]
    got = found_nulls(spark, rows)
    n = {t: len(t.encode()) for t in (a, b, a + b)}
    assert got[5, n[a]] == {0} and got[5, n[a + b]] == {0} and got[9, n[a]] == {n[a]} and got[None, n[b]] == {n[b]} and got[4, 5] == {0}


def found_nulls(spark, rows):
    out = {}
    for r in S.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        out.setdefault((r.row.doc_id, r.n_bytes), set()).add(r.n_removed)
    return out


def test_doubling_ranks_in_byte_order(spark):
    pick = random.Random(3)
    texts = [bytes(pick.choices(b"abc", k=80)) for _ in range(40)] * 2
    rows = spark.createDataFrame([(i, bytearray(t), i // 40, i // 40) for i, t in enumerate(texts)], "id bigint, bytes binary, low bigint, high bigint")
    for start in (3, 13, 25, 50):
        got = {(r.id, r.pos): r.low for r in S.doubled(rows, 50, start).collect()}
        assert got == {(i, p): 0 for i in range(80) for p in range(31)}
    grams = rows.select(F.col("bytes").alias("gram"), "low", "high")
    ranks = sorted((r["rank"], bytes(r.gram)) for r in S.ranked(grams, ["gram"]).collect())
    assert [g for _, g in ranks] == sorted(set(texts))


def test_stretches_cover_all_windows():
    pick = random.Random(1)
    texts = [bytes(pick.choices(b"abcd", k=n)) for n in (0, 49, 50, 51, 300, 2_000)]
    i, start, count, _, _ = S.stretches(texts, 25)
    seen = [(int(k), int(a) + j) for k, a, c in zip(i, start, count, strict=True) for j in range(c)]
    assert sorted(seen) == [(k, p) for k, t in enumerate(texts) for p in range(len(t) - 49)] and np.all(count <= 26)


def test_shared_stretches_travel_packed(spark, monkeypatch, prose):
    """No step has a row for each stretch of shared passages; what the steps move per byte makes the operator's CPU seconds."""
    pool = [prose(400, i) for i in range(10)]
    docs = [(i, prose(8, 100 + i) + pool[i % 10] + prose(8, 300 + i)) for i in range(100)]
    rows, real = {}, S.stored

    def counted(df, label, codec=None):
        out = real(df, label, codec)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(S, "stored", counted)
    assert found(spark, docs, 50) == plain(docs, 50)
    shared = 10 * len(S.stretches([p.encode() for p in pool], 25)[0])
    assert shared > 10_000 and max(rows.values()) < shared, rows


def test_query_digests(spark, tables, prose):
    docs = [(1, prose(30, 1), "en", "s", 0), (2, "x " + prose(30, 1), "en", "s", 0)]
    from tidelog.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op12_suffix_dedup"](spark, tables(documents=docs)).collect()}
    assert got[2].kept_sha256 == hashlib.sha256(b"x ").hexdigest() and got[2].n_spans == 1 and got[1].n_removed == 0
