"""Phrase mining against plain counts, with samples that propose all, some or nothing."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import phrases as P

SPLIT = re.compile("[.,;:!?\n\x0b\x0c\r]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(docs):
    counts, totals = Counter(), Counter()
    for _, lang, text in docs:
        for piece in SPLIT.split((text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return counts, totals


def some_docs(seed, n):
    pick = random.Random(seed)
    words = ["a", "B", "the", "é", "of", "x1", "\u00a0q", "Z-z", "c\x1cd"]
    joints = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ? "]
    out = []
    for i in range(n):
        text = "".join(pick.choice(words) + pick.choice(joints) for _ in range(pick.randrange(0, 60)))
        out.append((i, pick.choice(["en", "fr", None, "und"]), pick.choice([text, text, text, None, ""])))
    return out


@pytest.mark.parametrize("every,least", [(1, 1), (3, 2), (2, 9), (10**9, 10**6)])
def test_frequent_phrases(spark, every, least):
    docs = some_docs(every, 120)
    counts, totals = plain_counts(docs)
    rows = P.frequent_phrases(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"), 12, every, least).collect()
    found = [(r.lang, r.phrase, r.n) for r in rows if r.k]
    assert sorted(found) == sorted((*key, n) for key, n in counts.items() if n >= 12) and len(found) == len(set(found))
    assert {r.lang: r.n for r in rows if not r.k and r.n} == {k: n for k, n in totals.items() if n}


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """Hashes of few bits: most phrases share theirs with others, and are counted by their words."""
    real = P.longer
    monkeypatch.setattr(P, "longer", lambda h, w: (real(h, w) >> np.uint64(56)) << np.uint64(56))
    docs = some_docs(9, 60)
    counts, _ = plain_counts(docs)
    rows = P.frequent_phrases(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"), 12, 2, 2).collect()
    assert {(r.lang, r.phrase): r.n for r in rows if r.k} == {k: n for k, n in counts.items() if n >= 12}


def test_small_chunks(spark, monkeypatch):
    text = "the cat sat on the mat, the cat sat. " * 40 + "w" * 3_000 + " the cat sat on"
    monkeypatch.setattr(P, "BLOCK_BYTES", 16)
    monkeypatch.setattr(P.chunks, "__defaults__", (16,))
    counts, _ = plain_counts([(0, "en", text)])
    rows = P.frequent_phrases(spark.createDataFrame([(0, "en", text)], "doc_id bigint, lang string, text string"), 2, 1, 1).collect()
    assert {(r.lang, r.phrase): r.n for r in rows if r.k} == {k: n for k, n in counts.items() if n >= 2}


def test_scores_are_exact(spark):
    big = 10**13
    counts = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "c", 1, big), ("en", "a b", 2, big - 1), ("en", "b c", 2, 80), ("en", "a b c", 3, 64), ("en", None, 0, 3 * big)]
    monkey = P.frequent_phrases
    try:
        P.frequent_phrases = lambda *a: spark.createDataFrame(counts, "lang string, phrase string, k int, n bigint")
        found = {r.phrase: r for r in P.collocations(None).collect()}
    finally:
        P.frequent_phrases = monkey
    assert found["a b"].score == 2_000_000 * (big - 1) // (2 * big + 1) and found["a b"].n == 3 * big
    # 64 are 80 % of 80: the longer phrase takes the place of the shorter one
    assert "b c" not in found and (found["a b c"].l, found["a b c"].r) == (big, 80)


def test_first_phrases_of_a_language(spark):
    rows = [("en", f"p{i:04d} q", 30 + i % 3, 1, 1, 1, i % 7) for i in range(3_000)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    wanted = sorted(rows, key=lambda r: (-r[6], -r[2], r[1].encode()))[:2_000]
    got = sorted((r["rank"], r.phrase) for r in P.first_phrases(df).collect())
    assert got == [(i, r[1]) for i, r in enumerate(wanted, 1)]


def test_filter_holds_what_it_is_made_of(spark):
    words = P.Words([(b"A b  C\td", 9)])
    h = P.longer(np.full(4, P.seed("en")), words.hashes)
    for k in range(1, 4):
        h = P.longer(h[:-1], words.hashes[k:])
    some = [int(h[0].view(np.int64)), -1, 0, 1 << 62, -(1 << 63)]
    bits = P.filter_of(spark.createDataFrame([(x,) for x in some], "hash bigint"))
    assert sum(int(x).bit_count() for x in bits[np.flatnonzero(bits)]) == 5
    assert P.has(bits, np.array(some, np.int64).view(np.uint64)).all() and not P.has(bits, np.array([1 << 40], np.uint64)).any()
