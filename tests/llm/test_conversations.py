"""Repair of conversations against all possible edits, and against SQL."""

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import conversations as C
from tidelog.llm.queries import ORACLE, QUERIES

GOOD = re.compile("(s?(ua)+)?")


def every_plan(symbols):
    """All plans with at most one inserted row in a place, by brute force: (cost, letters)."""
    options = []
    for s in symbols:
        own = [("D", 2, "")]
        if s != "-":
            extra = 5 if s.isupper() else 0
            own += [("K", extra, s.lower()), ("R", 1 + extra, "u"), ("R", 1 + extra, "a")]
        options.append(own)
    places = [[("", 0, ""), ("I", 5, "u"), ("I", 5, "a")]] * (len(symbols) + 1)
    for edits in itertools.product(*options):
        for inserts in itertools.product(*places):
            parts = [x for pair in zip(inserts, edits) for x in pair] + [inserts[-1]]
            if GOOD.fullmatch("".join(p[2] for p in parts)):
                yield sum(p[1] for p in parts), "".join(p[0] for p in parts)


@pytest.mark.parametrize("size", [0, 1, 2, 3])
def test_all_plans(size):
    for symbols in itertools.product("suaxSUAX-", repeat=size):
        assert C.finished(C.solve("".join(symbols))) == min(every_plan(symbols))


@given(st.text(alphabet="suaxSUAX-", max_size=24), st.lists(st.integers(0, 24), max_size=4))
@settings(deadline=None, max_examples=150)
def test_blocks_join(symbols, cuts):
    edges = sorted({0, len(symbols), *(min(c, len(symbols)) for c in cuts)})
    plans = C.solve("")
    for a, b in itertools.pairwise(edges):
        plans = C.joined(plans, C.solve(symbols[a:b]))
    assert C.finished(plans) == C.finished(C.solve(symbols)) == C.finished(C.solve(symbols, (C.START,)))


def talks(seed, n):
    pick = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "uu"], ["Hi.", "Hi", " ", "", None, "What?", "\u00a0", "a.\n", "b. c"]
    return [(pick.choice([None, *range(40)]), pick.choice([None, *range(-1, 9)]), pick.choice(roles), pick.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block", [2, 512])
def test_same_as_sql(spark, tables, same_as_sql, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    monkeypatch.setattr(C, "JOINED", 3)
    rows = talks(1, 500) + [(77, i, ("user", "assistant")[i % 2], f"Text {i}.") for i in range(60)] + [(78, 1, "user", "Hi.")] * 5
    folder = tables(clashes=True, conversations=rows)
    same_as_sql(QUERIES["op13_conversation_repair"](spark, folder), ORACLE["op13_conversation_repair"], folder)


def test_repaired_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "system", "Be.", 1), (1, 1, "assistant", "Yes.", 1), (1, 2, "user", " ", 1), (1, 3, "user", "Ok?", 2), (2, 0, "user", "a.", 1), (2, 1, "assistant", "b", 1)],
        "conv_id bigint, turn bigint, role string, text string, copies bigint",
    )
    plans, marked = C.plans_of(rows)
    found = {r.conv_id: (r.cost, r.audit) for r in plans.collect()}
    got = {c: [(r.edit, r.role, r.text) for r in sorted(C.repaired_rows(plans, marked).filter(f"conv_id = {c}").collect(), key=lambda r: r.place)] for c in (1, 2)}
    # of two changed roles and a deleted row with a changed one the first is as cheap or cheaper
    assert found[1] == (6, "KRDRD") and got[1] == [("K", "system", "Be."), ("R", "user", "Yes."), ("R", "assistant", "Ok?")]
    assert found[2] == (4, "DD") and got[2] == []
