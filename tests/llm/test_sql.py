"""The queries that SQL can say, on small tables with every odd case."""

import pytest
from pyspark.sql import functions as F

from tidelog.llm.queries import ORACLE, QUERIES

BY_SQL = ["op6_quality_cascade", "op9_substring_dedup", "op10_line_dedup", "op11_collocations", "op12_suffix_dedup"]
#: Queries that do not give a row per document.
OTHERS = ("op1_warc_reassembly", "op2_url_templates", "op7_bm25_search", "op11_collocations", "op13_conversation_repair")


@pytest.mark.parametrize("name", BY_SQL)
def test_documents(spark, tables, same_as_sql, plain_docs, name):
    folder = tables(clashes=True, documents=plain_docs)
    same_as_sql(QUERIES[name](spark, folder), ORACLE[name], folder)


PAGES = [
    (1, "https://www.Example.com/en/1", "<p>a</p>"), (2, "http://example.com/en/2", "<p>a</p>"), (3, "http://a.net/es/3", ""),
    (4, None, None), (5, "no scheme", "<p>b</p>"), (6, "x://net/fr/", "<p>a</p>"), (7, "x://ÄB.NET/fr/q?y#z", "c" * 40_000),
    (8, "://com", "c" * 40_000), (9, "http://h#f/en/", "WARC/1.1\r\n" * 3 + "\r\n\r\n" * 5), (10, "http://u.com//a\nb/%2A/*/c/d/e/f", "\r\n"),
    (11, "http://notexample.com/en/", "é" * 9_000), (12, "HTTP://evil.org/bad/1\r\nX: y", None),
]


def test_archives(spark, tables, same_as_sql):
    folder = tables(clashes=True, pages=PAGES + [(None, "u", "<p>b</p>")])
    same_as_sql(QUERIES["op1_warc_reassembly"](spark, folder), ORACLE["op1_warc_reassembly"], folder)


def test_urls(spark, tables, same_as_sql):
    rows, labels = list(PAGES), []
    for i in range(400):
        rows.append((100 + i, f"http://shop.org/{('deals', 'news', 'about')[i % 3]}/{i}.html?x", None))
        labels.append((i, int(i % 3 != 0), 0))
    labels += [(9, 0, 1), (None, 0, 0), (12, None, None)]
    folder = tables(clashes=True, pages=rows, labels=labels)
    got = QUERIES["op2_url_templates"](spark, folder)
    same_as_sql(got, ORACLE["op2_url_templates"], folder)
    verdicts = {r.path.split("/")[1]: r.verdict for r in got.filter("host = 'shop.org'").collect()}
    assert verdicts == {"deals": "block", "news": "allow", "about": "allow"}
    ruled = {r.page_id: (r.rule, r.verdict) for r in got.filter("page_id < 100").collect()}
    assert ruled[1] == ("www.example.com/en/", "allow") and ruled[2] == ("example.com/en/", "block") and ruled[6] == ("net/fr/", "block")
    assert ruled[8][0] is None and ruled[11] == ("com/", "allow")


@pytest.mark.parametrize("name", [n for n in QUERIES])
def test_empty_tables(spark, tables, name):
    assert QUERIES[name](spark, tables()).count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in OTHERS])
def test_null_and_repeated_rows(spark, tables, odd_docs, name):
    got = QUERIES[name](spark, tables(clashes=True, documents=odd_docs))
    assert got.count() == len(odd_docs)
    rows = [r.asDict() for r in got.filter(F.col("doc_id") == 7).collect()]
    assert len(rows) == 3 and len({repr(r) for r in rows}) <= (3 if name in ("op3_source_mix", "op5_packing") else 2)
    found = [r.asDict() for r in got.collect()]
    if name == "op9_substring_dedup":
        # nulls come last, so their copies lose all words; those of one identifier do not count against each other
        assert sorted((r["doc_id"] or 99, r["n_removed"]) for r in found) == [(7, 0), (7, 0), (7, 0), (9, 0), (11, 100), (99, 0), (99, 0), (99, 50), (99, 50)]
    if name == "op12_suffix_dedup":
        # a text that a smaller document holds goes as a whole, and what is left of another are the blanks between
        gone = {(r["doc_id"] or 99, r["n_bytes"], r["n_removed"]) for r in found}
        assert {(d, n == g) for d, n, g in gone if d == 99 and n} == {(99, True)} and all(g == 0 for d, _, g in gone if d in (7, 9))
    if name == "op4_bag_minhash":
        assert sorted((r["doc_id"] or 99, r["class_id"] or 99) for r in found) == [(7, 7)] * 3 + [(9, 9), (11, 11), (99, 7), (99, 7), (99, 99), (99, 99)]
    if name == "op8_language_mixture":
        assert sum(r["lang_pred"] == "und" for r in found) == 3 and all(r["held_out"] for r in found if r["doc_id"] is None)
