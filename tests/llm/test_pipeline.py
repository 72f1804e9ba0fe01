"""The stages in a row on a small table, each against what its operator's plain version would decide."""

import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from tidelog.llm.common import stored  # noqa: E402


def test_stages(spark, tables):
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in source]
    rows += [(9001, None, "en", None, 0), (9002, "12 34", "en", "x", 5), (9003, rows[3][1], "en", "x", 0), (None, rows[5][1], None, "x", 0), (9003, rows[3][1], "en", "x", 0)]
    folder = tables(clashes=True, documents=rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stored(stage(spark, docs, folder), name)
        kept[name] = docs.select("doc_id", "text").collect() if name != "packing" else None
        assert name == "packing" or docs.columns == columns
    ids = lambda name: Counter(r.doc_id for r in kept[name])
    assert not {9001, 9002} & set(ids("language_id")) and len(kept["language_id"]) >= len(rows) - 5
    assert ids("line_dedup") == ids("language_id")
    classes = ids("near_dedup")
    assert max(classes.values()) == 1 and not {9003, None} & set(classes) and {rows[3][0], rows[5][0]} & set(classes)
    # the mix takes whole texts and beginnings of them, three times at most
    texts = {r.doc_id: r.text for r in kept["near_dedup"]}
    for doc_id, times in ids("mixing").items():
        own = [r.text for r in kept["mixing"] if r.doc_id == doc_id]
        assert times <= 3 and all(texts[doc_id].startswith(t) for t in own) and sum(t != texts[doc_id] for t in own) <= 1
    assert docs.agg(F.sum("length")).first()[0] > 0
    ends = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert ends.filter("n <> end OR n > 2048").count() == 0
    pieces = docs.filter("piece = 0").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == ids("mixing")


def test_run(spark, tables):
    rows = [(i, f"The {w} of the house and the garden was in a book {i} " * 4, "en", "s", 0) for i, w in enumerate(["cat", "dog", "cow", "hen", "fox", "owl"])]
    got = corpus_pipeline.run(spark, tables(documents=rows))
    assert got.agg(F.count_distinct("sequence_id")).first()[0] == 1
    assert corpus_pipeline.run(spark, tables()).count() == 0
