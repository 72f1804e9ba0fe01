"""Queries that have to hold on data much larger than the test tables."""

import re
from pathlib import Path

import duckdb
import pytest

from tidelog.plans import catalog
from tidelog.plans import derived as D
from tidelog.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def same_as_sql(df, name):
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    wanted = con.sql(ORACLE[name])
    assert sorted(map(repr, (tuple(r) for r in df.select(*wanted.columns).collect()))) == sorted(map(repr, wanted.fetchall()))


@pytest.mark.parametrize("name", ["watch_files", "watched_log"])
def test_watched_files_are_bounded(spark, monkeypatch, name):
    monkeypatch.setattr(catalog, "PART", 16, raising=False)
    monkeypatch.setattr(D, "_written", {})
    same_as_sql(catalog.QUERIES[name](spark, SF), name)
    (folder,) = [path for (_, _, label), path in D._written.items() if label == "texts"]
    files = [str(f) for f in Path(re.sub("^file:/*", "/", folder)).rglob("*.txt")]
    con = duckdb.connect()
    ((langs, parts),) = con.sql(f"SELECT count(DISTINCT lang), count(DISTINCT (lang, doc_id // 16)) FROM read_parquet('{SF}/documents.parquet')").fetchall()
    assert len(files) == parts > 4 * langs


def test_generations_of_every_topic(spark, monkeypatch):
    monkeypatch.setattr(D, "_written", {})
    same_as_sql(catalog.QUERIES["import_avro_generation"](spark, SF), "import_avro_generation")
    (folder,) = D._written.values()
    folder = Path(re.sub("^file:/*", "/", folder))
    log = D.event_log(spark, SF).select("topic", "partition").distinct().collect()
    assert {str(f.relative_to(folder)) for f in folder.glob("*/*/*")} == {f"{t}/{g}/{p}" for t, p in log for g in ("gen-a", "gen-b")}
