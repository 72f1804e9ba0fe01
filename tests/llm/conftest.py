import os
import random

import duckdb
import pytest

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
#: Names that the operators use inside.
CLASHES = ["row", "key", "hash", "label", "size", "words", "n", "place", "bucket", "doc", "taken", "drop", "start", "length"]


@pytest.fixture
def tables(spark, tmp_path):
    """Writes small tables and gives their folder; tables not given are empty."""

    def write(clashes: bool = False, **rows):
        for name, ddl in SCHEMAS.items():
            df = spark.createDataFrame(rows.get(name, []), ddl)
            if clashes:
                df = df.selectExpr("*", *[f"'x{i}' AS `{c}`" for i, c in enumerate(CLASHES)])
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def same_as_sql():
    """Compares a query's rows on a folder of tables with those of its SQL."""

    def compare(df, sql, folder):
        con = duckdb.connect()
        for name in SCHEMAS:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
        wanted = con.sql(sql)
        assert sorted(wanted.columns) == sorted(df.columns)
        order = lambda rows: sorted(map(repr, rows))
        assert order(tuple(r) for r in df.select(*wanted.columns).collect()) == order(wanted.fetchall())

    return compare


WORDS = [a + b + c for a in ("ka", "lo", "mi", "ne", "ru", "te") for b in ("sha", "pel", "dor", "vin", "gu") for c in ("", "s", "ng", "rt")]


@pytest.fixture
def prose():
    """Texts of ``n`` words, the same for the same seed."""
    return lambda n, seed=0: " ".join(random.Random(seed).choices(WORDS, k=n))


@pytest.fixture
def plain_docs(prose):
    """Documents with unique identifiers: empty, blank, null and very long texts, ties, copies, common lines and passages."""
    line, passage = prose(12, 500), prose(40, 600)
    texts = [None, "", "  \n\t ", "word", prose(7, 1), prose(12, 2), prose(13, 3), prose(30_000, 4), "x" * 200_000]
    texts += [prose(60, 10 + i) + "\n" + line + "\n" + prose(5, 90 + i) for i in range(8)]
    texts += [prose(25, 200 + i) + " " + passage + " " + prose(9 + i % 5, 300 + i) for i in range(60)]
    texts += [prose(80, 10)] * 4 + [line.upper() + " \n\n" + line, "\n\n", "é" * 39 + "\n" + "é" * 40, "aa bb " * 40]
    texts += ["$ # * word & < > | % " * 5, (prose(10, 7) + "\n") * 6, "ÀÉ ABC DEF GHI " * 8, "\x0b\x0cq\x1cq\u00a0q \u2028z " * 9]
    return [(3 * i + 1, t, ("en", "fr", None)[i % 3], (None, "a", "b", "é")[i % 4], len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture
def odd_docs(prose):
    """Null and repeated identifiers, repeated rows, nulls in every column."""
    a, b = prose(50, 1), prose(50, 2)
    return [(None, None, None, None, None), (None, a, None, None, None), (None, a, "en", "s", 3), (7, a, "en", "s", 3), (7, a, "en", "s", 3),
            (7, b, "fr", "s", 3), (None, "", "fr", None, 0), (9, None, "fr", "t", 0), (11, b + " " + a, "en", "t", 0)]


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
