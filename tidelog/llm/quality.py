"""Quality rules as a short-circuit cascade.

Each rule is a column that is true where a document fails. Cost (time) and rejection of every rule are estimated on a
bounded sample, then the rules are put in order of rejection per cost and tested one after another in a CASE, so a
document pays only for the rules up to the first that it fails. The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import SPACE_CHARS, WORD, stored, table

#: Documents on which costs and rejections are estimated.
SAMPLE_ROWS = 500
WINDOW = 8
SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` holds where a document is to go; a null is no failure."""

    name: str
    fails: Column


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) with the base measures; a null text is an empty one.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines`` (equal to an earlier line) and
    ``n_repeat_words``: words in windows of eight words that occur twice or more in the text. Windows are compared by
    64-bit hashes, sorted; only a text with equal ones pays for the places of its windows.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(F.col("body"), "\n"), lambda x: x.rlike(WORD))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    pairs = lambda step: lambda x, i: F.xxhash64(x, F.get("hashes", i + step))
    out = docs.select("doc_id", text.alias("body")).withColumn("words", F.regexp_extract_all("body", F.lit(WORD), F.lit(0)))
    out = out.withColumns({
        "n_words": F.size("words").cast("bigint"),
        "lines": lines,
        "word_chars": F.length(F.translate("body", SPACE_CHARS, "")).cast("bigint"),
        "n_symbols": (F.length("body") - F.length(F.regexp_replace("body", SYMBOL, ""))).cast("bigint"),
        "hashes": hashes,
    })
    for step in (1, 2, 4):
        # hashes of 2, 4 and then 8 words from each place
        shorter = F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - step, F.lit(0)))
        out = out.withColumn("hashes", F.transform(shorter, pairs(step)))
    out = out.withColumn("sorted", F.sort_array("hashes"))
    out = out.withColumn("repeats", F.exists(F.sequence(F.lit(1), F.size("sorted")), lambda i: F.get("sorted", i) == F.get("sorted", i - 1)))
    placed = F.array_sort(F.transform("hashes", lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    same = lambda i, j: F.get(F.col("placed"), i)["hash"] == F.get(F.col("placed"), j)["hash"]
    found = F.filter("placed", lambda x, i: F.coalesce(same(i, i + 1), F.lit(False)) | ((i > 0) & F.coalesce(same(i, i - 1), F.lit(False))))
    starts = F.array_sort(F.transform(found, lambda x: x["at"]))
    # a window reaches to its end, or to the start of the next one
    covered = F.transform("starts", lambda x, i: F.least(F.coalesce(F.get("starts", i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    out = out.withColumn("placed", F.when(F.col("repeats"), placed)).withColumn("starts", F.when(F.col("repeats"), starts))
    repeated = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint")
    return out.withColumn("n_repeat_words", repeated).select(
        "doc_id", "body", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), "n_repeat_words",
    )


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejection per cost, highest first.

    The sample is the first ``sample_rows`` rows that Spark finds, written once. A rule's cost is the time that testing
    it alone takes on the sample; a rule that rejects nothing goes last, the cheapest of those first.
    """
    sample = stored(docs.limit(sample_rows), "rule-sample")
    counts = sample.agg(*[F.sum(F.coalesce(r.fails, F.lit(False)).cast("int")).alias(f"r{i}") for i, r in enumerate(rules)]).first()
    scored = []
    for i, rule in enumerate(rules):
        start = time.perf_counter()
        sample.filter(rule.fails).count()
        cost = time.perf_counter() - start
        scored.append(((counts[i] or 0) / cost, -cost, i))
    return [rules[i] for _, _, i in sorted(scored, reverse=True)]


def first_failure(rules: list[Rule]) -> Column:
    """Name of the first of ``rules`` that fails, tested in order and no further; null if none does."""
    case = F.when(F.coalesce(rules[0].fails, F.lit(False)), F.lit(rules[0].name))
    for rule in rules[1:]:
        case = case.when(F.coalesce(rule.fails, F.lit(False)), F.lit(rule.name))
    return case


def document_rules() -> list[Rule]:
    """Rules over the columns of ``measured``; those from ``shouting`` on look at the text again."""
    letters = lambda kind: F.regexp_count("body", F.lit(kind))
    spread = F.size(F.array_distinct(F.regexp_extract_all("body", F.lit(WORD), F.lit(0))))
    return [
        Rule("short", F.col("n_words") < 20),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        Rule("symbols", 10 * F.col("n_symbols") > F.col("n_words")),
        Rule("word_length", (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words"))),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("shouting", 2 * letters(r"\p{Lu}") > letters(r"\p{L}")),
        Rule("few_letters", 2 * letters(r"\p{L}") < F.col("word_chars")),
        Rule("few_distinct_words", 20 * spread < F.col("n_words")),
    ]


def judged(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``measured`` with ``failed``: the rule that a document failed first, null if it passes all."""
    rows = measured(docs)
    ordered = order_rules(rows, rules or document_rules(), sample_rows)
    return rows.withColumn("failed", first_failure(ordered))


def op6_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & F.col("failed").isNull()).alias("kept"),
    )


_SPACE = "\\x20\\x09-\\x0D"
OP6_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT doc_id, body, regexp_extract_all(body, '[^{_SPACE}]+') AS ws FROM d),
x AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 0) + 1)) AS i FROM w),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM x),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS at FROM r WHERE c > 1),
n AS (SELECT doc_id, count(*) AS n_repeat_words FROM c GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^{_SPACE}]')) AS ls FROM d),
m AS (SELECT w.doc_id, w.body, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(w.body, '[{_SPACE}]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(w.body, '{SYMBOL}')) AS BIGINT) AS n_symbols,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(regexp_extract_all(w.body, '\\p{{Lu}}')) AS uppers, len(regexp_extract_all(w.body, '\\p{{L}}')) AS letters,
        len(list_distinct(ws)) AS spread
      FROM w JOIN l ON w.doc_id = l.doc_id LEFT JOIN n ON w.doc_id = n.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * uppers > letters OR 2 * letters < word_chars OR 20 * spread < n_words) AS kept
FROM b
"""
