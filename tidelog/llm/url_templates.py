"""URL filter: host and path rules first, then a path-template tree per host.

The tree grows level by level from the hosts. At a level every branch (a path segment below a template) is compared with
its siblings together by a chi-square test on labelled good and bad pages. Branches with little support, such as numbers
and titles, and branches that differ from their siblings by no more than chance go on as one wildcard; the others stay.
The templates at the leaves are rejected by their share of good labels, smoothed towards that of all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import stored, table

#: Levels of the tree; segments below them are one wildcard.
DEPTH = 4
#: URLs that a branch needs to stand alone, and the chi-square (one degree of freedom, 1 %) by which it must differ.
MIN_SUPPORT = 20
CHI_SQUARE = 6.635
#: Labels' worth of the overall share that smoothing adds, and the share of good labels below which a template goes.
PRIOR = 10
MIN_PURITY = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lowered; empty if there is none."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule (``host/path`` to verdict) that fits; null if none does.

    A rule fits its host and all subdomains where the path starts with the rule's. Among equally long ones the
    first in code point order counts. The rules are part of the plan: a short list, not a table.
    """
    if len(rules) > 1000:
        raise ValueError("more than 1,000 rules; keep them in a table and join by host")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(sorted(rules), key=len):
        own, _, below = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{below}")
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, rules[rule]).otherwise(verdict)
    return text, verdict


def _wild(urls: DataFrame, depth: int, min_support: int, chi_square: float) -> DataFrame:
    """``template`` of every URL (``host``, ``segments``, ``good``, ``bad``)."""
    rows = urls.withColumn("template", F.lit(""))
    for level in range(depth):
        # written between levels, or each level's plan would hold the one before three times
        rows = stored(rows, "url-level")
        rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
        branches = rows.filter("segment IS NOT NULL").groupBy("host", "template", "segment").agg(
            F.count(F.lit(1)).alias("n"), F.sum("good").alias("g"), F.sum("bad").alias("b")
        )
        nodes = branches.groupBy("host", "template").agg(F.sum("g").alias("all_g"), F.sum("b").alias("all_b"))
        good, bad, all_good, all_bad = (F.col(c).cast("double") for c in ("g", "b", "all_g", "all_b"))
        own, rest = good + bad, all_good + all_bad - good - bad
        gap = bad * (all_good - good) - good * (all_bad - bad)
        # of the two-by-two table; without labels or without siblings there is nothing to tell apart
        product = own * rest * all_good * all_bad
        differs = (all_good + all_bad) * gap * gap > F.lit(chi_square) * product
        kept = branches.filter(F.col("n") >= min_support).join(nodes, ["host", "template"]).filter((product > 0) & differs)
        rows = rows.join(kept.select("host", "template", "segment", F.lit(True).alias("own")), ["host", "template", "segment"], "left")
        step = F.when(F.col("segment").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.when(F.col("own"), F.col("segment")).otherwise(F.lit("*"))))
        rows = rows.withColumn("template", F.concat("template", step)).drop("own", "segment")
    rows = stored(rows, "url-leaves")
    deeper = F.when(F.size("segments") > depth, F.lit("/**")).otherwise(F.lit(""))
    return rows.withColumn("template", F.concat("template", deeper))


def judge_urls(
    urls: DataFrame,
    rules: dict[str, str],
    depth: int = DEPTH,
    min_support: int = MIN_SUPPORT,
    chi_square: float = CHI_SQUARE,
    prior: float = PRIOR,
    min_purity: float = MIN_PURITY,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``template``, ``purity``, ``verdict`` for ``id``, ``url``, ``good``, ``bad`` (labels, 0 or 1 each, null for none).

    A null URL or one without ``://`` has an empty host and path, and so the empty host's tree. A literal ``*`` in a path
    is told from a wildcard by its escaped form ``%2A``. Without any label the overall share counts as 1. Repeated rows count as often.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parts = F.split(F.regexp_replace(F.regexp_replace("path", "^/", ""), r"\*", "%2A"), "/", -1)
    label = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    rows = urls.select("id", host.alias("host"), path.alias("path"), label("good"), label("bad"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", parts.alias("segments"), text.alias("rule"), verdict.alias("ruled"))
    leaves = _wild(rows, depth, min_support, chi_square).drop("segments")
    totals = rows.agg(F.sum("good"), F.sum("bad")).first()
    good, bad = totals[0] or 0, totals[1] or 0
    share = F.lit(float(good)) / F.lit(float(good + bad)) if good + bad else F.lit(1.0)
    purity = (F.sum("good") + prior * share) / (F.sum("good") + F.sum("bad") + prior)
    stats = leaves.groupBy("host", "template").agg(purity.alias("purity"))
    said = F.coalesce("ruled", F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow")))
    return leaves.join(stats, ["host", "template"]).select("id", "host", "path", "rule", "template", "purity", said.alias("verdict"))


#: Fixed values of the query's contract.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by the labels of the documents whose number ends their path; bad is low quality or toxic."""
    number = F.expr(r"try_cast(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*?/([0-9]+)(\\.html)?/?([?#]|$)', 1) AS bigint)")
    bad = F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int"))
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("_doc")).agg(bad.alias("bad"))
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", number.alias("_number"))
    known = pages.join(labels, F.col("_number") == F.col("_doc"), "left")
    judged = judge_urls(known.select("id", "url", (1 - F.col("bad")).alias("good"), "bad"), RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _sql() -> str:
    steps, rows = [], "s"
    for level in range(DEPTH):
        tail = f"""
b{level} AS (SELECT host, t, ss[{level + 1}] AS seg, count(*) AS n, sum(good) AS g, sum(bad) AS b FROM {rows} WHERE len(ss) > {level} GROUP BY 1, 2, 3),
n{level} AS (SELECT host, t, CAST(sum(g) AS DOUBLE) AS ag, CAST(sum(b) AS DOUBLE) AS ab FROM b{level} GROUP BY 1, 2),
k{level} AS (SELECT * FROM b{level} JOIN n{level} USING (host, t) WHERE n >= {MIN_SUPPORT} AND (g + b) * (ag + ab - g - b) * ag * ab > 0
  AND (ag + ab) * (b * (ag - g) - g * (ab - b)) * (b * (ag - g) - g * (ab - b)) > {CHI_SQUARE} * ((g + b) * (ag + ab - g - b) * ag * ab)),
r{level} AS (SELECT x.* EXCLUDE (t), x.t || CASE WHEN len(x.ss) <= {level} THEN '' WHEN k.seg IS NULL THEN '/*' ELSE '/' || k.seg END AS t
  FROM {rows} x LEFT JOIN k{level} k ON x.host = k.host AND x.t = k.t AND k.seg = x.ss[{level + 1}])"""
        steps.append(tail)
        rows = f"r{level}"
    ruled = [(r, v) for r, v in sorted(RULES.items(), key=lambda x: -len(x[0]))]
    fits = lambda r: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*r.split("/", 1))
    text = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in ruled)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in ruled)
    return f"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
p AS (SELECT page_id, coalesce(url, '') AS url, try_cast(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*?/([0-9]+)(\\.html)?/?([?#]|$)', 1), '') AS BIGINT) AS d FROM pages),
u AS (SELECT page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, coalesce(1 - bad, 0) AS good, coalesce(bad, 0) AS bad FROM p LEFT JOIN l ON d = doc_id),
s AS (SELECT *, string_split(replace(regexp_replace(path, '^/', ''), '*', '%2A'), '/') AS ss, '' AS t FROM u),{",".join(steps)},
f AS (SELECT * EXCLUDE (t), t || CASE WHEN len(ss) > {DEPTH} THEN '/**' ELSE '' END AS t FROM {rows}),
a AS (SELECT CASE WHEN coalesce(sum(good + bad), 0) = 0 THEN 1.0::DOUBLE ELSE CAST(sum(good) AS DOUBLE) / CAST(sum(good + bad) AS DOUBLE) END AS share FROM f),
q AS (SELECT host, t, (sum(good) + {PRIOR} * max(share)) / (sum(good) + sum(bad) + {PRIOR}) AS purity FROM f, a GROUP BY host, t)
SELECT page_id, host, path, CASE {text} END AS rule,
       CASE {verdict} WHEN purity < {MIN_PURITY} THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT f.*, purity FROM f JOIN q ON f.host = q.host AND f.t = q.t)
"""


OP2_SQL = _sql()
