"""Mixing sources to target weights by a low-discrepancy schedule.

Slot j of the schedule goes to the source in whose share of the cumulative weights the golden-ratio point frac(j * phi)
falls. The slots of a source are ranked; slot r of a source reads block r of the source's stream: its documents in a
shuffled order, over and over, cut into blocks of equal words. Every source has the slots that its target needs: the
few that the points lack are appended, the few too many are left out, and the last block stops at the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, stored, table

#: Words of a block, which is what a slot reads.
BLOCK_WORDS = 1024
#: No source, and so no document, is read more often than this.
MOST_PASSES = 3
WEIGHTS = (1, 2, 3)
#: Documents that one window sorts, about.
BUCKET_ROWS = 4_096
#: Slots that one window ranks; points have 40 bits, so that products of them fit 62 bits.
PAGE_SLOTS = 1 << 16
POINT_BITS = 40
GOLDEN = round((5**0.5 - 1) / 2 * (1 << POINT_BITS))
#: Cells in which points meet the sources' intervals.
CELL_BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``source``, ``source_size`` with ``place`` (by code point, null last), ``weight`` (repeating) and ``target``.

    Targets share all sizes together by weight. A target stops at ``most`` times its source's size, and what it
    leaves is shared anew by weight. By size over weight the sources that stop come first, so running sums find
    them. The windows over all sources sort as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    all_rows = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(
        F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    # the rest by weight, if all sources from here on were to share it
    level = left / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # the others share at the level of the first of them
    shared = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(all_rows)
    return (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size").cast("double") * most)
        .withColumn("level", level)
        .withColumn("stops", F.col("level") * F.col("weight") >= F.col("cap"))
        .withColumn("target", F.when(F.col("stops"), F.col("cap")).otherwise(shared * F.col("weight")))
        .select("source", "source_size", "place", "weight", "target")
    )


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Slots (``slot``, ``place``, ``rank``) for ``goals`` (``place``, ``goal`` in words).

    A slot past the last point, for a source that the points gave too few, may share its number with other sources'.
    """
    spark = goals.sparkSession
    goals = goals.withColumn("need", F.ceil(F.col("goal") / block))
    total = goals.agg(F.coalesce(F.sum("goal"), F.lit(0))).first()[0]
    slots = -(-total // block)
    whole, unit = Window.orderBy("place"), 1 << POINT_BITS
    cut = lambda c: F.floor(c / max(total, 1) * unit)
    upto = F.sum("goal").over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shares = goals.withColumn("high", cut(upto)).withColumn("low", cut(upto - F.col("goal"))).filter("low < high")
    shift = POINT_BITS - CELL_BITS
    cells = shares.withColumn("cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))))
    page, inside = F.expr(f"id div {PAGE_SLOTS}"), F.col("id") % PAGE_SLOTS
    point = (page * (PAGE_SLOTS * GOLDEN % unit) + inside * GOLDEN).bitwiseAND(F.lit(unit - 1))
    points = spark.range(slots).select(F.col("id").alias("slot"), page.alias("page"), point.alias("point"))
    points = points.withColumn("cell", F.shiftright("point", shift))
    taken = points.join(cells, "cell").filter("low <= point AND point < high").select("slot", "page", "place")
    # ranks: inside pages, then one row per page carries the earlier pages' counts
    pages = taken.groupBy("place", "page").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("place").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select("place", "page", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = taken.withColumn("in_page", F.row_number().over(Window.partitionBy("place", "page").orderBy("slot")) - 1)
    ranked = ranked.join(pages, ["place", "page"]).withColumn("rank", F.col("before") + F.col("in_page"))
    drawn = ranked.join(goals.select("place", "need"), "place").filter("rank < need").select("slot", "place", "rank")
    have = taken.groupBy("place").agg(F.count(F.lit(1)).alias("have"))
    lacking = goals.join(have, "place", "left").withColumn("have", F.coalesce("have", F.lit(0))).filter("have < need")
    appended = lacking.select("place", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank"))
    return drawn.unionByName(appended.select((F.col("rank") + slots).alias("slot"), "place", "rank"))


def mix(docs: DataFrame, weights=WEIGHTS, block: int = BLOCK_WORDS, most: int = MOST_PASSES) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (``doc_id``, ``source``, ``text``), and its documents.

    Documents: ``row`` (a struct that names the row: place, bucket, number), ``doc_id``, ``hash``, ``size``, ``source_size``, ``target``.
    Mix: ``slot``, ``place``, ``rank``, ``row``, ``first`` and ``length``: words of a document that a slot reads; ``pass`` counts
    from 0. A source's pieces together have its target rounded to whole words.

    A null text has size 0 and no piece. Null is a source of its own. Repeated rows are documents of their own. The order is by hash of
    identifier and text, so a rerun gives the same mix.
    """
    hashed = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).alias("hash")
    sized = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", n_words(F.col("text")).alias("size"), hashed), "mix-sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sources, weights, most).withColumn("goal", F.round("target").cast("bigint")), "mix-targets")
    width = (1 << 62) // max(1, -(-sized.count() // BUCKET_ROWS)) + 1
    same = goals.select(F.col("source").alias("_source"), "source_size", "place", "target", "goal")
    placed = sized.join(same, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("bucket", F.expr(f"hash div {width}"))
    # where a document begins in its source's stream: inside buckets of the hash, then one row per bucket carries the earlier ones
    buckets = placed.groupBy("place", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("place", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("place", "bucket").orderBy("hash", "doc_id", "size")
    local = placed.withColumn("n", F.row_number().over(inside)).withColumn(
        "start", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    rows = stored(
        local.join(buckets, ["place", "bucket"]).select(
            F.struct("place", "bucket", "n").alias("row"), "place", "doc_id", "hash", "size", "source_size", "target", "goal",
            (F.col("start") + F.col("before")).alias("start"),
        ),
        "mix-rows",
    )
    passes = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("from", F.col("start") + F.col("pass") * F.col("source_size"))
    passes = passes.withColumn("to", F.least(F.col("from") + F.col("size"), "goal")).filter("from < to")
    pieces = passes.withColumn("rank", F.explode(F.sequence(F.expr(f"from div {block}"), F.expr(f"(to - 1) div {block}"))))
    pieces = pieces.withColumn("begin", F.greatest("from", F.col("rank") * block)).withColumn("end", F.least("to", (F.col("rank") + 1) * block))
    chosen = pieces.select("place", "rank", "row", "pass", (F.col("begin") - F.col("from")).alias("first"), (F.col("end") - F.col("begin")).alias("length"))
    slots = schedule(goals.select("place", "goal"), block)
    return chosen.join(slots, ["place", "rank"]), rows.select("row", "doc_id", "hash", "size", "source_size", "target")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """Documents of ``mix`` with ``taken``: words the mix takes of each, repeats counted."""
    pieces, rows = mix(docs, **options)
    taken = pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    return rows.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return taken_words(docs).select("doc_id", "size", "source_size", "target", "taken")
