"""Connected components of a graph of links, by labels that shrink to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of every node in ``links`` (``a``, ``b``).

    A round takes the smallest label among a node and its neighbours, then follows the label's own label, so the number
    of rounds grows with the logarithm of a component's width where links form stars and chains of stars. A hot node is a
    hot key of a join only, which adaptive execution splits; minima are taken before the shuffle. Rounds are written.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("via"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        fresh = stored(hooked.join(jump, "via").select("node", F.least("via", "far").alias("label"), (F.least("via", "far") != F.col("old")).alias("moved")), "labels")
        labels = fresh.select("node", "label")
        if not fresh.filter("moved").limit(1).count():
            return labels
