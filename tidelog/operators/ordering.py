"""Numbering and running values inside a topic-partition, without one task per topic-partition.

One topic-partition may hold a third of the log. A window over (topic, partition) would sort that
third in one task. Here the records of a topic-partition are cut into blocks by their offset.
Offsets are unique inside a topic-partition, so a block of width ``block`` never holds more than
``block`` records, whatever the data. Windows run inside blocks; one small row per block carries
the count or maximum of the earlier blocks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schema import TOPIC_PARTITION
from tidelog.session import checkpointed, join_null_safe

#: Offsets per block.
BLOCK = 1 << 20


def offset_block(order: str = "offset", block: int = BLOCK) -> Column:
    return F.expr(f"`{order}` div {block}")


def _carry(df, keys, order, block, summary: Column, carry):
    """``df`` with ``_block`` and ``_carry``: the summary of all earlier blocks of the same key."""
    blocks = (
        df.select(*keys, order, *[c for c in ("_value",) if c in df.columns])
        .groupBy(*keys, offset_block(order, block).alias("_block"))
        .agg(summary.alias("_n"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*keys, "_block", carry(F.col("_n")).over(earlier).alias("_carry"))


def number_records(
    df: DataFrame, keys=TOPIC_PARTITION, order: str = "offset", out: str = "rn", block: int = BLOCK
) -> DataFrame:
    """Add ``out``: 1, 2, 3 … inside ``keys`` by ``order`` (a unique integer inside ``keys``)."""
    keys = list(keys)
    before = _carry(df, keys, order, block, F.count(F.lit(1)), F.sum)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    local = df.withColumn("_block", offset_block(order, block)).withColumn("_in_block", F.row_number().over(inside))
    joined = join_null_safe(local, before, [*keys, "_block"])
    return joined.withColumn(out, F.col("_in_block") + F.coalesce("_carry", F.lit(0))).drop("_block", "_in_block", "_carry")


def running_max(
    df: DataFrame,
    value: Column,
    keys=TOPIC_PARTITION,
    order: str = "offset",
    out: str = "running",
    block: int = BLOCK,
) -> DataFrame:
    """Add ``out``: the largest ``value`` of all records of ``keys`` up to this one's ``order``."""
    keys = list(keys)
    valued = df.withColumn("_value", value)
    before = _carry(valued, keys, order, block, F.max("_value"), F.max)
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    local = valued.withColumn("_block", offset_block(order, block)).withColumn(
        "_top", F.max("_value").over(inside)
    )
    joined = join_null_safe(local, before, [*keys, "_block"])
    return joined.withColumn(out, F.greatest("_top", "_carry")).drop("_block", "_value", "_top", "_carry")


def prefix_sum(df: DataFrame, order, weight: str, out: str = "base") -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows that sort before this one in ``order``.

    For one total order over a whole table that has no integer key, such as file names. The rows
    are range-partitioned and checkpointed, which freezes the layout; every task then adds up its
    own range and one row per task carries the rest. Pass narrow rows.
    """
    order = [order] if isinstance(order, str) else list(order)
    ranged = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task of the range partitioning, so the ungrouped window and the broadcast are small
    carry = (
        ranged.groupBy("_part")
        .agg(F.sum(weight).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carry"))
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    joined = local.join(F.broadcast(carry), "_part")
    return joined.withColumn(out, F.col("_before") + F.col("_carry")).drop("_part", "_before", "_carry")
