"""Committed offsets and their translation to a restored topic."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.commits import decode_offset_keys, decode_offset_values
from tidelog.functions.headers import old_offset
from tidelog.operators.ordering import BLOCK, number_records, offset_block
from tidelog.operators.records import valid_offset_records
from tidelog.schema import TOPIC_PARTITION
from tidelog.session import join_null_safe, small_side

KEYS = list(TOPIC_PARTITION)


def decode_offset_log(df: DataFrame) -> DataFrame:
    """Offset log with decoded keys and values."""
    return decode_offset_values(decode_offset_keys(df))


def commits_by_group(df: DataFrame, policy: str = "last") -> DataFrame:
    """Committed offset of every (group, topic, partition) of an encoded offset log.

    ``last`` takes the last commit in log order (a group may rewind), ``max`` the largest. Records
    without a value are skipped: deleting a topic writes them, and the commits before them are
    what a restore needs.
    """
    if policy not in ("last", "max"):
        raise ValueError(f"unknown policy {policy!r}")
    commits = valid_offset_records(decode_offset_log(df)).filter("offset_value IS NOT NULL")
    named = commits.select(
        F.col("offset_key.group").alias("group"),
        F.col("offset_key.topic").alias("topic"),
        F.col("offset_key.partition").alias("partition"),
        F.col("offset_value.offset").alias("committed"),
        F.col("partition").alias("_log"),
        F.col("offset").alias("_at"),
    )
    by = ["group", "topic", "partition"]
    if policy == "max":
        return named.groupBy(*by).agg(F.max("committed").alias("committed"))
    # per log partition first: plain numbers in the buffers keep both steps hash aggregations
    per_log = named.groupBy(*by, "_log").agg(F.max_by("committed", "_at").alias("committed"))
    return per_log.groupBy(*by).agg(F.max_by("committed", "_log").alias("committed"))


def committed_from_log(df: DataFrame, group: str, topic: str, policy: str = "last") -> DataFrame:
    """Rows (partition, committed) of one group on one topic."""
    return (
        commits_by_group(df, policy)
        .filter((F.col("group") == group) & (F.col("topic") == topic))
        .select("partition", "committed")
    )


def committed_from_table(df: DataFrame, group: str, topic: str) -> DataFrame:
    """Rows (partition, committed) out of a table of live commits; names match in any case."""
    return df.filter((F.lower("group") == group.lower()) & (F.lower("topic") == topic.lower())).select(
        "partition", F.col("offset").alias("committed")
    )


def offset_source(manual: DataFrame | None = None, backup: DataFrame | None = None, live: DataFrame | None = None) -> DataFrame:
    """The offsets to translate: manual ones win, else the backup's, else the cluster's."""
    chosen = next((side for side in (manual, backup, live) if side is not None), None)
    if chosen is None or chosen.isEmpty():
        raise ValueError("no offsets to translate; check the configuration")
    return chosen


def translate_offsets(
    committed: DataFrame, restored: DataFrame, policy: str = "first_at_or_after", keys=("partition",)
) -> DataFrame:
    """New offset for every committed one: rows (keys, new_offset).

    ``restored`` is the restored log, whose records carry their old offset in a header.

    ``exact``               first record with exactly the committed old offset, else no row
    ``exact_or_last``       … else the newest stamped record of the partition
    ``first_at_or_after``   first record whose old offset is the committed one or later, so that
                            none is missed; the end of the partition if the group had read all

    One aggregation by partition with partial sums; the committed side is one row per partition.
    """
    keys = list(keys)
    stamped = restored.select(*keys, F.col("offset").alias("_new"), old_offset().alias("_old"))
    pairs = stamped.join(small_side(committed.select(*keys, "committed")), keys)
    hit = F.min(F.when(F.col("_old") == F.col("committed"), F.col("_new")))
    newest = F.max(F.when(F.col("_old") >= 0, F.col("_new")))
    if policy == "exact":
        answer = hit
    elif policy == "exact_or_last":
        answer = F.coalesce(hit, newest)
    elif policy == "first_at_or_after":
        later = F.when((F.col("_old") >= 0) & (F.col("_old") >= F.col("committed")), F.col("_new"))
        answer = F.coalesce(F.min(later), newest + 1)
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return pairs.groupBy(*keys).agg(answer.alias("new_offset")).filter("new_offset IS NOT NULL")


def offset_index(source: DataFrame, restored: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Old coordinate and new coordinate of every restored record.

    ``mapping`` holds (source_topic, target_topic); without it topics kept their names. The join is
    on the record's own coordinate, so no key is hot.
    """
    new = restored.select(
        F.col("topic").alias("new_topic"),
        F.col("partition").alias("old_partition"),
        old_offset().alias("old_offset"),
        F.col("partition").alias("new_partition"),
        F.col("offset").alias("new_offset"),
        F.col("timestamp").alias("new_timestamp"),
    ).filter("old_offset >= 0")
    if mapping is None:
        new = new.withColumn("old_topic", F.col("new_topic"))
    else:
        names = mapping.select(F.col("source_topic").alias("old_topic"), F.col("target_topic").alias("new_topic"))
        new = new.join(small_side(names), "new_topic")
    old = source.select(
        F.col("topic").alias("old_topic"),
        F.col("partition").alias("old_partition"),
        F.col("offset").alias("old_offset"),
        F.col("timestamp").alias("old_timestamp"),
    )
    return old.join(new, ["old_topic", "old_partition", "old_offset"]).select(
        "old_topic", "old_partition", "old_offset", "old_timestamp",
        "new_topic", "new_partition", "new_offset", "new_timestamp",
    )


RUN_KEYS = ["old_topic", "new_topic", "partition"]


def offset_index_runs(restored: DataFrame, mapping: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """The offset index as runs: ``old_start`` … ``old_start + length - 1`` became ``new_start`` … in the same order.

    A log that was restored whole is one run per topic-partition; a gap in either log, or an interleaved topic, begins another.
    ``mapping`` is that of ``offset_index``; a target must have one source, as a run does not say which of several it is from.
    Records are numbered in blocks, so no task follows a topic-partition.
    """
    new = restored.select(F.col("topic").alias("new_topic"), "partition", old_offset().alias("_old"), F.col("offset").alias("_new"))
    new = new.filter("_old >= 0")
    if mapping is None:
        new = new.withColumn("old_topic", F.col("new_topic"))
    else:
        new = new.join(mapping.select(F.col("source_topic").alias("old_topic"), F.col("target_topic").alias("new_topic")), "new_topic")
    numbered = number_records(new, keys=RUN_KEYS, order="_new", out="_rn", block=block)
    islands = numbered.groupBy(*RUN_KEYS, (F.col("_new") - F.col("_rn")).alias("_a"), (F.col("_old") - F.col("_rn")).alias("_b"))
    return islands.agg(
        F.min("_old").alias("old_start"), F.min("_new").alias("new_start"), F.count(F.lit(1)).alias("length")
    ).select(*RUN_KEYS, "old_start", "new_start", "length")


def translate_by_runs(committed: DataFrame, runs: DataFrame, block: int = BLOCK) -> DataFrame:
    """New offsets for the commits of all groups at once: ``committed`` (old_topic, partition, committed and any other columns)
    with ``new_topic`` and ``new_offset``.

    As ``translate_offsets`` with ``first_at_or_after``: the first record at the committed offset or later, else the end of
    the partition. A commit finds its run by an as-of search: commits and the ends of runs are sorted together inside blocks of
    offsets, and one row per block tells the first run of the later ones. Old offsets grow with the new ones.
    """
    others = [c for c in committed.columns if c not in ("old_topic", "partition", "committed")]
    targets = runs.groupBy(*RUN_KEYS).agg(F.max(F.col("new_start") + F.col("length")).alias("_end"))
    asked = join_null_safe(committed, targets, ["old_topic", "partition"])
    run = F.struct("old_start", "new_start")
    ends = runs.select(*RUN_KEYS, (F.col("old_start") + F.col("length") - 1).alias("_at"), F.lit(1).alias("_kind"), run.alias("_run"))
    points = asked.select(*RUN_KEYS, F.col("committed").alias("_at"), F.lit(0).alias("_kind"), "_end", *others)
    both = ends.unionByName(points, allowMissingColumns=True).withColumn("_block", offset_block("_at", block))
    blocks = both.groupBy(*RUN_KEYS, "_block").agg(F.min_by("_run", F.when(F.col("_kind") == 1, F.col("_at"))).alias("_first"))
    # from the end on: Spark adds a row to a frame that grows, and goes anew through one that shrinks
    later = Window.partitionBy(*RUN_KEYS).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*RUN_KEYS, "_block", F.last("_first", ignorenulls=True).over(later).alias("_next"))
    inside = Window.partitionBy(*RUN_KEYS, "_block").orderBy(F.desc("_at"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("_hit", F.last("_run", ignorenulls=True).over(inside)).filter("_kind = 0")
    found = join_null_safe(found, blocks, [*RUN_KEYS, "_block"]).withColumn("_hit", F.coalesce("_hit", "_next"))
    step = F.greatest(F.col("_at") - F.col("_hit.old_start"), F.lit(0))
    new = F.coalesce(F.col("_hit.new_start") + step, F.col("_end"))
    return found.select("old_topic", "partition", F.col("_at").alias("committed"), *others, "new_topic", new.alias("new_offset"))


def starting_offsets_json(translated: DataFrame, topic: str | None = None) -> DataFrame:
    """One row per topic, whose ``starting_offsets`` is the JSON that a Kafka source takes as a start.

    ``translated`` has (partition, new_offset), and topic too unless ``topic`` names it. Partitions
    of a topic are few (a broker limit), so one row per topic is a fair size.
    """
    named = translated if topic is None else translated.withColumn("topic", F.lit(topic))
    ordered = F.array_sort(F.collect_list(F.struct("partition", "new_offset")))
    offsets = F.map_from_entries(
        F.transform(ordered, lambda e: F.struct(e["partition"].cast("string"), e["new_offset"]))
    )
    per_topic = named.groupBy("topic").agg(offsets.alias("offsets"))
    return per_topic.select("topic", F.to_json(F.create_map("topic", "offsets")).alias("starting_offsets"))
