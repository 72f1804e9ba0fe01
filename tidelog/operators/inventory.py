"""What a backup holds: topics, partitions, files, and whether they lie in the expected folders."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.names import parse_topic_map, target_topics


def backup_inventory(df: DataFrame, topic_map: str = "") -> DataFrame:
    """Partitions per (source topic, target topic), topics with most partitions first.

    ``df`` needs topic and partition only: a file listing does, and no record is read.
    """
    counted = (
        df.select("topic", "partition")
        .groupBy("topic")
        .agg(F.count_distinct("partition").alias("partitions"), F.sort_array(F.collect_set("partition")).alias("ids"))
    )
    return counted.select(
        F.col("topic").alias("source_topic"),
        F.explode(target_topics("topic", parse_topic_map(topic_map))).alias("target_topic"),
        "partitions",
        "ids",
    ).orderBy(F.desc("partitions"), "source_topic", "target_topic")


def check_layout(paths: DataFrame, generation: str | None = None, path: str = "path") -> DataFrame:
    """Per topic: number of files, and whether all lie at the depth that the restore expects.

    ``path`` is relative to the backup root. With a generation a path has four levels
    (topic/generation/partition/file), without one it has three.
    """
    parts = F.split(F.col(path), "/")
    rows = paths.select(F.get(parts, F.lit(0)).alias("topic"), parts.alias("_parts"))
    if generation is not None:
        rows = rows.filter(F.get("_parts", F.lit(1)) == generation)
    depth = 3 if generation is None else 4
    return rows.groupBy("topic").agg(
        F.count(F.lit(1)).alias("files"), F.bool_and(F.size("_parts") == depth).alias("ok")
    )


def require_layout(paths: DataFrame, generation: str | None = None, path: str = "path", topics=()) -> None:
    """Refuse a backup whose files lie at another depth, or that has none of one of ``topics``."""
    found = check_layout(paths, generation, path)
    missing = set(topics) - {r.topic for r in found.select("topic").collect()} if topics else set()
    if missing:
        named = "" if generation is None else f" named {generation}"
        raise ValueError(f"no backup{named} of topic {', '.join(sorted(missing))}")
    wrong = found.filter("NOT ok").first()
    if wrong is not None:
        raise ValueError(
            f"topic {wrong.topic}: "
            + ("the backup contains generations, name one" if generation is None else f"no backup named {generation}")
        )
