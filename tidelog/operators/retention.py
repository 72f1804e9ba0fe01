"""Retention rules, by file age and by record age."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.names import policy_scope
from tidelog.schema import DEFAULT_RETENTION_DAYS, TOPIC_PARTITION
from tidelog.session import join_null_safe

KEYS = list(TOPIC_PARTITION)


def rule(
    spark: SparkSession, job: str, topic: str, days: int = DEFAULT_RETENTION_DAYS, generation: str | None = None
) -> DataFrame:
    """One enabled rule, named ``<job>-rule-<topic>``."""
    if days < 0:
        raise ValueError("days must not be negative")
    return spark.range(1).select(
        F.lit(f"{job}-rule-{topic}").alias("rule_id"),
        F.lit(topic).alias("topic"),
        F.lit(generation).cast("string").alias("generation"),
        F.lit(days).alias("days"),
        F.lit(True).alias("enabled"),
    )


def upsert_policy(policy: DataFrame, rules: DataFrame) -> DataFrame:
    """``policy`` with ``rules`` put in; a rule id replaces the same id in any case, others stay."""
    ids = rules.select(F.lower("rule_id").alias("_id")).distinct()
    kept = policy.withColumn("_id", F.lower("rule_id")).join(ids, "_id", "left_anti").drop("_id")
    return kept.unionByName(rules)


def with_scope(policy: DataFrame) -> DataFrame:
    """Policy with the object prefix of every rule."""
    return policy.withColumn("scope", policy_scope("topic", "generation"))


def expired_files(files: DataFrame, policy: DataFrame, now: Column) -> DataFrame:
    """Files older than an enabled rule of their topic (and generation, if the rule names one).

    ``files``: (path, topic, generation, modified). Nothing is deleted; hand the result to
    ``tidelog.sources.sinks.delete_files``.
    """
    active = policy.filter("enabled").select(
        F.col("topic"), F.col("generation").alias("_generation"), F.col("days").alias("_days")
    )
    aged = F.col("modified") + F.make_interval(days=F.col("_days")) < now
    matched = files.join(active, "topic").filter(
        (F.col("_generation").isNull() | F.col("_generation").eqNullSafe(F.col("generation"))) & aged
    )
    return matched.select(*files.columns).distinct()


def expire_records(df: DataFrame, hours: int, now_ms) -> DataFrame:
    """Records left after whole segments are dropped whose last message is older than ``hours``.

    The newest segment of a topic-partition is still open and always stays, as does one without any timestamp, whose
    age nobody knows. ``df`` has a ``segment_id``.
    """
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    segments = df.groupBy(*KEYS, "segment_id").agg(
        F.max("timestamp").alias("_last"), F.min("offset").alias("_first")
    )
    # both sides of the join read the same columns, so Spark builds the segments once and reuses them
    newest = segments.groupBy(*KEYS).agg(
        F.max("_first").alias("_newest"), F.max_by("_last", "_first").alias("_newest_last")
    )
    open_segment = (F.col("_first") == F.col("_newest")) & F.col("_last").eqNullSafe(F.col("_newest_last"))
    young = F.col("_last").isNull() | (F.col("_last") >= now - hours * 3_600_000)
    # one row per topic-partition, of which a cluster has some hundred thousand at most
    kept = segments.join(F.broadcast(newest), KEYS).filter(young | open_segment)
    return join_null_safe(df, kept.select(*KEYS, "segment_id"), [*KEYS, "segment_id"], "left_semi")
