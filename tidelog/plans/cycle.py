"""The generation cycle of compacted topics, as a job that is run again and again.

Two instances take turns. The live one follows the log. When its generation is older than the cycle, the other one starts: its
folder is cleared, it writes the topic from its first offset, compacted, and the ends of the log become its targets. Once
it has reached them it is promoted, the events for both instances are announced, and the other's folder is dropped.

``advance`` takes each topic one step on, all topics of a step together. What it has done is one small file, made to appear as
a whole, so a run that dies is repeated from where the last one ended: every step clears or replaces what it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.compaction import caught_up, coordination_events, latest_per_key
from tidelog.operators.records import resume_after
from tidelog.schema import ACTIVATE, COORDINATION_SCHEMA, DEFAULT_CYCLE_HOURS, PASSIVATE
from tidelog.sources import snapshots
from tidelog.sources.backup import scan_backup
from tidelog.sources.sinks import drop_generation, write_backup

KEYS = ["topic", "partition"]
HOUR_MS = 3_600_000


def _store(spark: SparkSession, root: str) -> snapshots._Store:
    return snapshots._Store(spark, f"{root.rstrip('/')}/_cycle")


def states(spark: SparkSession, root: str) -> dict[str, dict]:
    """Per topic: ``live`` and ``next`` generation (instances, may be None), ``started_at``, ``cycles`` and ``targets``."""
    store = _store(spark, root)
    names = [n for n in store.names() if n.endswith(".state")]
    return store.read(names[-1]) if names else {}


def _save(spark: SparkSession, root: str, before: dict, after: dict) -> None:
    store = _store(spark, root)
    number = len([n for n in store.names() if n.endswith(".state")])
    if after != before and not store.put(f"{number:0{snapshots.DIGITS}d}.state", after):
        raise RuntimeError("another run of the cycle is under way")


def _ends(log: DataFrame) -> DataFrame:
    return log.groupBy(*KEYS).agg(F.max("offset").alias("offset"))


def _by_topic(ends: DataFrame) -> dict[str, dict[str, int]]:
    # one number per topic-partition
    found: dict = {}
    for r in ends.collect():
        found.setdefault(r.topic, {})[str(r.partition)] = r.offset
    return found


def _topics(log: DataFrame, names) -> DataFrame:
    return log.filter(F.col("topic").isin(list(names)))


def advance(
    spark: SparkSession, log: DataFrame, root: str, now_ms: int, instances: tuple[str, str], cycle_hours: int = DEFAULT_CYCLE_HOURS
) -> dict[str, str]:
    """Take every topic of ``log`` one step on; what was done, by topic: started, following or handed over.

    ``instances`` are names as ``backup-activate`` and ``backup-passivate``. The log must hold all records that are still valid.
    """
    before = states(spark, root)
    after = {t: dict(s) for t, s in before.items()}
    for (topic,) in log.select("topic").distinct().collect():
        after.setdefault(topic, {"live": None, "next": None, "started_at": None, "cycles": 0, "targets": None})
    done: dict[str, str] = {}
    due = {
        t: s for t, s in after.items()
        if s["next"] is None and (s["live"] is None or now_ms > s["started_at"] + cycle_hours * HOUR_MS)
    }
    running = {t: s for t, s in after.items() if t not in due and s["next"] is not None}
    # the live generations follow the log in any case
    for instance in instances:
        names = [t for t, s in before.items() if s["live"] == instance]
        if names:
            _follow(spark, _topics(log, names), root, instance, names)
            done |= dict.fromkeys(names, "following")
    for instance in instances:
        names = [t for t, s in due.items() if _other(s["live"], instances) == instance]
        if names:
            targets = _by_topic(_ends(_topics(log, names)))
            for topic in names:
                drop_generation(spark, root, topic, instance)
                after[topic] |= {"next": instance, "started_at": now_ms, "targets": targets.get(topic, {})}
            # what an earlier run of this step wrote is replaced as a whole
            label = f"cycle:{instance}:{now_ms}"
            write_backup(latest_per_key(_topics(log, names), drop_tombstones=False), root, generation=instance, label=label)
            done |= dict.fromkeys(names, "started")
    for instance in instances:
        names = [t for t, s in running.items() if s["next"] == instance]
        if names:
            _follow(spark, _topics(log, names), root, instance, names)
            ready = _reached(spark, root, instance, {t: running[t]["targets"] for t in names})
            for topic in ready:
                old = after[topic]["live"]
                after[topic] |= {"live": instance, "next": None, "cycles": after[topic]["cycles"] + 1, "targets": None}
                if old is not None:
                    drop_generation(spark, root, topic, old)
                done[topic] = "handed over"
            if ready:
                _announce(spark, root, _ends(_topics(log, ready)), instances, instance, now_ms)
    _save(spark, root, before, after)
    return done


def _other(live: str | None, instances: tuple[str, str]) -> str:
    return instances[1] if live == instances[0] else instances[0]


def _written(spark: SparkSession, root: str, instance: str, names) -> DataFrame:
    return scan_backup(spark, root, list(names), instance)


def _follow(spark: SparkSession, log: DataFrame, root: str, instance: str, names) -> None:
    """Add what the log holds beyond a generation."""
    ends = _ends(_written(spark, root, instance, names)).withColumnRenamed("offset", "last_offset")
    write_backup(resume_after(log, ends), root, generation=instance)


def _reached(spark: SparkSession, root: str, instance: str, targets: dict) -> list[str]:
    rows = [(t, int(p), o) for t, per in targets.items() for p, o in per.items()]
    wanted = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    return [r.topic for r in caught_up(_written(spark, root, instance, targets), wanted).filter("complete").collect()]


def _announce(spark, root, ends, instances, instance, now_ms) -> None:
    """Tell the new instance to be active and the other one to be passive."""
    peer = instances[1] if instance == instances[0] else instances[0]
    for name, event in ((peer, ACTIVATE), (instance, PASSIVATE)):
        # an event is addressed to the peer of the name that it is made with
        status = PASSIVATE if name.endswith(PASSIVATE.lower()) else ACTIVATE
        rows = coordination_events(ends, name, event, now_ms, status)
        rows.write.mode("append").parquet(f"{root.rstrip('/')}/_events")


def events(spark: SparkSession, root: str) -> DataFrame:
    """The announced events."""
    return spark.read.schema(COORDINATION_SCHEMA).parquet(f"{root.rstrip('/')}/_events")


def current_records(spark: SparkSession, root: str) -> DataFrame:
    """The compacted records of all topics, each of its live generation, with the ``generation``."""
    live: dict[str, list[str]] = {}
    for topic, state in states(spark, root).items():
        if state["live"] is not None:
            live.setdefault(state["live"], []).append(topic)
    parts = [latest_per_key(scan_backup(spark, root, names, i)).withColumn("generation", F.lit(i)) for i, names in sorted(live.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
