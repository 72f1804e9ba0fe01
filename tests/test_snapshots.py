"""The commit log of a backup: what dies is not seen, what is repeated replaces itself, everything else adds."""

import threading

import pytest
from pyspark.sql import functions as F

from tidelog.operators import commits as C
from tidelog.operators import compaction as K
from tidelog.plans import cycle, jobs
from tidelog.schema import LOG_COLUMNS, LOG_SCHEMA
from tidelog.session import scratch
from tidelog.sources import backup as B
from tidelog.sources import sinks, snapshots
from tidelog.sources import times as X


def rows(df):
    return sorted(map(str, df.select(*LOG_COLUMNS).collect()))


def test_bulk_writes_add(spark, skewed_log):
    root = scratch(spark, "root")
    for part in ("offset < 30000", "offset >= 30000"):
        sinks.write_backup(skewed_log.filter(part), root)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)
    assert B.list_files(spark, root).agg(F.count_distinct("topic")).first()[0] == 4


def test_runs_go_on(spark, skewed_log):
    root, topics = scratch(spark, "root"), "hot,t0,t1,t2"
    for part in ("offset < 30000", "true", "true", "offset < 10"):
        jobs.backup(skewed_log.filter(part), root, topics)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)


def test_a_write_that_fails_half_way(spark, skewed_log):
    root = scratch(spark, "root")
    sinks.write_backup(skewed_log.filter("offset < 30000"), root, label="first")
    bad = F.when(F.col("topic") == "t2", F.raise_error(F.lit("disk full")).cast("binary")).otherwise(F.col("value"))
    for label in (None, "first"):
        with pytest.raises(Exception, match="disk full"):
            sinks.write_backup(skewed_log.withColumn("value", bad), root, label=label)
        assert rows(B.scan_backup(spark, root)) == rows(skewed_log.filter("offset < 30000"))
    # files that a dead write left are not seen either
    folder = snapshots.reserve(spark, root)
    sinks.put_files(skewed_log, root, folder)
    assert B.scan_backup(spark, root).count() == skewed_log.filter("offset < 30000").count()
    sinks.write_backup(skewed_log.filter("offset >= 30000"), root)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)
    assert snapshots.clear_replaced(spark, root) > 0 and snapshots.clear_replaced(spark, root) == 0
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)


def test_a_repeat_with_less(spark, skewed_log):
    root = scratch(spark, "root")
    sinks.write_backup(skewed_log, root, batch_id=7)
    sinks.write_backup(skewed_log.filter("partition <> 0"), root, batch_id=7)
    sinks.write_backup(skewed_log.filter("topic = 'none'"), root, batch_id=8)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log.filter("partition <> 0"))
    jobs.new_generation(skewed_log, scratch(spark, "g"), "a")
    root = scratch(spark, "g")
    for part in ("true", "partition = 1"):
        jobs.new_generation(skewed_log.filter(part), root, "a")
    assert rows(B.scan_backup(spark, root, generation="a")) == rows(K.latest_per_key(skewed_log.filter("partition = 1")))


def test_commits_at_once(spark):
    """Numbers are taken by one writer each, and the sums say what the single files say."""
    root, errors = scratch(spark, "root"), []

    def write(label):
        try:
            for i in range(15):
                snapshots.commit(spark, root, snapshots.reserve(spark, root), f"{label}:{i % 10}")
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    found = snapshots.commits(spark, root)
    assert len(found) == 40 and len({c.version for c in found}) == 40 and snapshots.last_version(spark, root) == 60
    log = snapshots._log(spark, root)
    assert any(n.endswith(".sum") for n in log.names())
    single = snapshots._live(log, [n for n in log.names() if n.endswith(".commit")])
    assert single == found


def test_an_older_backup_is_adopted(spark, skewed_log):
    root = scratch(spark, "root")
    older = skewed_log.filter("offset < 30000").withColumn("batch_id", F.lit(-1).cast("bigint"))
    older.write.partitionBy("topic", "partition", "batch_id").parquet(root)
    assert snapshots.live_batches(spark, root) is None
    sinks.write_backup(skewed_log.filter("offset >= 30000"), root, batch_id=-1)
    assert B.scan_backup(spark, root).count() == skewed_log.filter("offset >= 30000").count()
    root = scratch(spark, "root")
    older.write.partitionBy("topic", "partition", "batch_id").parquet(root)
    sinks.write_backup(skewed_log.filter("offset >= 30000"), root)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)


def test_what_is_not_there_is_refused(spark, skewed_log):
    root = scratch(spark, "root")
    sinks.write_backup(skewed_log, root)
    for topics in ("nope", "hot,nope"):
        with pytest.raises(ValueError, match="no backup of topic nope"):
            B.scan_backup(spark, root, topics)
    jobs.new_generation(skewed_log, root2 := scratch(spark, "root"), "a")
    with pytest.raises(ValueError, match="no generation b"):
        B.scan_generation(spark, root2, "hot", "b")
    with pytest.raises(ValueError, match="folder of their own"):
        sinks.write_segments(skewed_log, root, 10)


def test_time_index(spark, make_log):
    """Clocks go back and forth between files; only those that may hold a range are opened."""
    log = make_log([{"offset": i, "timestamp": None if i % 50 == 9 else (i // 100) * 10_000 * (-1) ** (i // 100) + i} for i in range(2_000)])
    root = scratch(spark, "root")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_backup(log, root, block=100)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert X.index_times(spark, root, block=100) == 1 and X.index_times(spark, root, block=100) == 0
    for low, high in ((40_000, 61_000), (40_400, 40_499), (-10**9, 10**9), (7, 7)):
        got = X.scan_time_range_indexed(spark, root, "t", 0, low, high)
        assert rows(got) == rows(B.scan_time_range(spark, root, "t", 0, low, high))
    one = X.scan_time_range_indexed(spark, root, "t", 0, 40_400, 40_499)
    assert one.count() > 0 and len(one.inputFiles()) == 1 < len(B.scan_backup(spark, root).inputFiles())
    late = make_log([{"offset": 5_000, "timestamp": 50_000}])
    sinks.write_backup(late, root)
    assert X.scan_time_range_indexed(spark, root, "t", 0, 50_000, 50_000).count() == 1
    assert X.scan_time_range_indexed(spark, root, "t", 1, 0, 10**12).count() == 0


def test_compaction_by_runs(spark, skewed_log):
    names, parts = [f"run_{scratch(spark, 'x')[-12:]}_{i}" for i in range(3)], ("offset < 20000", "offset >= 20000 AND offset < 45000", "offset >= 45000")
    try:
        jobs.compact(skewed_log.filter(parts[0]), names[0], scratch(spark, "run"), 4)
        for i in (1, 2):
            jobs.compact_incremental(spark, names[i - 1], skewed_log.filter(parts[i]), names[i], scratch(spark, "run"), 4)
            done = " OR ".join(parts[: i + 1])
            assert rows(spark.table(names[i])) == rows(K.latest_per_key(skewed_log.filter(done)))
        merged = K.merged_run(spark.table(names[2]), skewed_log.filter(parts[2]), 4)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        # what stands above the scan of the base up to the join
        lines = plan.split("\n")
        scan = next(i for i, x in enumerate(lines) if names[2] in x)
        above = lines[next(i for i in range(scan, -1, -1) if "SortMergeJoin" in lines[i]) : scan]
        assert "Bucketed: true" in lines[scan] and not any("Exchange" in x for x in above) and len(above) < 8
        # no shuffle on the way to the next table
        assert not any("Exchange" in x for x in lines[: lines.index(above[0])])
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_generation_cycle(spark, skewed_log):
    root, pair = scratch(spark, "cycle"), ("b-activate", "b-passivate")
    hours = 3_600_000
    ages = [skewed_log.filter(f"offset < {n}") for n in (10_000, 20_000, 30_000, 40_000, 70_000)]
    seen = []
    for step, (log, now) in enumerate(zip(ages, (0, 1, 7, 8, 9), strict=True)):
        seen.append(set(cycle.advance(spark, log, root, now * hours, pair).values()))
        if step == 1:
            assert rows(cycle.current_records(spark, root)) == rows(K.latest_per_key(log))
    assert seen == [{"started"}, {"handed over"}, {"started"}, {"handed over"}, {"following"}]
    state = cycle.states(spark, root)
    assert {(s["live"], s["next"], s["cycles"]) for s in state.values()} == {("b-passivate", None, 2)}
    assert rows(cycle.current_records(spark, root)) == rows(K.latest_per_key(skewed_log))
    left = spark.read.schema(B._schema(True, True)).parquet(root).select("generation").distinct().collect()
    assert [r.generation for r in left] == ["b-passivate"]
    told = {(r.connectorInstanceName.rsplit("-", 1)[0], r.event) for r in cycle.events(spark, root).collect()}
    assert told == {("b-activate", "ACTIVATE"), ("b-passivate", "PASSIVATE"), ("b-passivate", "ACTIVATE"), ("b-activate", "PASSIVATE")}


def test_a_cycle_step_that_dies_is_repeated(spark, skewed_log, monkeypatch):
    root, pair = scratch(spark, "cycle"), ("b-activate", "b-passivate")
    with monkeypatch.context() as m:
        m.setattr(cycle, "_save", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            cycle.advance(spark, skewed_log, root, 0, pair)
    assert cycle.states(spark, root) == {}
    for now in (0, 1):
        cycle.advance(spark, skewed_log, root, now, pair)
    assert rows(cycle.current_records(spark, root)) == rows(K.latest_per_key(skewed_log))


def test_offset_runs(spark, make_log):
    """Runs end at gaps of either log; commits before, inside, between and behind them, and of several groups at once."""
    pairs = [(10, 0), (11, 1), (12, 2), (20, 3), (21, 4), (30, 9), (31, 10), (5_000, 11), (5_001, 12)]
    restored = make_log([{"topic": "new", "offset": n, "headers": [("x-old-offset", str(o).encode())]} for o, n in pairs])
    mapping = spark.createDataFrame([("t", "new")], "source_topic string, target_topic string")
    runs = C.offset_index_runs(restored, mapping, block=4)
    assert sorted((r.old_start, r.new_start, r.length) for r in runs.collect()) == [(10, 0, 3), (20, 3, 2), (30, 9, 2), (5_000, 11, 2)]
    asked = [0, 9, 10, 12, 13, 19, 20, 21, 22, 29, 31, 32, 4_999, 5_001, 5_002, 9_999]
    committed = spark.createDataFrame([("t", 0, c, g) for c in asked for g in ("a", "b")], "old_topic string, partition int, committed bigint, grp string")
    for block in (3, 16, 1 << 20):
        got = {(r.committed, r.grp): r.new_offset for r in C.translate_by_runs(committed, runs, block).collect()}
        assert got == {(c, g): min((n for o, n in pairs if o >= c), default=13) for c in asked for g in ("a", "b")}


def test_a_stream_of_commits(spark, skewed_log):
    from tidelog.streaming import jobs as T

    root, target, checkpoint = (scratch(spark, n) for n in ("root", "target", "c"))
    sinks.write_backup(skewed_log.filter("offset < 20000"), root, label="a")
    sinks.put_files(skewed_log, root, snapshots.reserve(spark, root))
    for part in ("offset < 40000 AND partition = 0", "offset < 40000", "true"):
        # a label written again with more: what is new of it is restored
        sinks.write_backup(skewed_log.filter("offset >= 20000").filter(part), root, label="b")
        query = T.stream_restore_commits(spark, root, target, checkpoint, now_ms=1, poll_seconds=None)
        query.awaitTermination()
        assert query.exception() is None
    got = B.scan_backup(spark, target)
    assert got.count() == got.select("topic", "partition", "offset").distinct().count() == 20_000
    assert got.schema.fieldNames() == LOG_SCHEMA.fieldNames()
