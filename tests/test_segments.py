from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import greedy as GR
from tidelog.operators import segments as S
from tidelog.operators.compaction import progress_marks
from tidelog.operators.ordering import number_records, prefix_sum, running_max

BLOCK = 512


def by_partition(df, *columns):
    out = defaultdict(list)
    for r in df.select("topic", "partition", "offset", *columns).collect():
        out[r[0], r[1]].append(tuple(r[2:]))
    return {k: sorted(v) for k, v in out.items()}


def test_numbering_over_blocks(skewed_log):
    rows = by_partition(number_records(skewed_log, block=BLOCK), "rn")
    for records in rows.values():
        assert [rn for _, rn in records] == list(range(1, len(records) + 1))
    assert len(rows["hot", 0]) == 10_000


def test_running_max_over_blocks(skewed_log):
    rows = by_partition(running_max(skewed_log, F.col("timestamp"), block=BLOCK), "timestamp", "running")
    for records in rows.values():
        assert [r[2] for r in records] == list(np.maximum.accumulate([r[1] for r in records]))


def test_a_hot_partition_is_spread_over_tasks(spark, skewed_log):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbered = number_records(skewed_log, block=64).withColumn("task", F.spark_partition_id())
    tasks = [r["count"] for r in numbered.filter("topic = 'hot'").groupBy("task").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(tasks) < 4000


def test_prefix_sum(spark):
    df = spark.range(1000).select(F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("path"), (F.col("id") % 7).alias("n"))
    got = {r.path: r.base for r in prefix_sum(df.repartition(5), "path", "n").collect()}
    total = 0
    for i in range(1000):
        assert got[f"f{i:05d}"] == total
        total += i % 7


def greedy_segments(records, flush, schedule):
    """The rotation rules as a loop over (offset, clock)."""
    ids, count, end, segment = {}, 0, None, 0
    now = None
    for offset, clock in records:
        now = clock if now is None else max(now, clock)
        if count and schedule and now >= end:
            segment, count = segment + 1, 0
        if not count and schedule:
            day = now // 86_400_000 * 86_400_000
            end = min(day + ((now - day) // schedule + 1) * schedule, day + 86_400_000)
        ids[offset] = segment
        count += 1
        if count >= flush:
            segment, count = segment + 1, 0
    return ids


@pytest.mark.parametrize("flush,schedule", [(7, None), (10_000, 3_000), (25, 3_000), (3, 100_000_000)])
def test_segment_matches_loop(skewed_log, flush, schedule):
    cut = S.segment(skewed_log, flush, schedule, block=BLOCK)
    for records in by_partition(cut, "timestamp", "segment_id").values():
        wanted = greedy_segments([(o, t) for o, t, _ in records], flush, schedule)
        groups, loop = defaultdict(set), defaultdict(set)
        for offset, _, segment in records:
            groups[segment].add(offset)
            loop[wanted[offset]].add(offset)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, loop.values()))


def interval_starts(records, interval):
    now = start = None
    out = {}
    for offset, clock in records:
        now = clock if now is None else max(now, clock)
        if start is None or now - start >= interval:
            start = now
        out[offset] = start
    return out


@pytest.mark.parametrize("interval", [1, 700, 60_000])
def test_interval_matches_loop(skewed_log, interval):
    cut = S.segment_by_interval(skewed_log, interval, block=BLOCK, span=max(2048, 16 * min(interval, 200)))
    for records in by_partition(cut, "timestamp", "segment_id").values():
        assert {o: s for o, _, s in records} == interval_starts([(o, t) for o, t, _ in records], interval)


@pytest.mark.parametrize("every", [0, 10, 1000])
def test_progress_marks_match_loop(skewed_log, every):
    got = by_partition(progress_marks(skewed_log, every, span=1024))
    for key, records in by_partition(skewed_log).items():
        last, marks = None, []
        for (offset,) in records:
            if last is None or offset - last > every:
                last = offset
                marks.append((offset,))
        assert got[key] == marks


def test_progress_marks_continue(spark, make_log):
    log = make_log([{"offset": o} for o in (10, 15, 21, 40)])
    told = spark.createDataFrame([("t", 0, 9)], "topic string, partition int, offset bigint")
    assert by_partition(progress_marks(log, 10, told)) == {("t", 0): [(21,), (40,)]}


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True),
    st.integers(1, 80),
    st.integers(1, 59),
    st.integers(-100, 100),
)
def test_step_functions_compose(xs, width, cut, start):
    x = np.array(sorted(xs), dtype=np.int64)
    cut = min(cut, len(x))
    parts = [p for p in (x[:cut], x[cut:]) if len(p)]
    steps = GR.step_function(parts[0], width)
    for p in parts[1:]:
        steps = GR.compose(steps, GR.step_function(p, width), width)
    last = start
    for v in x.tolist():
        last = v if v >= last + width else last
    found = GR.mark(x, start, width)
    assert int(GR.follow(steps, start, width)) == last == (x[found[-1]] if len(found) else start)


def test_schedule_bucket_follows_local_days(spark):
    # New York left summer time on 2024-11-03: the day has 25 hours, buckets restart at midnight
    rows = spark.createDataFrame([(1730606400000 + h * 3_600_000,) for h in range(50)], "timestamp bigint")
    got = rows.select("timestamp", S.schedule_bucket("timestamp", 7 * 3_600_000, "America/New_York").alias("b")).orderBy("timestamp").collect()
    starts = sorted({r.b for r in got})
    midnights = [1730606400000, 1730606400000 + 25 * 3_600_000, 1730606400000 + 49 * 3_600_000]
    assert set(midnights) <= set(starts)
    assert [(b - midnights[0]) // 3_600_000 for b in starts][:5] == [0, 7, 14, 21, 25]


def test_two_topics_three_records(make_log):
    rows = [
        {"topic": t, "offset": o, "key": k} for t in ("a", "b") for o, k in enumerate((b"key", b"key1", b"key2"))
    ]
    manifest = S.segment_manifest(S.segment_by_count(make_log(rows), 3))
    got = {r.topic: (r.records, r.first_offset, r.last_offset, r.name) for r in manifest.collect()}
    assert got["a"] == (3, 0, 2, "a/0/a-0-000000000000000.avro") and len(got) == 2
    assert {r.topic: r.commit_offset for r in S.commit_offsets(manifest, 3).collect()} == {"a": 3, "b": 3}


def test_open_tail_and_gaps(make_log):
    manifest = S.segment_manifest(S.segment_by_count(make_log([{"offset": o} for o in range(10)]), 4))
    assert manifest.count() == 3
    assert S.commit_offsets(manifest, 4).first().commit_offset == 8
    gaps = S.segment_by_count(make_log([{"offset": o} for o in (0, 5, 6, 20)]), 2)
    assert by_partition(gaps, "segment_id") == {("t", 0): [(0, 0), (5, 0), (6, 1), (20, 1)]}
    first = S.segment_manifest(S.segment_by_count(make_log([{"offset": 3}]), 4))
    assert S.commit_offsets(first, 4).first().commit_offset is None


def test_pause_closes_a_segment(make_log):
    log = make_log([{"offset": 0, "timestamp": 0}, {"offset": 1, "timestamp": 10}, {"offset": 2, "timestamp": 2010}])
    assert S.segment(log, 7000, 500).select("segment_id").distinct().count() == 2


def test_records_without_a_clock_stay(spark, make_log):
    """Unknown timestamps, at first or all along, lose no record."""
    log = make_log([{"offset": i, "timestamp": None if i < 6 or i % 4 == 0 else 1000 * i} for i in range(30)])
    cut = {r.offset: r.segment_id for r in S.segment(log, 4, 10_000).collect()}
    assert [cut[i] for i in range(6)] == ["none-0"] * 4 + ["none-1"] * 2 and len(cut) == 30
    silent = make_log([{"offset": i, "timestamp": None} for i in range(10)])
    assert S.segment(silent, 4, 10_000).count() == S.segment_by_interval(silent, 5).count() == 10


@pytest.mark.parametrize("many", [1, 2, 7])
def test_runs_of_blocks(skewed_log, monkeypatch, many):
    """Runs of few small blocks give the same starts as one block."""
    from tidelog.operators import greedy

    monkeypatch.setattr(greedy, "BLOCKS_PER_RUN", many)
    cut = lambda **k: sorted(map(tuple, greedy.greedy_starts(skewed_log, "offset", 37, **k).collect()))
    assert cut(span=600) == cut()


def test_no_task_follows_a_hot_key(spark, monkeypatch):
    """Of a key with all positions, what is followed in order is a small share."""
    from tidelog.operators import greedy

    log = spark.range(200_000).selectExpr("'hot' AS topic", "0 AS partition", "id * 3 AS offset")
    read = spark.sparkContext.accumulator(0)
    enter = greedy._enter

    def counted(names, types, width):
        inner = enter(names, types, width)

        def run(batches):
            def seen():
                for batch in batches:
                    if len(names) == 3:
                        read.add(batch.num_rows)
                    yield batch

            yield from inner(seen())

        return run

    monkeypatch.setattr(greedy, "_enter", counted)
    monkeypatch.setattr(greedy, "BLOCKS_PER_RUN", 16)
    starts = greedy.greedy_starts(log, "offset", 50, span=800).count()
    assert starts == -(-200_000 // 17) and 0 < read.value <= 200_000 // 100
