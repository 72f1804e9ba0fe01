import os
import time

import pytest
from pyspark.sql import functions as F

from tidelog.operators import compaction as K
from tidelog.operators import generator as G
from tidelog.operators.records import dedupe_log
from tidelog.schema import LOG_COLUMNS, LOG_SCHEMA
from tidelog.session import scratch
from tidelog.sources import backup as B
from tidelog.sources import files as W
from tidelog.sources.log import stream_log
from tidelog.sources.sinks import write_segments
from tidelog.streaming import jobs as T
from tidelog.streaming.segments import stream_segments


def rows(df):
    return sorted(map(str, df.select(*LOG_COLUMNS).collect()))


def wait(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@pytest.fixture
def source(spark, skewed_log):
    path = scratch(spark, "source")
    skewed_log.repartitionByRange(6, "offset").write.parquet(path)
    return path


TOPICS = "hot,t0,t1,t2"


def test_kill_and_restart(spark, skewed_log, source, monkeypatch):
    """The job dies after it wrote its second batch but before the checkpoint knows."""
    root, checkpoint = scratch(spark, "root"), scratch(spark, "checkpoint")
    real = T.write_backup

    def dying(batch, root, batch_id=None, **options):
        real(batch, root, batch_id=batch_id, **options)
        if batch_id == 1:
            raise RuntimeError("killed")

    def run():
        wait(T.stream_backup_sink(stream_log(spark, source, TOPICS, max_per_trigger=1), root, checkpoint, poll_seconds=None))

    monkeypatch.setattr(T, "write_backup", dying)
    with pytest.raises(Exception, match="killed"):
        run()
    assert 0 < B.scan_backup(spark, root).count() < 20_000
    monkeypatch.setattr(T, "write_backup", real)
    run()
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)
    run()
    assert B.scan_backup(spark, root).count() == 20_000


def test_new_data_reaches_the_backup_and_the_restore(spark, skewed_log):
    source, root, target = (scratch(spark, n) for n in ("log", "root", "target"))
    points = [scratch(spark, "checkpoint") for _ in range(2)]
    for part in ("offset < 30000", "offset >= 30000"):
        skewed_log.filter(part).write.mode("append").parquet(source)
        wait(T.stream_backup_sink(stream_log(spark, source, TOPICS), root, points[0], poll_seconds=None))
        restored = B.stream_backup(spark, root, max_files=7, batches=True)
        wait(T.stream_restore(restored, target, points[1], "hot:cold", now_ms=1, poll_seconds=None))
    got = B.scan_backup(spark, target)
    assert got.count() == got.select("topic", "partition", "offset").distinct().count() == 20_000
    assert got.filter("topic = 'cold'").count() == 10_000
    assert got.filter(F.size("headers") == 2).count() == 20_000


def test_marks_continue_over_batches(spark, skewed_log):
    source, marks, checkpoint = (scratch(spark, n) for n in ("log", "marks", "checkpoint"))
    for low in range(0, 60_000, 15_000):
        skewed_log.filter(f"offset >= {low} AND offset < {low + 15_000}").write.mode("append").parquet(source)
        wait(T.stream_progress_marks(spark.readStream.schema(LOG_SCHEMA).parquet(source), marks, checkpoint, 100, poll_seconds=None))
    got = spark.read.parquet(marks + "/announced").select("topic", "partition", "offset")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, K.progress_marks(skewed_log, 100).collect()))


def test_stream_dedupe(spark, skewed_log):
    """Eight triggers, each with records of all ages, most of them twice: nothing is lost, nothing comes twice."""
    source, out = scratch(spark, "twice"), scratch(spark, "once")
    both = skewed_log.withColumn("r", F.lit(0)).unionByName(skewed_log.withColumn("r", F.lit(1)))
    both.repartition(8, F.xxhash64("offset", "r")).drop("r").write.parquet(source)
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    wait(T.stream_dedupe_sink(stream, out, scratch(spark, "c"), poll_seconds=None))
    assert rows(B.scan_backup(spark, out)) == rows(skewed_log)
    with pytest.raises(ValueError, match="stream_dedupe_sink"):
        dedupe_log(stream)


# ---- generator


def loop(partitions, weights, n):
    weights = (list(weights) + [1] * partitions)[:partitions]
    out, current, used = [], 0, 0
    for _ in range(n):
        out.append(current)
        used += 1
        if used == weights[current]:
            current, used = (current + 1) % partitions, 0
    return out


@pytest.mark.parametrize("partitions,weights", [(4, None), (4, (4, 1, 1, 1)), (4, (4,)), (3, (200, 1, 130)), (2, (1, 2, 9))])
def test_weighted_round_robin(spark, partitions, weights):
    got = [r[0] for r in spark.range(700).orderBy("id").select(G.partition_of(F.col("id"), partitions, weights)).collect()]
    assert got == loop(partitions, weights or [], 700)
    with pytest.raises(ValueError):
        G.partition_of(F.col("id"), 2, (0,))


def files(spark, *contents):
    return spark.createDataFrame([(f"f{i}", c) for i, c in enumerate(contents)], "path string, content binary")


def test_chunks(spark):
    got = G.chunk_files(files(spark, b"abcdefg", b"xy", b"", b"123456"), 3).collect()
    assert sorted((r.path, r.pos, bytes(r.value)) for r in got) == [
        ("f0", 0, b"abc"), ("f0", 1, b"def"), ("f0", 2, b"g"), ("f1", 0, b"xy"), ("f3", 0, b"123"), ("f3", 1, b"456")
    ]


@pytest.mark.parametrize("messages", [1, 2, 7, 3 * G.PAGE + 5])
def test_repeat(spark, messages):
    got = G.chunk_files(files(spark, b"abcdefghi", b""), 3, messages)
    messages = -(-messages // 3) * 3
    parts = (b"abc", b"def", b"ghi")
    wanted = F.when(F.col("pos") % 3 == 0, F.lit(parts[0])).when(F.col("pos") % 3 == 1, F.lit(parts[1])).otherwise(F.lit(parts[2]))
    assert got.select("pos").distinct().count() == got.count() == messages
    assert got.filter(F.col("value") != wanted).count() == 0 and got.agg(F.max("pos")).first()[0] == messages - 1


def test_generated_log(spark):
    log = G.generate_log(files(spark, b"a" * 13, b"b" * 13, b"c" * 13), "gen", 3, 4, (4,), messages=5)
    got = {r.offset: r for r in log.collect()}
    seen = {}
    for index, partition in enumerate(loop(4, (4,), 15)):
        seen[partition] = seen.get(partition, 0) + 1
        r = got[index]
        assert (r.partition, bytes(r.key), r.headers[-1].key) == (partition, b"f%d" % (index // 5), "message.number")
        assert bytes(r.headers[-1].value) == str(seen[partition]).encode()
    assert len(got) == 15 and [f.name for f in log.schema] == LOG_COLUMNS


def test_watched_folder(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", scratch(spark, "out"), scratch(spark, "checkpoint")
    folder.mkdir()
    for name in ("one", "two"):
        (folder / name).write_bytes(name.encode() * 4)
        messages = G.chunk_files(W.watch_files(spark, str(folder)), 3, messages=6)
        wait(messages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    got = spark.read.parquet(out).groupBy(F.element_at(F.split("path", "/"), -1).alias("f")).count().collect()
    assert {r.f: r["count"] for r in got} == {"one": 8, "two": 8}
    assert G.chunk_files(W.read_files(spark, str(folder)), 4).count() == 6


def test_watched_folder_becomes_a_log(spark, tmp_path):
    """Two batches of files: offsets continue, and the messages of a key are its file."""
    folder, target, checkpoint = tmp_path / "in", scratch(spark, "log"), scratch(spark, "checkpoint")
    folder.mkdir()
    for name in ("one", "two"):
        (folder / name).write_bytes(bytes(range(100)) + name.encode())
        wait(T.stream_files(W.watch_files(spark, str(folder)), target, checkpoint, "files", 7, 1, poll_seconds=None))
    got = B.scan_backup(spark, target).orderBy("offset").collect()
    assert [r.offset for r in got] == [*range(2 * 15)]
    for name in ("one", "two"):
        assert b"".join(bytes(r.value) for r in got if bytes(r.key) == name.encode()) == bytes(range(100)) + name.encode()


def test_merged_topics_get_new_offsets(spark, skewed_log):
    root, target = scratch(spark, "backup"), scratch(spark, "merged")
    for i in range(3):
        T.write_backup(skewed_log.filter(f"offset % 3 = {i}"), root, batch_id=i)
    wait(T.stream_restore(B.stream_backup(spark, root, max_files=5), target, scratch(spark, "c"), "t0:one,t1:one,t2:one", poll_seconds=None))
    got = B.scan_backup(spark, target).groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.max("offset").alias("top")
    ).collect()
    assert sum(r.n for r in got) == 20_000 and all(r.n == r.d == r.top + 1 for r in got)


# ---- committed snapshots


def test_new_checkpoints_add(spark, skewed_log):
    """Two queries with checkpoints of their own, one after the other, into one backup, and so for a restore."""
    root, target = scratch(spark, "root"), scratch(spark, "target")
    for part in ("offset < 30000", "offset >= 30000"):
        source = scratch(spark, "log")
        skewed_log.filter(part).repartition(3).write.parquet(source)
        for sink, folder in ((T.stream_backup_sink, root), (T.stream_restore, target)):
            stream = stream_log(spark, source, TOPICS, max_per_trigger=1)
            wait(sink(stream, folder, scratch(spark, "checkpoint"), poll_seconds=None))
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)
    ends = B.scan_backup(spark, target).groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.count_distinct("offset").alias("d"), F.max("offset").alias("top")
    ).collect()
    assert sum(r.n for r in ends) == 20_000 and all(r.n == r.d == r.top + 1 for r in ends)


def test_dedupe_goes_on_with_a_new_checkpoint(spark, skewed_log):
    out = scratch(spark, "once")
    for part in ("offset < 40000", "offset >= 20000"):
        source = scratch(spark, "log")
        skewed_log.filter(part).repartition(2).write.parquet(source)
        stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        wait(T.stream_dedupe_sink(stream, out, scratch(spark, "c"), poll_seconds=None))
    assert rows(B.scan_backup(spark, out)) == rows(skewed_log)


def test_dedupe_reads_no_history(spark, make_log):
    """The state that a micro-batch touches is that of its own blocks, however many there were before."""
    source = scratch(spark, "log")
    for i in range(6):
        make_log([{"offset": i * (1 << 20) + j} for j in range(50)] * 2).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = scratch(spark, "once")
    query = T.stream_dedupe_sink(stream, out, scratch(spark, "c"), poll_seconds=None)
    wait(query)
    seen = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert [s.numRowsTotal for s in seen] == [1, 2, 3, 4, 5, 6] and {s.numRowsUpdated for s in seen} == {1}
    assert all(p.numInputRows == 100 for p in query.recentProgress if p.numInputRows)
    assert B.scan_backup(spark, out).count() == 300


# ---- rotation in the stream


def segments_of(spark, root):
    found = spark.read.schema(B._schema(False, True)).parquet(root)
    per = found.groupBy("topic", "partition", "batch_id").agg(F.count("*").alias("n"), F.max("offset").alias("last"), F.count_distinct("_metadata.file_path").alias("files"))
    return sorted(map(tuple, per.collect()))


@pytest.mark.parametrize("schedule", [None, 50_000])
def test_stream_segments(spark, skewed_log, schedule):
    """A log in triggers that end anywhere gives the files that a bulk write of the closed segments gives."""
    source, root, bulk = (scratch(spark, n) for n in ("log", "streamed", "bulk"))
    for i in range(4):
        # the log as it grew: a topic-partition's older records are in older files
        age = f"offset >= {i * 16_000} AND offset < {(i + 1) * 16_000}"
        skewed_log.filter(age).repartition(2, "topic", "partition").write.mode("append").parquet(source)
    checkpoint = scratch(spark, "checkpoint")
    for _ in range(2):
        stream = stream_log(spark, source, TOPICS, max_per_trigger=1)
        wait(stream_segments(stream, root, checkpoint, 300, schedule, poll_seconds=None))
    write_segments(skewed_log, bulk, 300, schedule, open_tail=False)
    got, wanted = segments_of(spark, root), segments_of(spark, bulk)
    assert got == wanted and all(files == 1 for *_, files in got)
    held = spark.read.schema(B._schema(False, True)).parquet(root)
    assert rows(held) == rows(spark.read.schema(B._schema(False, True)).parquet(bulk))


def test_idle_segments_close_without_input(spark, make_log):
    source, root = scratch(spark, "log"), scratch(spark, "streamed")
    make_log([{"offset": i} for i in range(5)]).coalesce(1).write.parquet(source)
    stream = stream_log(spark, source, "t")
    query = stream_segments(stream, root, scratch(spark, "c"), 100, idle_ms=1_500, poll_seconds=0.5)
    try:
        for _ in range(120):
            time.sleep(0.5)
            if os.path.exists(f"{root}/topic=t"):
                break
        wait_rows = segments_of(spark, root)
    finally:
        query.stop()
    assert wait_rows == [("t", 0, 0, 5, 4, 1)]
