"""Steps whose work has to grow with their input, not faster."""

import hashlib
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidelog.llm import search as S
from tidelog.operators import commits as C
from tidelog.operators import generator as G
from tidelog.operators.ordering import BLOCK
from tidelog.plans import catalog
from tidelog.plans import derived as D
from tidelog.sources import files as W
from tidelog.sources.backup import scan_backup
from tidelog.schema import LOG_SCHEMA
from tidelog.session import scratch
from tidelog.sources.sinks import assign_offsets, write_backup
from tidelog.streaming import dedupe
from tidelog.streaming import jobs as T

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_the_search_of_runs_has_no_shrinking_frame(spark):
    """A frame that ends with its partition is gone through again for every row of it."""
    runs = spark.range(50).select(
        F.lit("t").alias("old_topic"), F.lit("n").alias("new_topic"), F.lit(0).alias("partition"),
        (F.col("id") * 3).alias("old_start"), F.col("id").alias("new_start"), F.lit(1).cast("bigint").alias("length"),
    )
    committed = spark.range(200).select(F.lit("t").alias("old_topic"), F.lit(0).alias("partition"), F.col("id").alias("committed"))
    got = C.translate_by_runs(committed, runs, 16)
    assert "unboundedfollowing" not in plan_of(got)
    assert {r.committed: r.new_offset for r in got.collect()} == {c: min(-(-c // 3), 50) for c in range(200)}


def jobs_of(spark, run) -> int:
    """Spark jobs that ``run`` starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_generations_are_written_in_one_pass(spark, monkeypatch):
    """Not with a scan of the log for each of the 40 folders."""
    monkeypatch.setattr(D, "_written", {})
    assert jobs_of(spark, lambda: catalog.QUERIES["import_avro_generation"](spark, SF).count()) < 10


def test_digests_have_tasks_of_their_own(spark):
    """Keys do not share a task while there are others, and what a task reads is compressed."""
    pieces = spark.range(4000).select(
        F.concat(F.lit("k"), (F.col("id") % 4).cast("string")).alias("key"), (F.col("id") % 4 + F.col("id") / 2000).cast("int").cast("string").alias("path"),
        F.expr("id div 4").cast("int").alias("pos"), F.encode(F.concat(F.col("id").cast("string"), F.lit("\n")), "utf-8").alias("value"),
    ).repartition(3)
    got = W.digests(pieces, "key", ["path", "pos"])
    assert len({r.task for r in got.select(F.spark_partition_id().alias("task")).collect()}) == 4
    texts = {k: [] for k in range(4)}
    for i in range(4000):
        texts[i % 4].append((str(int(i % 4 + i / 2000)), i // 4, f"{i}\n"))
    wanted = {f"k{k}": hashlib.md5("".join(t for *_, t in sorted(rows)).encode()).hexdigest() for k, rows in texts.items()}
    assert {r.key: r.digest for r in got.collect()} == wanted
    assert "_size" in plan_of(got)


def test_blocks_of_messages_are_bounded_in_bytes(spark):
    """A block of 2^20 messages of 1 KB is a gigabyte in one task."""
    assert G.message_block(1000) == 67_108 and G.message_block(1) == BLOCK and G.message_block(1 << 30) == 1
    files = spark.createDataFrame([("f", "a", b"x" * 5000)], "path string, part string, content binary")
    assert "div 67108" in plan_of(G.generate_log_of_parts(files, "t", 1000, 2))


def test_segments_are_listed_in_one_job(spark, tmp_path):
    """However many topic-partitions have more folders than the driver lists itself."""
    table = pa.table({"offset": pa.array([0, 1], pa.int64())})
    for partition in range(4):
        for first in range(40):
            folder = tmp_path / "topic=t" / f"partition={partition}" / f"batch_id={first}"
            folder.mkdir(parents=True)
            pq.write_table(table, folder / "a.parquet")
    assert jobs_of(spark, lambda: catalog._files_of(spark, str(tmp_path))) == 1
    assert catalog._files_of(spark, str(tmp_path)).count() == 160


def test_avro_blocks_are_large(spark, tmp_path):
    """64 KB of records, the default, are too few for a compressor of their own."""
    log = spark.range(40_000).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.col("id").alias("timestamp"),
        F.lit(b"k").alias("key"), F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("value"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
    )
    write_backup(log, str(tmp_path / "b"), codec="xz", fmt="avro")
    (file,) = (tmp_path / "b").rglob("*.avro")
    content = file.read_bytes()
    mark = content[-16:]  # ends every block and the header
    assert content.count(mark) - 1 <= 8
    assert scan_backup(spark, str(tmp_path / "b"), fmt="avro").agg(F.sum("offset")).first()[0] == 40_000 * 39_999 // 2


def test_offsets_go_on_without_jobs_of_their_own(spark, skewed_log):
    """A micro-batch is planned without a job that writes and counts the ends before it."""
    ends = skewed_log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
    assert jobs_of(spark, lambda: assign_offsets(skewed_log, ends)) == 0


def test_records_reach_the_state_in_packs(spark, make_log):
    """Not row by row; a pack has records of one block, and large ones are on their own. Every field comes back."""
    rows = [
        {
            "topic": f"t{i % 2}", "partition": i % 3, "offset": i // 6 * 300_000, "timestamp": None if i % 7 == 0 else i, "key": None if i % 5 == 0 else b"k%d" % i,
            "value": None if i % 4 == 0 else b"v" * (300_000 if i % 50 == 1 else i), "headers": None if i % 3 else [("h", b"%d" % i), ("h", None)],
        }
        for i in range(200)
    ]
    source, out = scratch(spark, "log"), scratch(spark, "once")
    for part in (rows[:120], rows[60:] + rows[150:]):
        make_log(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    assert "mapinarrow" in dedupe.first_seen(stream)._jdf.queryExecution().analyzed().toString().lower()
    query = T.stream_dedupe_sink(stream, out, scratch(spark, "c"), poll_seconds=None)
    query.awaitTermination()
    assert query.exception() is None

    def plain(df):
        return sorted((r.topic, r.partition, r.offset, r.timestamp, r.key, r.value, r.headers) for r in df.collect())

    assert plain(scan_backup(spark, out).select(*LOG_SCHEMA.fieldNames())) == plain(make_log(rows))
    records = spark.read.schema(LOG_SCHEMA).parquet(source).withColumn("block", F.expr("offset div 1048576")).toArrow().to_batches()
    packs = dedupe._packs(records)
    assert packs.num_rows < 90 < sum(b.num_rows for b in records) and max(len(p) for p in packs.column("records").to_pylist()) < 700_000
    assert sum(b.num_rows for b in dedupe._unpack([packs])) == 340 - 30


def test_results_of_a_search_grow_with_tasks_not_shards(spark):
    """A task hands over the best of all its shards; ties go by identifier, over shards and tasks."""
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.expr("concat('a w', id % 7, ' v', id % 3)").alias("text")).repartition(12, "doc_id")
    index = S.stored(S.build_index(docs), "index")
    assert index.count() == 12
    queries = docs.filter("doc_id % 50 = 0").select(F.col("doc_id").alias("query"), "text")
    asked = S.weighted_queries(queries.withColumn("version", F.lit(0)), S.document_frequencies(index), 600)
    tasks = index.coalesce(2)
    assert S.search_block(tasks, asked.toArrow(), 3.0, 5).count() <= 12 * 5 * 2
    got = {}
    for r in S.search(docs, queries, 5).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append(r.doc_id)
    # the texts that are alike are 21 apart
    assert got == {q: [q % 21 + 21 * k for k in range(5)] for q in range(0, 600, 50)}
