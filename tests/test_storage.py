import glob
import json
import os
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidelog.functions.envelopes import ENVELOPE, MARKER, encode_record
from tidelog.operators import compaction as K
from tidelog.operators import inventory as I
from tidelog.operators import retention as X
from tidelog.operators import segments as S
from tidelog.plans import jobs
from tidelog.schema import LOG_COLUMNS
from tidelog.session import scratch, small_side
from tidelog.sources import backup as B
from tidelog.sources import legacy as L
from tidelog.sources import sinks
from tidelog.sources.log import read_log


def rows(df):
    return sorted(map(str, df.select(*LOG_COLUMNS).collect()))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, skewed_log):
    root = scratch(spark, "backup")
    # as with much data: tasks are not joined into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.write_backup(skewed_log, root, block=4096)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return root


def test_backup_restore_identity(spark, skewed_log, stored):
    assert rows(B.scan_backup(spark, stored)) == rows(skewed_log)


def test_files_are_sorted_and_a_hot_partition_is_split(stored):
    hot = glob.glob(f"{stored}/topic=hot/partition=0/*/*.parquet")
    assert len(hot) > 1
    for path in glob.glob(f"{stored}/*/*/*/*.parquet"):
        offsets = pq.ParquetFile(path).read()["offset"].to_pylist()
        assert offsets == sorted(offsets)


def test_batch_files_are_sorted(spark, skewed_log):
    root = scratch(spark, "batches")
    sinks.write_backup(skewed_log, root, generation="g 1/x", batch_id=3)
    paths = glob.glob(f"{root}/*/*/*/*/*.parquet")
    assert paths and all("batch_id=3" in p for p in paths)
    for path in paths:
        offsets = pq.ParquetFile(path).read()["offset"].to_pylist()
        assert offsets == sorted(offsets)
    assert B.scan_backup(spark, root, generation="g 1/x").count() == 20_000


def test_scans_prune(spark, stored):
    df = B.scan_offset_range(spark, stored, "hot", 0, 300, 900)
    assert df.agg(F.min("offset"), F.max("offset"), F.count("*")).first()[:] == (300, 900, 101)
    plan = executed(df.select("value"))
    assert df.inputFiles() and all("/topic=hot/partition=0/" in f for f in df.inputFiles())
    assert "GreaterThanOrEqual(offset,300)" in plan
    assert "headers" not in plan.split("ReadSchema")[1]
    assert B.lookup_record(spark, stored, "hot", 0, 300).count() == 1
    assert B.lookup_record(spark, stored, "hot", 0, 301).count() == 0
    # ids 2 … of the hot topic: both ends belong to the range
    assert B.scan_time_range(spark, stored, "hot", 0, 0, 10**12).count() == 10_000
    assert B.scan_partition(spark, stored, "t", 0).count() == 0


def test_topics_that_look_like_other_types(spark, make_log):
    root = scratch(spark, "names")
    log = make_log([{"topic": t, "offset": 1} for t in ("007", "a=b", "ü/x", "2024-01-01", "a", "a+b", "a%b")])
    sinks.write_backup(log, root)
    assert rows(B.scan_backup(spark, root)) == rows(log)
    assert B.scan_backup(spark, root, "a").count() == 1
    listed = {r.topic for r in B.list_files(spark, root).collect()}
    assert listed == {"007", "a=b", "ü/x", "2024-01-01", "a", "a+b", "a%b"}
    assert sinks.delete_files(B.list_files(spark, root)) == 7 and not glob.glob(f"{root}/**/*.parquet", recursive=True)


def test_generations_are_not_mixed(spark, make_log):
    root = scratch(spark, "mixed")
    for name in ("one", "two"):
        sinks.write_backup(make_log([{}]), root, generation=name)
    with pytest.raises(ValueError, match="generations"):
        B.scan_backup(spark, root)


def test_empty_and_null_stay_apart(spark, make_log):
    root = scratch(spark, "nulls")
    log = make_log([{"offset": 0, "key": None, "value": b""}, {"offset": 1, "key": b"", "value": None, "headers": [("a", b""), ("a", b"1")]}])
    sinks.write_backup(log, root, codec="snappy")
    assert rows(B.scan_backup(spark, root)) == rows(log)


@pytest.mark.parametrize("codec", ["uncompressed", "snappy", "deflate", "bzip2", "xz"])
def test_avro_backup(spark, make_log, codec):
    root = scratch(spark, "avro")
    log = make_log([{"offset": o, "headers": [("a", b"1"), ("a", None)], "value": None if o % 2 else b""} for o in range(20)])
    sinks.write_backup(log, root, codec=codec, fmt="avro")
    assert rows(B.scan_backup(spark, root, "t", fmt="avro")) == rows(log)


def test_replayed_batch_replaces_only_itself(spark, skewed_log):
    root = scratch(spark, "replay")
    first, second = skewed_log.filter("offset < 30000"), skewed_log.filter("offset >= 30000")
    for batch_id, part in ((0, first), (1, second), (1, second), (0, first)):
        sinks.write_backup(part, root, batch_id=batch_id)
    assert rows(B.scan_backup(spark, root)) == rows(skewed_log)


def test_read_log_bounds(spark, skewed_log):
    path = scratch(spark, "log")
    skewed_log.write.parquet(path)
    got = read_log(spark, path, "hot", start={"hot": {"0": 600}}, end={"hot": {"0": 606}})
    assert sorted(r.offset for r in got.collect()) == [600]
    for start, end in ((-1, None), (-2, 606), (600, -1)):
        got = read_log(spark, path, "hot", start={"hot": {"0": start}}, end="latest" if end is None else {"hot": {"0": end}})
        wanted = skewed_log.filter("topic = 'hot'")
        if start >= 0:
            wanted = wanted.filter(F.col("offset") >= start)
        if end and end >= 0:
            wanted = wanted.filter(F.col("offset") < end)
        assert got.count() == (0 if start == -1 else wanted.count())
    with pytest.raises(ValueError, match="earliest"):
        read_log(spark, path, "hot", end={"hot": {"0": -2}})
    assert read_log(spark, path, ["hot", "t1"]).select("topic").distinct().count() == 2
    with pytest.raises(Exception, match="kafka"):
        read_log(spark, {"kafka.bootstrap.servers": "x"}, "t").count()


def test_write_log(spark, skewed_log):
    target = scratch(spark, "target")
    sinks.write_log(jobs.restore(skewed_log, "hot:cold", 5), target)
    got = read_log(spark, target, "cold")
    assert got.agg(F.min("offset"), F.max("offset"), F.count("*")).first()[:] == (0, 9999, 10_000)


def test_waves_cover_the_log_in_order(skewed_log):
    waves = sinks.offset_waves(skewed_log, 1000, block=256)
    assert len(waves) > 5 and all(a[1] < b[0] for a, b in zip(waves, waves[1:]))
    total = 0
    for lo, hi in waves:
        part = skewed_log.filter(F.col("offset").between(lo, hi))
        biggest = part.groupBy("topic", "partition").count().agg(F.max("count"), F.sum("count")).first()
        assert biggest[0] <= 1000 + 256
        total += biggest[1]
    assert total == 20_000
    sparse = skewed_log.select("topic", "partition", (F.col("offset") * 10**9).alias("offset"))
    assert len(sinks.offset_waves(sparse, 5000)) <= 21


def test_inventory_and_layout(spark, stored, make_log):
    listed = B.list_files(spark, stored)
    top = I.backup_inventory(listed, "t0:x").collect()
    assert (top[0].partitions, {r.source_topic: r.target_topic for r in top}["t0"]) == (5, "x")
    assert all(r.ok for r in I.check_layout(listed, path="relative").collect())
    paths = spark.createDataFrame([("t/0/t-0-000000000000000.avro",), ("t/g/0/t-0-000000000000000.avro",)], "path string")
    with pytest.raises(ValueError, match="generations"):
        I.require_layout(paths)
    I.require_layout(paths, "g")
    I.require_layout(paths.limit(1))


# ---- legacy layouts


def java_bytes(data):
    return bytes.fromhex("ACED0005757200025B42ACF317F8060854E00200007870") + struct.pack(">i", len(data)) + data


def avro_container(spark, path, records, codec="null", sync=None):
    avro, schema = spark._jvm.org.apache.avro, spark._jvm.org.apache.avro.Schema.Parser().parse(json.dumps(ENVELOPE))
    wrap = lambda b: None if b is None else spark._jvm.java.nio.ByteBuffer.wrap(b)
    writer = avro.file.DataFileWriter(avro.generic.GenericDatumWriter(schema))
    writer.setCodec(avro.file.CodecFactory.fromString(codec))
    if sync:
        writer.setSyncInterval(sync)
    writer.create(schema, spark._jvm.java.io.File(path))
    for topic, partition, offset, timestamp, key, value, headers in records:
        r = avro.generic.GenericData.Record(schema)
        for name, v in (("topic", topic), ("partition", partition), ("offset", offset), ("timestamp", timestamp)):
            r.put(name, v)
        r.put("key", wrap(key))
        r.put("value", wrap(value))
        if headers is not None:
            m = spark._jvm.java.util.HashMap()
            for k, v in headers.items():
                m.put(k, wrap(v))
            r.put("headers", m)
        writer.append(r)
    writer.close()


def test_container_round_trip(spark, tmp_path):
    """A container whose payloads are serialized objects: restored whole, two stamped headers each, renamed."""
    folder = tmp_path / "orders" / "4"
    folder.mkdir(parents=True)
    payloads = [(b"k-%d" % i, b"payload %d" % (i * i)) for i in range(17)]
    records = [("orders", 4, 300 + 2 * i, 1_700_000_000_000 + i, java_bytes(k), java_bytes(v), None) for i, (k, v) in enumerate(payloads)]
    avro_container(spark, str(folder / "orders-4-000000000000300.avro"), records)
    log = L.import_avro_segments(spark, str(tmp_path))
    assert sorted(bytes(r.key) for r in log.collect()) == sorted(java_bytes(k) for k, _ in payloads)
    got = jobs.restore(log, "orders:copies", 7).collect()
    assert len(got) == 17 and {r.topic for r in got} == {"copies"} and all(len(r.headers) == 2 for r in got)


def test_import_names_folders(spark, tmp_path):
    """Topics and a generation choose folders; what does not exist is refused."""
    for topic, generation, offset in (("a", "one", 5), ("a", "two", 6), ("b", None, 7)):
        folder = tmp_path / topic / (generation or "") / "0"
        folder.mkdir(parents=True)
        avro_container(spark, str(folder / f"{topic}-0-{offset:015d}.avro"), [(topic, 0, offset, 1, b"k", b"v", None)])
    read = lambda **k: [r.offset for r in L.import_avro_segments(spark, str(tmp_path), **k).collect()]
    assert read(topics=["a"], generation="two") == [6] and read(topics="b") == [7] and sorted(read()) == [5, 6, 7]
    for wrong in ({"topics": ["a"]}, {"topics": ["a"], "generation": "three"}, {"topics": ["c"]}):
        with pytest.raises(ValueError, match="no segments"):
            read(**wrong)


@pytest.mark.parametrize("codec", ["null", "snappy", "deflate", "bzip2", "xz"])
def test_container_codecs(spark, tmp_path, codec):
    records = [
        ("t", 1, 2**50 + i, 100, None if i % 3 == 0 else bytes(range(256)), b"" if i % 2 else b'"\\\n\x00', {"h": b"\xff\x00"} if i % 2 else None)
        for i in range(50)
    ]
    avro_container(spark, str(tmp_path / "a.avro"), records, codec)
    got = {r.offset: r for r in L.import_avro_segments(spark, str(tmp_path)).collect()}
    assert len(got) == 50
    for topic, partition, offset, timestamp, key, value, headers in records:
        r = got[offset]
        assert (r.topic, r.partition, r.timestamp) == (topic, partition, timestamp)
        assert (None if r.key is None else bytes(r.key)) == key and bytes(r.value) == value
        assert (None if r.headers is None else {h.key: bytes(h.value) for h in r.headers}) == headers


def test_large_containers_are_split(spark, tmp_path):
    records = [("t", 0, i, 0, b"k" * 100, os.urandom(200), None) for i in range(2000)]
    avro_container(spark, str(tmp_path / "a.avro"), records, sync=4000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        log = L.import_avro_segments(spark, str(tmp_path))
        assert log.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert log.select("offset").distinct().count() == log.count() == 2000


def test_record_objects(spark, tmp_path):
    for offset in range(12):
        folder = tmp_path / "store" / "a-topic" / "3"
        folder.mkdir(parents=True, exist_ok=True)
        body = encode_record("a-topic", 3, offset, 50, None, b"%d" % offset, [("h", b"1")])
        (folder / f"{offset:015d}").write_bytes(MARKER + b"12345678" + body)
    (tmp_path / "store" / "a-topic" / "3" / "000000000000099").write_bytes(b"\x01broken")
    got = sorted((r.topic, r.partition, r.offset, r.value and bytes(r.value)) for r in L.import_record_objects(spark, str(tmp_path)).collect())
    assert got[:12] == [("a-topic", 3, o, b"%d" % o) for o in range(12)] and got[12] == ("a-topic", 3, 99, None)


# ---- compaction, generations, retention


def test_latest_per_key_is_the_last_write(skewed_log):
    wanted = {}
    for r in skewed_log.orderBy("offset").collect():
        wanted[(r.topic, r.partition, r.offset if r.key is None else bytes(r.key))] = r
    assert rows(K.latest_per_key(skewed_log, drop_tombstones=False)) == sorted(map(str, wanted.values()))
    assert rows(K.latest_per_key(skewed_log)) == sorted(str(r) for r in wanted.values() if r.value is not None)


def test_events(spark):
    ddl = "key string, event string, connectorInstanceName string, topic string, partition int, offset bigint, timestamp bigint, log_offset bigint"
    row = lambda key, event, at, topic="t", partition=0: (key, event, key, topic, partition, at, 0, at)
    table = lambda *r: spark.createDataFrame(list(r), ddl)
    current = lambda events, state=None: {r.key.lower(): r.offset for r in K.apply_events(state, events, "ACTIVATE", "T").collect()}
    assert current(table(row("i-0", "ACTIVATE", 1), row("I-0", "ACTIVATE", 2))) == {"i-0": 2}
    assert current(table(row("i-0", "ACTIVATE", 1), row("i-0", None, 2))) == {}
    ignored = (row("i-0", "PASSIVATE", 2), row("i-0", "ACTIVATE", 3, "other"), row("i-0", "ACTIVATE", 4, partition=1))
    assert current(table(row("i-0", "ACTIVATE", 1), *ignored)) == {"i-0": 1}
    state = K.apply_events(None, table(row("i-0", "ACTIVATE", 1), row("i-0x-0", "ACTIVATE", 1)), "ACTIVATE")
    assert current(table(row("i-0", None, 5)), state) == {"i-0x-0": 1}


def test_peers():
    assert K.peer_name("backup-activate") == "backup-passivate"
    assert K.peer_name("my-backup-passivate", "PASSIVATE") == "my-backup-activate"
    with pytest.raises(ValueError):
        K.peer_name("backup")


def test_generation_cycle(spark, skewed_log):
    root, manifest = scratch(spark, "generations"), scratch(spark, "manifest")
    targets = skewed_log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    at = lambda s: F.timestamp_seconds(F.lit(s))
    for name in ("one", "two"):
        jobs.new_generation(skewed_log, root, name)
    behind = skewed_log.filter("offset < 50000")
    assert jobs.promote_generation(spark, manifest, "hot", "one", skewed_log, targets, at(10)).count() == 0
    assert jobs.promote_generation(spark, manifest, "hot", "two", behind, targets, at(20)) is None
    assert [tuple(r) for r in jobs.current_generation(spark, manifest).collect()] == [("hot", "one")]
    retired = jobs.promote_generation(spark, manifest, "hot", "two", skewed_log, targets, at(20)).collect()
    assert [tuple(r) for r in retired] == [("hot", "one")]
    assert jobs.current_generation(spark, manifest).first().generation == "two"
    before = B.scan_generation(spark, root, "hot", "two").count()
    assert sinks.drop_generation(spark, root, "hot", "one")
    assert B.scan_generation(spark, root, "hot", "one").count() == 0
    assert B.scan_generation(spark, root, "hot", "two").count() == before > 0
    assert B.scan_generation(spark, root, "t1", "one").count() > 0
    with pytest.raises(ValueError):
        sinks.drop_generation(spark, root, "..", "one")
    due = K.generation_due(spark.createDataFrame([("hot", "two", 0)], "topic string, generation string, s int").withColumn("started_at", F.timestamp_seconds("s")), at(6 * 3600 + 1))
    assert due.first().due and not K.generation_due(due.drop("due"), at(6 * 3600)).first().due


def test_policy(spark):
    policy = X.rule(spark, "other", "a", 3).unionByName(X.rule(spark, "id", "test", 1))
    new = X.upsert_policy(policy, X.rule(spark, "ID", "test", 9, "gen"))
    assert sorted((r.rule_id, r.days) for r in new.collect()) == [("ID-rule-test", 9), ("other-rule-a", 3)]
    scopes = {r.topic: r.scope for r in X.with_scope(new).collect()}
    assert scopes == {"a": "a/", "test": "test/gen/"}
    with pytest.raises(ValueError):
        X.rule(spark, "id", "t", -1)


def test_file_expiry(spark, skewed_log):
    root = scratch(spark, "expiry")
    for name in ("g1", "g2"):
        sinks.write_backup(skewed_log, root, generation=name)
    policy = X.rule(spark, "j", "hot", 1, "g1").unionByName(X.rule(spark, "j", "t", 0)).unionByName(X.rule(spark, "j", "t1", 30))
    files = B.list_files(spark, root)
    later = F.current_timestamp() + F.make_interval(days=F.lit(2))
    assert X.expired_files(files, policy, F.current_timestamp()).count() == 0
    old = X.expired_files(files, policy, later)
    assert {(r.topic, r.generation) for r in old.collect()} == {("hot", "g1")}
    gone = sinks.delete_files(old)
    assert gone >= 1 and B.scan_generation(spark, root, "hot", "g1").count() == 0
    assert B.scan_generation(spark, root, "hot", "g2").count() == 10_000


def test_record_expiry_keeps_what_has_no_age(make_log):
    log = make_log([{"offset": i, "timestamp": None if i < 8 else 1} for i in range(20)])
    left = X.expire_records(S.segment_by_count(log, 4), 5, 100 * 3_600_000)
    assert sorted(r.offset for r in left.collect()) == [*range(8), *range(16, 20)]


def test_record_expiry_keeps_the_open_segment(make_log):
    hour = 3_600_000
    log = make_log([{"offset": i, "timestamp": i * hour} for i in range(10)])
    left = X.expire_records(S.segment_by_count(log, 4), 5, 100 * hour)
    assert sorted(r.offset for r in left.collect()) == [8, 9]
    left = X.expire_records(S.segment_by_count(log, 4), 5, 11 * hour)
    assert sorted(r.offset for r in left.collect()) == [4, 5, 6, 7, 8, 9]


def test_only_small_sides_are_broadcast(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(small_side(spark.range(10), 10)) and not hinted(small_side(spark.range(11), 10))


def test_small_sides_are_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    side = small_side(spark.range(10).coalesce(1).mapInArrow(counted, "id bigint"))
    assert side.join(spark.range(5), "id").count() == 5 and runs.value == 1


def test_shared_folder(spark):
    from tidelog import session

    class Conf:
        settings = {"spark.sql.warehouse.dir": "store:/warehouse"}

        def get(self, key, default=None):
            return self.settings.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(Session()) == "store:/warehouse"
    assert session.scratch(spark, "a").startswith(session.shared_dir(spark))


def test_null_keys_join(spark):
    from tidelog.session import join_null_safe

    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    got = sorted(map(tuple, join_null_safe(left, right, ["k"], "left").collect()), key=lambda r: r[1])
    assert got == [("a", 1, 10), (None, 2, 20), ("b", 3, None)]
    assert join_null_safe(left, right, ["k"], "left_anti").collect()[0].k == "b"


def test_restore_from_refuses_the_wrong_depth(spark, skewed_log, stored):
    got = jobs.restore_from(spark, stored, "hot:cold,t1", 1)
    assert {r.topic for r in got.select("topic").distinct().collect()} == {"cold", "t1"}
    with pytest.raises(ValueError, match="no backup named"):
        root = scratch(spark, "mixed")
        sinks.write_backup(skewed_log, root, generation="g")
        os.makedirs(f"{root}/topic=hot/generation=g/partition=0/deeper")
        path = glob.glob(f"{root}/topic=hot/generation=g/partition=0/*/*.parquet")[0]
        os.link(path, f"{root}/topic=hot/generation=g/part.parquet")
        jobs.restore_from(spark, root, "hot", 1, "g")
    with pytest.raises(ValueError, match="contains generations"):
        jobs.restore_from(spark, root, "t1", 1)
    for topics, generation in (("nowhere", None), ("hot,nowhere", None), ("hot", "missing")):
        with pytest.raises(ValueError, match="no backup"):
            jobs.restore_from(spark, stored, topics, 1, generation)


def test_repeats_do_no_harm(spark, skewed_log):
    root, target = scratch(spark, "again"), scratch(spark, "log")
    for _ in range(2):
        jobs.backup(skewed_log, root, "hot,t1")
    assert B.scan_backup(spark, root).count() == skewed_log.filter("topic IN ('hot', 't1')").count()
    for part in (skewed_log.filter("offset < 20000"), skewed_log.filter("offset >= 20000")):
        sinks.write_log(part, target)
    ends = spark.read.parquet(target).groupBy("topic", "partition").agg(
        (F.max("offset") + 1 == F.count("*")).alias("gapless"), (F.count_distinct("offset") == F.count("*")).alias("unique")
    )
    assert ends.filter("NOT (gapless AND unique)").count() == 0


@pytest.mark.parametrize("flush,schedule", [(700, None), (3, 200_000)])
def test_one_file_per_segment(spark, skewed_log, flush, schedule):
    root = scratch(spark, "segments")
    sinks.write_segments(skewed_log, root, flush, schedule)
    rows_ = spark.read.parquet(root).select("topic", "partition", "offset", "batch_id", F.col("_metadata.file_path").alias("file"))
    per = rows_.groupBy("topic", "partition", "batch_id").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"), F.min("offset").alias("low"))
    assert per.filter(f"files <> 1 OR n > {flush} OR low <> batch_id").count() == 0
    wanted = S.segment(skewed_log, flush, schedule).select("topic", "partition", "segment_id").distinct().count()
    assert per.count() == wanted and rows(B.scan_backup(spark, root)) == rows(skewed_log)


def test_open_tail_waits(spark, make_log):
    root, target = scratch(spark, "batches"), scratch(spark, "merged")
    log = make_log([{"offset": i} for i in range(11)])
    for i in range(4):
        sinks.write_backup(log.filter(f"offset div 3 = {i}"), root, batch_id=i)
    for _ in range(2):
        jobs.merge_batches(spark, root, target, 4)
    assert sorted(r.offset for r in B.scan_backup(spark, target).collect()) == [*range(8)]
    jobs.merge_batches(spark, root, target, 4, open_tail=True)
    assert B.scan_backup(spark, target).count() == 11


def test_idle_segments_close(make_log):
    log = make_log([{"offset": o, "timestamp": 1000 * o} for o in range(5)])
    manifest = jobs.plan_segments(log, 100, 60_000)
    commit = lambda now: S.commit_offsets(manifest, 100, 60_000, now).first().commit_offset
    assert commit(59_999) is None and commit(60_000) == 5
    assert S.commit_offsets(manifest, 100).first().commit_offset is None


def test_empty_as_null(spark, tmp_path):
    avro_container(spark, str(tmp_path / "a.avro"), [("t", 0, 1, 1, b"", b"", None)])
    assert bytes(L.import_avro_segments(spark, str(tmp_path)).first().value) == b""
    assert L.import_avro_segments(spark, str(tmp_path), empty_as_null=True).first().value is None
