"""Every operator run over the driver's tables, by name. ``oracle.py`` has the same in SQL."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import headers as H
from tidelog.functions import names as N
from tidelog.functions.envelopes import decode_envelopes, encode_envelopes
from tidelog.functions.envelopes import envelope_losses as lost_in_envelopes
from tidelog.operators import commits as C
from tidelog.operators import compaction as K
from tidelog.operators import generator as G
from tidelog.operators import inventory as I
from tidelog.operators import records as R
from tidelog.operators import retention as X
from tidelog.operators import segments as S
from tidelog.operators.ordering import offset_block
from tidelog.plans import derived as D
from tidelog.plans import cycle, jobs
from tidelog.schema import LOG_SCHEMA, file_format
from tidelog.session import scratch
from tidelog.sources import backup as B
from tidelog.sources import files as W
from tidelog.sources.legacy import import_avro_segments as import_segments
from tidelog.sources.legacy import strip_folder_names
from tidelog.sources.log import read_log, stream_log
from tidelog.sources.sinks import drop_generation, put_files, write_backup, write_log
from tidelog.sources.sinks import write_segments as put_segments
from tidelog.sources.snapshots import reserve
from tidelog.sources.times import index_times
from tidelog.sources.times import scan_time_range_indexed as scan_indexed
from tidelog.streaming import jobs as T
from tidelog.streaming.segments import stream_segments as put_closed_segments

QUERIES: dict = {}

# Parameters of the registered runs; the SQL uses the same values.
FLUSH, FILE_FLUSH, SCHEDULE_MS, INTERVAL_MS, MARK_EVERY = 50, 200, 25_200_000, 10_800_000, 100
DAY0, DAY_MS = 1_704_067_200_000, 86_400_000
MID = DAY0 + 15 * DAY_MS
GROUP = "Grp-3"
CHUNK, REPEAT, WEIGHTS = 1000, 7, (4, 1, 1, 1)
MAP_TEXT = "ev-click:new-click,ev-view:new-view,ev-error"
JAVA_STRING = "ACED000574"
# Identifiers of one file of a watched folder, and bytes of a file that are one row while it is hashed.
PART, PIECE_BYTES = 1 << 12, 1 << 14


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def flat(df: DataFrame) -> DataFrame:
    """Log columns with bytes as hex and headers as text."""
    pairs = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), F.hex(h["value"])))
    return df.select(
        "topic", "partition", "offset", "timestamp",
        F.hex("key").alias("key"), F.hex("value").alias("value"),
        F.concat_ws(";", pairs).alias("headers"),
    )


def exported(spark, sf_dir) -> str:
    """The event log as a Parquet log, in offset order."""
    return D.once(
        spark, sf_dir, "log",
        lambda path: D.event_log(spark, sf_dir).repartitionByRange("offset").write.parquet(path),
    )


def generations(spark, sf_dir) -> str:
    return D.once(spark, sf_dir, "generations", lambda path: jobs.new_generation(D.event_log(spark, sf_dir), path, "gen-a"))


def finished(stream) -> None:
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


def prepare(spark, sf_dir) -> None:
    """Write the stored logs and backups that several queries read."""
    exported(spark, sf_dir)
    D.event_backup(spark, sf_dir)
    D.commit_log(spark, sf_dir)
    generations(spark, sf_dir)


# ---- sources ----------------------------------------------------------------------------------


@query
def read_log_from(spark, sf_dir):
    return flat(read_log(spark, exported(spark, sf_dir), "ev-click,ev-view", start={"ev-click": {"0": 500, "2": 900}}))


@query
def read_log_latest(spark, sf_dir):
    return flat(
        read_log(
            spark, exported(spark, sf_dir), "ev-click,ev-view,ev-error",
            start={"ev-click": {"0": -1, "1": -2}, "ev-view": {"0": 500}}, end={"ev-view": {"0": -1, "1": 900}},
        )
    )


@query
def scan_backup(spark, sf_dir):
    return flat(B.scan_backup(spark, D.event_backup(spark, sf_dir)))


@query
def scan_topic(spark, sf_dir):
    return flat(B.scan_backup(spark, D.event_backup(spark, sf_dir), "ev-click"))


@query
def scan_partition(spark, sf_dir):
    return flat(B.scan_partition(spark, D.event_backup(spark, sf_dir), "ev-click", 2))


@query
def lookup_record(spark, sf_dir):
    return flat(B.lookup_record(spark, D.event_backup(spark, sf_dir), "ev-click", 2, 1))


@query
def scan_time_range(spark, sf_dir):
    return flat(B.scan_time_range(spark, D.event_backup(spark, sf_dir), "ev-view", 1, DAY0 + 5 * DAY_MS, DAY0 + 10 * DAY_MS))


@query
def scan_time_range_indexed(spark, sf_dir):
    # orders do not come in the order of their dates
    def write(path):
        write_backup(D.order_log(spark, sf_dir), path, block=4096)
        index_times(spark, path)

    root = D.once(spark, sf_dir, "timed", write)
    return flat(scan_indexed(spark, root, "or-F", 3, 800_000_000_000, 850_000_000_000))


@query
def scan_offset_range(spark, sf_dir):
    return flat(B.scan_offset_range(spark, D.event_backup(spark, sf_dir), "ev-view", 1, 100, 5000))


@query
def scan_generation(spark, sf_dir):
    return flat(B.scan_generation(spark, generations(spark, sf_dir), "ev-click", "gen-a"))


@query
def backup_inventory(spark, sf_dir):
    files = B.list_files(spark, D.event_backup(spark, sf_dir))
    return I.backup_inventory(files, MAP_TEXT).withColumn("ids", F.concat_ws(",", F.col("ids").cast("array<string>")))


@query
def check_layout(spark, sf_dir):
    files = B.list_files(spark, generations(spark, sf_dir))
    good = I.check_layout(files, "gen-a", "relative").select("topic", F.lit("gen-a").alias("generation"), "ok")
    bad = I.check_layout(files, None, "relative").select("topic", F.lit("none").alias("generation"), "ok")
    return good.unionByName(bad)


@query
def import_avro_segments(spark, sf_dir):
    def write(path):
        # the envelope of old files: headers are a map
        log = D.event_log(spark, sf_dir).withColumn("headers", H.headers_map())
        log.write.format(file_format("avro")).option("compression", "deflate").save(path)

    return flat(import_segments(spark, D.once(spark, sf_dir, "containers", write)))


@query
def import_avro_generation(spark, sf_dir):
    def write(path):
        # topic/generation/partition folders, of which one generation is asked for: all are written in one pass
        log = D.event_log(spark, sf_dir).withColumn("headers", H.headers_map())
        both = log.withColumn("g", F.lit("gen-a")).unionByName(log.filter("value IS NOT NULL").withColumn("g", F.lit("gen-b")))
        rows = both.withColumns({"t": F.col("topic"), "p": F.col("partition")})
        placed = rows.repartition("t", "g", "p", offset_block()).sortWithinPartitions("t", "g", "p", "offset")
        staged = scratch(spark, "staged")
        placed.write.format(file_format("avro")).partitionBy("t", "g", "p").save(staged)
        strip_folder_names(spark, staged, path, ("t", "g", "p"))

    root = D.once(spark, sf_dir, "instances", write)
    return flat(import_segments(spark, root, topics=["ev-click", "ev-error"], generation="gen-b"))


def _avro(spark, sf_dir) -> str:
    return D.once(spark, sf_dir, "avro", lambda path: write_backup(D.event_log(spark, sf_dir), path, codec="xz", fmt="avro"))


@query
def scan_avro_backup(spark, sf_dir):
    return flat(B.scan_backup(spark, _avro(spark, sf_dir), "ev-click,ev-view", fmt="avro"))


@query
def scan_avro_topics(spark, sf_dir):
    return flat(B.scan_backup(spark, _avro(spark, sf_dir), fmt="avro"))


# ---- record transforms ------------------------------------------------------------------------


@query
def to_envelope(spark, sf_dir):
    # the shape of Spark's Kafka source: a timestamp column, no offsets as text
    kafka = D.event_log(spark, sf_dir).withColumn("timestamp", F.timestamp_millis("timestamp"))
    return flat(R.to_envelope(kafka))


@query
def select_topics(spark, sf_dir):
    return flat(R.select_topics(D.event_log(spark, sf_dir), "ev-click, ev-error"))


@query
def headers_last_wins(spark, sf_dir):
    log = H.add_header(D.event_log(spark, sf_dir), "type", F.col("topic"))
    names = H.headers_map()
    text = lambda name: F.try_element_at(names, F.lit(name)).cast("string")
    return log.select(
        "topic", "partition", "offset",
        F.size(names).alias("names"),
        text("event.id").alias("event_id"), text("seq").alias("seq"), text("type").alias("type"),
        H.has_headers().alias("has_headers"),
    )


@query
def encode_nulls(spark, sf_dir):
    return flat(R.encode_nulls(D.event_log(spark, sf_dir)))


@query
def decode_nulls(spark, sf_dir):
    return flat(R.decode_nulls(R.encode_nulls(D.event_log(spark, sf_dir))))


@query
def route(spark, sf_dir):
    return D.event_log(spark, sf_dir).groupBy(N.route().alias("route")).agg(F.count(F.lit(1)).alias("records"))


@query
def rename_topics(spark, sf_dir):
    return flat(R.rename_topics(D.event_log(spark, sf_dir), MAP_TEXT))


@query
def rename_topics_by_table(spark, sf_dir):
    types = D.table(spark, sf_dir, "events").select("event_type").distinct()
    mapping = types.select(
        F.concat(F.lit("ev-"), "event_type").alias("source_topic"),
        F.concat(F.lit("copy-"), "event_type").alias("target_topic"),
    )
    return flat(R.rename_topics(D.event_log(spark, sf_dir), mapping))


@query
def stamp_headers(spark, sf_dir):
    return flat(H.stamp_restore_headers(D.event_log(spark, sf_dir), D.RESTORED_AT))


@query
def old_offset(spark, sf_dir):
    stamped = H.stamp_restore_headers(D.event_log(spark, sf_dir), D.RESTORED_AT)
    return stamped.select("topic", "partition", "offset", H.old_offset().alias("old_offset"))


@query
def unwrap_legacy_headers(spark, sf_dir):
    # every header value as a Java-serialized String: magic, 16-bit length, text
    wrap = lambda v: F.unhex(F.concat(F.lit(JAVA_STRING), F.lpad(F.hex(F.length(v).cast("bigint")), 4, "0"), F.hex(v)))
    wrapped = F.transform("headers", lambda h: F.struct(h["key"].alias("key"), wrap(h["value"]).alias("value")))
    return flat(H.unwrap_legacy_headers(D.event_log(spark, sf_dir).withColumn("headers", wrapped)))


@query
def envelope_roundtrip(spark, sf_dir):
    encoded = encode_envelopes(D.event_log(spark, sf_dir)).select("envelope")
    return flat(decode_envelopes(encoded).select("record.*"))


@query
def envelope_losses(spark, sf_dir):
    # every other record without its repeated header, and some without a timestamp
    log = D.event_log(spark, sf_dir)
    once = F.when(F.col("offset") % 2 == 0, F.slice("headers", F.lit(1), F.lit(2))).otherwise(F.col("headers"))
    known = F.when(F.col("offset") % 5 != 0, F.col("timestamp"))
    return lost_in_envelopes(log.withColumn("headers", once).withColumn("timestamp", known))


@query
def parse_segment_path(spark, sf_dir):
    manifest = S.segment_manifest(S.segment_by_count(D.event_log(spark, sf_dir), FLUSH), "gen-a")
    return N.parse_segment_path(manifest.select("name"), "name")


@query
def parse_offset_spec(spark, sf_dir):
    last = C.commits_by_group(D.commit_log(spark, sf_dir)).groupBy("topic", "partition").agg(F.max("committed").alias("c"))
    entry = F.concat(F.col("partition").cast("string"), F.lit(":"), F.col("c").cast("string"))
    specs = last.groupBy("topic").agg(F.concat_ws(",", F.collect_list(entry)).alias("spec"))
    return N.parse_offset_spec(specs)


@query
def parse_topic_pair(spark, sf_dir):
    text = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(
        F.concat("event_type", F.lit(":r-"), "event_type")
    )
    pair = N.parse_topic_pair(text)
    return (
        D.table(spark, sf_dir, "events").select(pair.alias("p"))
        .groupBy("p.source_topic", "p.target_topic").agg(F.count(F.lit(1)).alias("records"))
    )


# ---- filters, resume, order -------------------------------------------------------------------


@query
def exclude_group(spark, sf_dir):
    kept = R.exclude_group(D.commit_log(spark, sf_dir), GROUP.upper())
    return kept.select("partition", "offset", F.hex("key").alias("key"))


@query
def valid_offset_records(spark, sf_dir):
    valid = R.valid_offset_records(C.decode_offset_log(D.commit_log(spark, sf_dir)))
    return valid.select("offset", "offset_key.group", "offset_key.topic", F.col("offset_key.partition").alias("of_partition"))


@query
def resume_after(spark, sf_dir):
    log = D.event_log(spark, sf_dir)
    done = log.filter((F.col("timestamp") < MID) & (F.col("topic") != "ev-error"))
    positions = done.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))
    return flat(R.resume_after(log, positions))


@query
def dedupe_log(spark, sf_dir):
    return R.dedupe_log(D.line_log(spark, sf_dir)).select("topic", "partition", "offset")


@query
def batch_cap(spark, sf_dir):
    return flat(R.batch_cap(R.select_topics(D.event_log(spark, sf_dir), "ev-click"), 100))


@query
def poll_batches(spark, sf_dir):
    return R.poll_batches(D.event_log(spark, sf_dir), 100).select("topic", "partition", "offset", "poll")


@query
def restore_order(spark, sf_dir):
    return flat(R.restore_order(D.event_log(spark, sf_dir)))


@query
def union_topics(spark, sf_dir):
    both = R.union_topics(D.event_log(spark, sf_dir), D.order_log(spark, sf_dir))
    return both.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("records"), F.max("offset").alias("last_offset"))


@query
def restore_job(spark, sf_dir):
    log = B.scan_backup(spark, D.event_backup(spark, sf_dir))
    return flat(jobs.restore(log, MAP_TEXT, D.RESTORED_AT))


# ---- offset log and translation ---------------------------------------------------------------


@query
def decode_offset_keys(spark, sf_dir):
    return C.decode_offset_keys(D.commit_log(spark, sf_dir)).select(
        "offset", "key_version", F.col("offset_key.group").alias("group_id"),
        F.col("offset_key.topic").alias("of_topic"), F.col("offset_key.partition").alias("of_partition"),
    )


@query
def decode_offset_values(spark, sf_dir):
    return C.decode_offset_values(D.commit_log(spark, sf_dir)).select(
        "offset", "value_version", F.col("offset_value.offset").alias("committed"), "offset_value.leader_epoch",
        "offset_value.metadata", "offset_value.commit_timestamp", "offset_value.expire_timestamp",
    )


@query
def committed_last(spark, sf_dir):
    return C.commits_by_group(D.commit_log(spark, sf_dir)).withColumnRenamed("group", "group_id")


@query
def committed_max(spark, sf_dir):
    return C.commits_by_group(D.commit_log(spark, sf_dir), "max").withColumnRenamed("group", "group_id")


@query
def committed_from_log(spark, sf_dir):
    return C.committed_from_log(D.commit_log(spark, sf_dir), GROUP, "ev-click")


def _live(spark, sf_dir):
    user = F.col("user_id")
    return D.table(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("Grp-"), (user % 7).cast("string")).alias("group"),
        F.concat(F.lit("ev-"), "event_type").alias("topic"),
        (user % 4).cast("int").alias("partition"),
    ).agg(F.max("event_id").alias("offset"))


@query
def committed_from_table(spark, sf_dir):
    return C.committed_from_table(_live(spark, sf_dir), GROUP.upper(), "EV-Click")


@query
def offset_source(spark, sf_dir):
    return C.offset_source(
        backup=C.committed_from_log(D.commit_log(spark, sf_dir), GROUP, "ev-view"),
        live=C.committed_from_table(_live(spark, sf_dir), GROUP, "ev-view"),
    )


def _translated(spark, sf_dir, policy):
    committed = C.commits_by_group(D.commit_log(spark, sf_dir)).filter(F.col("group") == GROUP)
    return C.translate_offsets(
        R.rename_topics(committed, D.event_topics(spark, sf_dir)), D.restored_log(spark, sf_dir), policy, keys=("topic", "partition")
    )


@query
def translate_exact(spark, sf_dir):
    return _translated(spark, sf_dir, "exact")


@query
def translate_or_last(spark, sf_dir):
    return _translated(spark, sf_dir, "exact_or_last")


@query
def translate_asof(spark, sf_dir):
    return _translated(spark, sf_dir, "first_at_or_after")


@query
def starting_offsets(spark, sf_dir):
    return C.starting_offsets_json(_translated(spark, sf_dir, "first_at_or_after"))


@query
def translate_job(spark, sf_dir):
    return jobs.translate(D.commit_log(spark, sf_dir), D.restored_log(spark, sf_dir), GROUP, "ev-click", "r-click")


@query
def translate_group_job(spark, sf_dir):
    return jobs.translate_group(
        D.restored_log(spark, sf_dir), GROUP, "ev-view", "r-view", offset_log=D.commit_log(spark, sf_dir), live=_live(spark, sf_dir)
    )


@query
def offset_index(spark, sf_dir):
    types = D.table(spark, sf_dir, "events").select("event_type").distinct()
    mapping = types.select(
        F.concat(F.lit("ev-"), "event_type").alias("source_topic"), F.concat(F.lit("r-"), "event_type").alias("target_topic")
    )
    return C.offset_index(D.event_log(spark, sf_dir), D.restored_log(spark, sf_dir), mapping)


@query
def offset_index_runs(spark, sf_dir):
    return C.offset_index_runs(D.restored_log(spark, sf_dir), D.event_topics(spark, sf_dir))


@query
def translate_all_groups(spark, sf_dir):
    runs = C.offset_index_runs(D.restored_log(spark, sf_dir), D.event_topics(spark, sf_dir))
    committed = C.commits_by_group(D.commit_log(spark, sf_dir)).withColumnsRenamed({"group": "group_id", "topic": "old_topic"})
    return C.translate_by_runs(committed, runs)


# ---- segments ---------------------------------------------------------------------------------


def _segment_rows(df):
    return df.select("topic", "partition", "offset", "segment_id")


@query
def segment_by_count(spark, sf_dir):
    return _segment_rows(S.segment_by_count(D.event_log(spark, sf_dir), FLUSH))


@query
def segment_by_schedule(spark, sf_dir):
    return _segment_rows(S.segment_by_schedule(D.event_log(spark, sf_dir), SCHEDULE_MS))


@query
def segment_mixed(spark, sf_dir):
    return _segment_rows(S.segment(D.event_log(spark, sf_dir), 20, SCHEDULE_MS))


@query
def segment_mixed_late(spark, sf_dir):
    return _segment_rows(S.segment(D.order_log(spark, sf_dir), FLUSH, DAY_MS))


def _late_clock(spark, sf_dir):
    """The event log whose first records have no timestamp, as every ninth later one has none."""
    known = (F.col("offset") >= 400) & (F.col("offset") % 9 != 0)
    return D.event_log(spark, sf_dir).withColumn("timestamp", F.when(known, F.col("timestamp")))


@query
def segment_null_clock(spark, sf_dir):
    return _segment_rows(S.segment(_late_clock(spark, sf_dir), 20, SCHEDULE_MS))


@query
def segment_by_interval(spark, sf_dir):
    return _segment_rows(S.segment_by_interval(D.event_log(spark, sf_dir), INTERVAL_MS))


@query
def segment_manifest(spark, sf_dir):
    return S.segment_manifest(S.segment_by_count(D.event_log(spark, sf_dir), FLUSH))


@query
def commit_offsets(spark, sf_dir):
    return S.commit_offsets(S.segment_manifest(S.segment_by_count(D.event_log(spark, sf_dir), FLUSH)), FLUSH)


@query
def commit_offsets_mixed(spark, sf_dir):
    return S.commit_offsets(jobs.plan_segments(D.event_log(spark, sf_dir), 20, SCHEDULE_MS), 20)


@query
def commit_offsets_idle(spark, sf_dir):
    manifest = jobs.plan_segments(D.event_log(spark, sf_dir), 20, SCHEDULE_MS)
    return S.commit_offsets(manifest, 20, SCHEDULE_MS, DAY0 + 30 * DAY_MS - SCHEDULE_MS // 2)


# ---- compaction and generations ---------------------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    return flat(K.latest_per_key(D.event_log(spark, sf_dir)))


@query
def latest_with_tombstones(spark, sf_dir):
    return flat(K.latest_per_key(D.event_log(spark, sf_dir), drop_tombstones=False))


@query
def compact_incremental(spark, sf_dir):
    log, names = D.event_log(spark, sf_dir), [f"run_{uuid.uuid4().hex}" for _ in range(3)]
    late = F.col("timestamp") >= MID + 7 * DAY_MS
    try:
        # a base and two later parts of the log, the last records of a key before and after its tombstone among them
        jobs.compact(log.filter(F.col("timestamp") < MID), names[0], scratch(spark, "run"), 8)
        jobs.compact_incremental(spark, names[0], log.filter((F.col("timestamp") >= MID) & ~late), names[1], scratch(spark, "run"), 8)
        jobs.compact_incremental(spark, names[1], log.filter(late), names[2], scratch(spark, "run"), 8)
        # records beyond the table's life: it goes with this call
        path = scratch(spark, "compacted")
        spark.table(names[2]).select(*LOG_SCHEMA.fieldNames()).write.parquet(path)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return flat(spark.read.schema(LOG_SCHEMA).parquet(path))


@query
def generation_cycle(spark, sf_dir):
    root, log = scratch(spark, "cycle"), D.event_log(spark, sf_dir)
    step = 5 * DAY_MS
    for i in range(1, 7):
        # starting and handing over in turn: three cycles in six steps
        cycle.advance(spark, log.filter(F.col("timestamp") < DAY0 + i * step), root, DAY0 + i * step, ("backup-activate", "backup-passivate"))
    left = spark.read.schema(B._schema(True, True)).parquet(root).select("topic", F.col("generation").alias("stored")).distinct()
    return flat(cycle.current_records(spark, root).join(left, "topic").drop("generation").withColumn("topic", F.concat("topic", F.lit("@"), "stored")))


def _coordination(spark, sf_dir):
    user = F.col("user_id")
    partition = (user % 4).cast("int")
    key = F.concat(F.lit("inst"), (user % 13).cast("string"), F.lit("-activate-"), partition.cast("string"))
    event = F.when(F.col("event_type") == "click", F.lit("PASSIVATE")).when(F.col("event_type") != "view", F.lit("ACTIVATE"))
    return D.table(spark, sf_dir, "events").select(
        F.when(F.col("value") > 100, F.upper(key)).otherwise(key).alias("key"),
        event.alias("event"),
        key.alias("connectorInstanceName"),
        F.lit("ev-data").alias("topic"),
        F.when(F.col("value") > 200, 9).otherwise(partition).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        D.epoch_ms("ts").alias("timestamp"),
        F.col("event_id").alias("log_offset"),
    )


@query
def apply_events(spark, sf_dir):
    return K.apply_events(None, _coordination(spark, sf_dir), "ACTIVATE", "EV-DATA")


@query
def caught_up(spark, sf_dir):
    log = D.event_log(spark, sf_dir)
    targets = log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    return K.caught_up(log.filter("value IS NOT NULL"), targets)


@query
def progress_marks(spark, sf_dir):
    return K.progress_marks(D.event_log(spark, sf_dir), MARK_EVERY)


@query
def coordination_events(spark, sf_dir):
    ends = D.event_log(spark, sf_dir).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    return K.coordination_events(ends, "backup-activate", "ACTIVATE", D.RESTORED_AT)


@query
def generation_due(spark, sf_dir):
    manifest = D.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("topic"),
        F.col("o_orderkey").cast("string").alias("generation"),
        F.timestamp_millis(D.epoch_ms("o_orderdate")).alias("started_at"),
    )
    now = F.timestamp_millis(F.lit(DAY0))
    due = K.generation_due(manifest, now)
    return due.select("topic", F.unix_millis("started_at").alias("started_ms"), "due")


@query
def promote_generation(spark, sf_dir):
    log, manifest = D.event_log(spark, sf_dir), scratch(spark, "promotions")
    targets = log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    # the second generation misses the tombstones, so it is live only where it has caught up
    jobs.promote_generations(spark, manifest, "gen-a", log, targets, F.timestamp_millis(F.lit(DAY0)))
    jobs.promote_generations(
        spark, manifest, "gen-b", log.filter("value IS NOT NULL"), targets, F.timestamp_millis(F.lit(MID))
    )
    return jobs.current_generation(spark, manifest)


@query
def drop_generation_of_topic(spark, sf_dir):
    root, log = scratch(spark, "generations"), D.event_log(spark, sf_dir)
    for name in ("gen-a", "gen-b"):
        write_backup(log, root, generation=name)
    drop_generation(spark, root, "ev-click", "gen-a")
    drop_generation(spark, root, "ev-view", "gen-b", partition=1)
    left = spark.read.schema(B._schema(True, False)).parquet(root)
    return left.groupBy("topic", "generation", "partition").agg(F.count(F.lit(1)).alias("records"))


# ---- retention --------------------------------------------------------------------------------


def _policy(spark, sf_dir):
    return D.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("job-rule-"), "n_name").alias("rule_id"),
        F.col("n_name").alias("topic"),
        F.when(F.col("n_regionkey") == 0, F.lit("gen-a")).alias("generation"),
        F.col("n_nationkey").cast("int").alias("days"),
        (F.col("n_regionkey") != 4).alias("enabled"),
    )


@query
def upsert_policy(spark, sf_dir):
    policy = _policy(spark, sf_dir)
    first = policy.groupBy("generation").agg(F.min("topic").alias("topic"))
    rules = first.select(
        F.concat(F.lit("JOB-RULE-"), "topic").alias("rule_id"), "topic", "generation",
        F.lit(90).alias("days"), F.lit(True).alias("enabled"),
    )
    return X.upsert_policy(policy, rules)


@query
def policy_scope(spark, sf_dir):
    return X.with_scope(_policy(spark, sf_dir)).select("rule_id", "scope")


@query
def expire_files(spark, sf_dir):
    log = D.event_log(spark, sf_dir)
    policy = log.select("topic").distinct().select(
        F.concat(F.lit("job-rule-"), "topic").alias("rule_id"), "topic", F.lit(None).cast("string").alias("generation"),
        F.when(F.col("topic") == "ev-click", 30).otherwise(1).alias("days"), (F.col("topic") != "ev-view").alias("enabled"),
    )
    later = F.current_timestamp() + F.make_interval(days=F.lit(2))
    return jobs.expire_files(spark, D.event_backup(spark, sf_dir), policy, later).select("topic", "partition").distinct()


@query
def expire_records(spark, sf_dir):
    cut = S.segment_by_count(D.event_log(spark, sf_dir), 100)
    return X.expire_records(cut, 24 * 10, DAY0 + 30 * DAY_MS).select("topic", "partition", "offset", "segment_id")


@query
def expire_unknown_age(spark, sf_dir):
    # topics that never had a timestamp, among those that have
    log = D.event_log(spark, sf_dir)
    log = log.withColumn("timestamp", F.when(~F.col("topic").isin("ev-view", "ev-error"), F.col("timestamp")))
    cut = S.segment_by_count(log, 100)
    return X.expire_records(cut, 24 * 10, DAY0 + 30 * DAY_MS).select("topic", "partition", "offset", "segment_id")


@query
def expire_files_by_age(spark, sf_dir):
    # the listing of a backup with generations, whose files are as old as their topic's and partition's number say
    files = B.list_files(spark, generations(spark, sf_dir)).select("path", "topic", "generation", "partition")
    days = F.col("partition") + F.length("topic")
    files = files.withColumn("modified", F.timestamp_millis(F.lit(DAY0) - days * DAY_MS))
    policy = D.event_topics(spark, sf_dir).select(
        F.concat(F.lit("job-rule-"), "source_topic").alias("rule_id"), F.col("source_topic").alias("topic"),
        F.when(F.col("source_topic") == "ev-click", "gen-b").when(F.col("source_topic") != "ev-view", "gen-a").alias("generation"),
        F.lit(9).alias("days"), F.lit(True).alias("enabled"),
    )
    return X.expired_files(files, policy, F.timestamp_millis(F.lit(DAY0))).select("topic", "partition").distinct()


# ---- generator --------------------------------------------------------------------------------


def _messages(df):
    return df.select("path", F.col("pos").cast("bigint").alias("pos"), F.md5(F.hex("value")).alias("digest"))


@query
def chunk_files(spark, sf_dir):
    return _messages(G.chunk_files(D.document_files(spark, sf_dir), CHUNK))


@query
def repeat_to(spark, sf_dir):
    return _messages(G.chunk_files(D.document_files(spark, sf_dir), CHUNK, REPEAT))


@query
def weighted_round_robin(spark, sf_dir):
    files = D.document_files(spark, sf_dir)
    indexed = G.message_index(G.chunk_files(files, CHUNK), G.messages_per_file(files, CHUNK))
    spread = G.assign_partitions(indexed, 4, WEIGHTS)
    return spread.select("path", F.col("pos").cast("bigint").alias("pos"), "index", "partition")


@query
def message_numbers(spark, sf_dir):
    log = G.generate_log(D.document_files(spark, sf_dir), "generated", CHUNK, 4, WEIGHTS)
    number = F.try_element_at(H.headers_map(), F.lit("message.number")).cast("string")
    return log.select("topic", "partition", "offset", F.hex("key").alias("key"), number.alias("number"))


def texts(spark, sf_dir) -> str:
    """A folder with the texts of every language, cut into files of ``PART`` identifiers whose name order is id order."""
    part = F.lpad(F.expr(f"doc_id div {PART}").cast("string"), 18, "0")
    return D.once(
        spark, sf_dir, "texts",
        lambda path: D.table(spark, sf_dir, "documents").withColumn("part", part).repartition("lang", "part")
        .sortWithinPartitions("lang", "part", "doc_id").select("lang", "part", F.col("text").alias("value"))
        .write.partitionBy("lang", "part").text(path),
    )


@query
def watch_files(spark, sf_dir):
    out = scratch(spark, "watched")
    # pieces small enough for a batch of them in a Python worker
    pieces = G.chunk_files(W.watch_files(spark, texts(spark, sf_dir) + "/*/*"), PIECE_BYTES).select(
        F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang"), "path", "pos", "value"
    )
    finished(
        pieces.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "checkpoint"))
        .trigger(availableNow=True).start()
    )
    return W.digests(spark.read.parquet(out), "lang", ["path", "pos"])


@query
def watched_log(spark, sf_dir):
    target = scratch(spark, "watched")
    finished(
        T.stream_files(
            W.watch_files(spark, texts(spark, sf_dir) + "/*/*"), target, scratch(spark, "checkpoint"), "files", CHUNK, 4, WEIGHTS,
            poll_seconds=None, part_name="/part=[^/]+/[^/]+$",
        )
    )
    return B.scan_backup(spark, target).select("topic", "partition", "offset", F.md5(F.hex("value")).alias("digest"))


# ---- sinks and streams ------------------------------------------------------------------------


@query
def write_log_table(spark, sf_dir):
    target = scratch(spark, "target")
    restored = jobs.restore(B.scan_backup(spark, D.event_backup(spark, sf_dir)), MAP_TEXT, D.RESTORED_AT)
    write_log(restored, target)
    return flat(spark.read.schema(LOG_SCHEMA).parquet(target))


@query
def replayed_batch(spark, sf_dir):
    root, log = scratch(spark, "replayed"), D.event_log(spark, sf_dir)
    for batch_id, part in ((0, F.col("timestamp") < MID), (1, F.col("timestamp") >= MID), (0, F.col("timestamp") < MID)):
        write_backup(log.filter(part), root, batch_id=batch_id)
    return flat(B.scan_backup(spark, root))


@query
def backup_repeated(spark, sf_dir):
    root, log = scratch(spark, "repeated"), D.event_log(spark, sf_dir)
    for _ in range(2):
        jobs.backup(log, root, "ev-click,ev-view")
    return flat(B.scan_backup(spark, root))


@query
def generation_repeated(spark, sf_dir):
    root, log = scratch(spark, "generations"), D.event_log(spark, sf_dir)
    for _ in range(2):
        jobs.new_generation(log, root, "gen-a")
    return flat(B.scan_generation(spark, root, "ev-click", "gen-a"))


@query
def bulk_then_stream(spark, sf_dir):
    root, source, log = scratch(spark, "mixed"), scratch(spark, "source"), D.event_log(spark, sf_dir)
    jobs.backup(log.filter(F.col("timestamp") < MID), root, [r.source_topic for r in D.event_topics(spark, sf_dir).collect()])
    log.filter(F.col("timestamp") >= MID).write.parquet(source)
    later = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 2).parquet(source)
    finished(T.stream_backup_sink(later, root, scratch(spark, "checkpoint"), poll_seconds=None))
    return flat(B.scan_backup(spark, root))


@query
def backup_in_two_runs(spark, sf_dir):
    # the second run sees the whole log and goes on where the first ended; a third one finds nothing new
    root, log = scratch(spark, "runs"), D.event_log(spark, sf_dir)
    topics = [r.source_topic for r in D.event_topics(spark, sf_dir).collect()]
    for part in (log.filter(F.col("timestamp") < MID), log, log):
        jobs.backup(part, root, topics)
    return flat(B.scan_backup(spark, root))


@query
def batch_shrunk(spark, sf_dir):
    # two adding writes, of which one is repeated with less than before
    root, log = scratch(spark, "shrunk"), D.event_log(spark, sf_dir)
    write_backup(log.filter(F.col("timestamp") < MID), root)
    for part in ("true", "partition <> 3"):
        write_backup(log.filter(F.col("timestamp") >= MID).filter(part), root, batch_id=5)
    return flat(B.scan_backup(spark, root))


@query
def generation_shrunk(spark, sf_dir):
    root, log = scratch(spark, "generations"), D.event_log(spark, sf_dir)
    jobs.new_generation(log, root, "gen-a")
    jobs.new_generation(log.filter("partition = 0"), root, "gen-a")
    return flat(B.scan_backup(spark, root, generation="gen-a"))


def _halves(spark, sf_dir) -> list[str]:
    """The event log as two Parquet logs, before and after its middle."""
    log = D.event_log(spark, sf_dir)
    return [
        D.once(spark, sf_dir, f"half-{i}", lambda path, part=part: log.filter(part).write.parquet(path))
        for i, part in enumerate((F.col("timestamp") < MID, F.col("timestamp") >= MID))
    ]


@query
def stream_new_checkpoint(spark, sf_dir):
    root = scratch(spark, "streamed")
    for half in _halves(spark, sf_dir):
        source = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 3).parquet(half)
        finished(T.stream_backup_sink(source, root, scratch(spark, "checkpoint"), poll_seconds=None))
    return flat(B.scan_backup(spark, root))


def _offsets_of(restored):
    return restored.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("offset").alias("offsets"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.sum(H.old_offset()).alias("old_offsets"),
    )


@query
def restore_new_checkpoint(spark, sf_dir):
    target = scratch(spark, "restored")
    for half in _halves(spark, sf_dir):
        source = spark.readStream.schema(LOG_SCHEMA).parquet(half)
        finished(T.stream_restore(source, target, scratch(spark, "checkpoint"), MAP_TEXT, now_ms=D.RESTORED_AT, poll_seconds=None))
    return _offsets_of(B.scan_backup(spark, target))


@query
def stream_backup_by_manifest(spark, sf_dir):
    # between two writes that count lie one that never ended and one that a later one replaces
    root, target, checkpoint = (scratch(spark, n) for n in ("committed", "restored", "checkpoint"))
    log = D.event_log(spark, sf_dir)

    def follow():
        finished(T.stream_restore_commits(spark, root, target, checkpoint, MAP_TEXT, now_ms=D.RESTORED_AT, max_commits=1, poll_seconds=None))

    write_backup(log.filter(F.col("timestamp") < MID), root)
    put_files(log, root, reserve(spark, root))
    write_backup(log.filter((F.col("timestamp") >= MID) & (F.col("partition") < 2)), root, label="late")
    follow()
    write_backup(log.filter(F.col("timestamp") >= MID), root, label="late")
    follow()
    return _offsets_of(B.scan_backup(spark, target))


@query
def write_log_appended(spark, sf_dir):
    target, log = scratch(spark, "target"), D.event_log(spark, sf_dir)
    write_log(log.filter(F.col("timestamp") < MID), target)
    write_log(log.filter(F.col("timestamp") >= MID), target)
    return flat(spark.read.schema(LOG_SCHEMA).parquet(target))


@query
def restore_merged_topics(spark, sf_dir):
    target = scratch(spark, "merged")
    source = B.stream_backup(spark, D.event_backup(spark, sf_dir), max_files=3)
    finished(
        T.stream_restore(
            source, target, scratch(spark, "checkpoint"), "ev-click:all,ev-view:all", now_ms=D.RESTORED_AT, poll_seconds=None
        )
    )
    return B.scan_backup(spark, target).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("offset").alias("offsets"),
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.sum(H.old_offset()).alias("old_offsets"),
    )


def _files_of(spark, root):
    # the folders of segments are listed together, in one job, not in one for each topic-partition
    rows = spark.read.schema(B._schema(False, True)).option("basePath", root).parquet(f"{root}/topic=*/partition=*/batch_id=*")
    return rows.groupBy("topic", "partition", F.col("batch_id").alias("first_offset")).agg(
        F.count_distinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("records"),
        F.min("offset").alias("lowest"), F.max("offset").alias("last_offset"),
    )


@query
def write_segments(spark, sf_dir):
    root = scratch(spark, "segments")
    for _ in range(2):
        put_segments(D.event_log(spark, sf_dir), root, FILE_FLUSH)
    return _files_of(spark, root)


@query
def write_segments_mixed(spark, sf_dir):
    root = scratch(spark, "segments")
    put_segments(D.event_log(spark, sf_dir), root, FILE_FLUSH, 5 * DAY_MS)
    return _files_of(spark, root)


@query
def stream_segments(spark, sf_dir):
    def write(path):
        # the log as it grew: a topic-partition's older records are in older files
        for i in range(4):
            age = F.expr(f"timestamp >= {DAY0 + 8 * i * DAY_MS} AND timestamp < {DAY0 + 8 * (i + 1) * DAY_MS}")
            D.event_log(spark, sf_dir).filter(age).repartition(4, "topic", "partition").write.mode("append").parquet(path)

    root = scratch(spark, "segments")
    topics = [r.source_topic for r in D.event_topics(spark, sf_dir).collect()]
    source = stream_log(spark, D.once(spark, sf_dir, "grown", write), topics, max_per_trigger=3)
    finished(put_closed_segments(source, root, scratch(spark, "checkpoint"), FILE_FLUSH, 5 * DAY_MS, poll_seconds=None))
    return _files_of(spark, root)


@query
def merge_batches(spark, sf_dir):
    root, target = scratch(spark, "streamed"), scratch(spark, "merged")
    topics = [r.source_topic for r in D.event_topics(spark, sf_dir).collect()]
    source = stream_log(spark, exported(spark, sf_dir), topics, max_per_trigger=2)
    finished(T.stream_backup_sink(source, root, scratch(spark, "checkpoint"), poll_seconds=None))
    jobs.merge_batches(spark, root, target, FILE_FLUSH)
    return _files_of(spark, target)


@query
def backup_offset_log(spark, sf_dir):
    root = scratch(spark, "offsets")
    jobs.backup_offsets(D.commit_log(spark, sf_dir), root, GROUP.lower())
    return B.scan_backup(spark, root).select("partition", "offset", F.hex("key").alias("key"))


SEVERAL = "ev-click:one,ev-click:two,ev-view:one"


@query
def restore_positions(spark, sf_dir):
    return jobs.restore_positions(D.event_log(spark, sf_dir), SEVERAL)


@query
def restore_resumed_by_target(spark, sf_dir):
    log = B.scan_backup(spark, D.event_backup(spark, sf_dir))
    # one of the two targets of a topic had been restored up to the middle
    done = jobs.restore_positions(log.filter(F.col("timestamp") < MID), "ev-click:one,ev-view:one").filter(
        F.col("target_topic") == "one"
    )
    return flat(jobs.restore(log, SEVERAL, D.RESTORED_AT, done))


@query
def restore_from_backup(spark, sf_dir):
    return flat(jobs.restore_from(spark, D.event_backup(spark, sf_dir), MAP_TEXT, D.RESTORED_AT))


@query
def stream_backup(spark, sf_dir):
    root = scratch(spark, "streamed")
    topics = [r.source_topic for r in D.event_topics(spark, sf_dir).collect()]
    source = stream_log(spark, exported(spark, sf_dir), topics, max_per_trigger=4)
    finished(T.stream_backup_sink(source, root, scratch(spark, "checkpoint"), poll_seconds=None))
    return flat(B.scan_backup(spark, root))


@query
def stream_restore(spark, sf_dir):
    target = scratch(spark, "restored")
    log = D.event_log(spark, sf_dir)
    positions = log.filter(F.col("timestamp") < MID).groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))
    source = B.stream_backup(spark, D.event_backup(spark, sf_dir), max_files=8)
    finished(
        T.stream_restore(
            source, target, scratch(spark, "checkpoint"), MAP_TEXT, positions, D.RESTORED_AT, poll_seconds=None
        )
    )
    # the target gave new offsets; the old ones stay in a header
    return flat(B.scan_backup(spark, target).withColumn("offset", H.old_offset()))


@query
def stream_dedupe(spark, sf_dir):
    # eight files, each with records of all ages
    path = D.once(
        spark, sf_dir, "lines",
        lambda p: D.line_log(spark, sf_dir).repartition(8, F.xxhash64("offset", "timestamp", "key")).write.parquet(p),
    )
    out = scratch(spark, "deduped")
    lines = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    finished(T.stream_dedupe_sink(lines, out, scratch(spark, "checkpoint"), poll_seconds=None))
    return B.scan_backup(spark, out).select("topic", "partition", "offset")


@query
def stream_progress_marks(spark, sf_dir):
    marks = scratch(spark, "marks")
    source = spark.readStream.schema(LOG_SCHEMA).parquet(exported(spark, sf_dir))
    finished(T.stream_progress_marks(source, marks, scratch(spark, "checkpoint"), MARK_EVERY, poll_seconds=None))
    return T.announced_marks(spark, marks)
