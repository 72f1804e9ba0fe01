import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import headers as H
from tidelog.functions import names as N
from tidelog.functions.commits import (
    decode_offset_keys, decode_offset_values, encode_offset_key, encode_offset_value,
)
from tidelog.functions.envelopes import (
    MARKER, decode_envelopes, decode_record, encode_envelopes, encode_record, fingerprint,
)
from tidelog.operators import commits as C
from tidelog.operators import records as R
from tidelog.schema import LOG_COLUMNS
from tidelog.sources.sinks import assign_offsets


def text(s):
    b = s.encode()
    return struct.pack(">h", len(b)) + b


KEYS = {
    0: struct.pack(">h", 0) + text("grp") + text("top") + struct.pack(">i", 5),
    1: struct.pack(">h", 1) + text("grü") + text("") + struct.pack(">i", -1),
    2: struct.pack(">h", 2) + text("grp"),
}
VALUES = {
    0: struct.pack(">hq", 0, 7) + text("m") + struct.pack(">q", 11),
    1: struct.pack(">hq", 1, -7) + text("") + struct.pack(">qq", 12, 13),
    2: struct.pack(">hq", 2, 1 << 62) + text("meta") + struct.pack(">q", 14),
    3: struct.pack(">hqi", 3, 9, -1) + text("é") + struct.pack(">q", 15),
}


def binary(spark, rows, name):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {name} binary")


def test_offset_keys(spark):
    rows = [KEYS[0], KEYS[1], KEYS[2], KEYS[0][:-1], struct.pack(">h", 9), None, b"", b"\x00", KEYS[2][:4], struct.pack(">hh", 0, -1)]
    got = [(r.key_version, r.offset_key and tuple(r.offset_key)) for r in decode_offset_keys(binary(spark, rows, "key")).orderBy("i").collect()]
    assert got == [
        (0, ("grp", "top", 5)), (1, ("grü", "", -1)), (2, ("grp", None, None)),
        (0, None), (9, None), (None, None), (None, None), (None, None), (2, None), (0, None),
    ]


def test_offset_values(spark):
    rows = [*VALUES.values(), VALUES[1][:-1], struct.pack(">h", 9) + bytes(40), None, b"", struct.pack(">h", -1)]
    got = [(r.value_version, r.offset_value and tuple(r.offset_value)) for r in decode_offset_values(binary(spark, rows, "value")).orderBy("i").collect()]
    assert got == [
        (0, (7, None, "m", 11, None)), (1, (-7, None, "", 12, 13)), (2, (1 << 62, None, "meta", 14, None)),
        (3, (9, -1, "é", 15, None)), (1, None), (9, None), (None, None), (None, None), (-1, None),
    ]


def test_offset_codec_round_trip(spark):
    df = spark.range(400).select(
        (F.col("id") % 3).cast("int").alias("kv"), (F.col("id") % 4).cast("int").alias("vv"),
        F.concat(F.lit("gé"), F.repeat(F.lit("x"), F.col("id").cast("int"))).alias("g"),
        (F.hash("id").cast("bigint") * 4_000_000_007).alias("n"), F.hash("id").alias("p"),
    )
    coded = df.withColumn("key", encode_offset_key(F.col("g"), F.col("g"), F.col("p"), F.col("kv"))).withColumn(
        "value", encode_offset_value(F.col("n"), F.col("g"), F.col("n"), -F.col("n"), F.col("p"), F.col("vv"))
    )
    for r in decode_offset_values(decode_offset_keys(coded)).collect():
        assert tuple(r.offset_key) == ((r.g, r.g, r.p) if r.kv < 2 else (r.g, None, None))
        assert tuple(r.offset_value) == (
            r.n, r.p if r.vv == 3 else None, r.g, r.n, -r.n if r.vv == 1 else None
        )


def test_exclude_group_needs_both_to_decode(make_log):
    rows = [(KEYS[0], VALUES[0]), (KEYS[0], None), (KEYS[0], b"\x00\x09"), (KEYS[2], VALUES[3]), (b"zz", VALUES[0]), (None, None), (KEYS[1], VALUES[1])]
    log = make_log([{"offset": i, "key": k, "value": v} for i, (k, v) in enumerate(rows)])
    assert sorted(r.offset for r in R.exclude_group(log, "GRP").collect()) == [1, 2, 4, 5, 6]
    assert R.valid_offset_records(decode_offset_keys(log)).count() == 3


def test_committed_replays_the_log(spark, make_log):
    def row(offset, topic, committed, group="g"):
        key = struct.pack(">h", 1) + text(group) + text(topic) + struct.pack(">i", 0)
        value = None if committed is None else struct.pack(">hqi", 3, committed, 0) + text("") + struct.pack(">q", 0)
        return {"offset": offset, "topic": "__consumer_offsets", "key": key, "value": value}

    log = make_log([row(1, "a", 200), row(2, "a", 300), row(3, "a", 100), row(4, "b", 999), row(5, "a", None), row(6, "a", 7, "other")])
    assert [tuple(r) for r in C.committed_from_log(log, "g", "a").collect()] == [(0, 100)]
    assert [tuple(r) for r in C.committed_from_log(log, "g", "a", "max").collect()] == [(0, 300)]


def translated(spark, make_log, committed, policy):
    def record(partition, offset, old):
        headers = [("X-Old-Offset" if offset % 2 else "x-old-offset", str(o).encode()) for o in old]
        return {"partition": partition, "offset": offset, "headers": headers}

    restored = make_log(
        [record(0, i, [old]) for i, old in enumerate((10, 11, 15, 20))]
        + [record(1, 0, [1, 4]), record(1, 1, [5])]
        + [{"partition": 2, "offset": 0, "headers": None}]
    )
    wanted = spark.createDataFrame(committed, "partition int, committed bigint")
    return {r.partition: r.new_offset for r in C.translate_offsets(wanted, restored, policy).collect()}


@pytest.mark.parametrize(
    "policy,expected",
    [("exact", {0: 1, 1: 0}), ("exact_or_last", {0: 1, 1: 0}), ("first_at_or_after", {0: 1, 1: 0})],
)
def test_translate_hit(spark, make_log, policy, expected):
    # the header is given twice in partition 1: the last one, 4, counts; partition 2 has no stamps
    assert translated(spark, make_log, [(0, 11), (1, 4), (2, 0), (3, 0)], policy) == expected


@pytest.mark.parametrize("policy,gap,end", [("exact", {}, {}), ("exact_or_last", {0: 3}, {0: 3}), ("first_at_or_after", {0: 2}, {0: 4})])
def test_translate_gap_and_end(spark, make_log, policy, gap, end):
    assert translated(spark, make_log, [(0, 12)], policy) == gap
    assert translated(spark, make_log, [(0, 21)], policy) == end


def test_offset_source(spark):
    row = lambda n: spark.createDataFrame([(0, n)], "partition int, committed bigint")
    assert C.offset_source(row(1), row(2)).first().committed == 1
    assert C.offset_source(None, row(2), row(3)).first().committed == 2
    assert C.offset_source(live=row(3)).first().committed == 3
    for empty in ({}, {"backup": row(1).limit(0)}):
        with pytest.raises(ValueError):
            C.offset_source(**empty)


def test_starting_offsets(spark):
    rows = spark.createDataFrame([(10, 7), (2, 5)], "partition int, new_offset bigint")
    assert C.starting_offsets_json(rows, "a.b").first().starting_offsets == '{"a.b":{"2":5,"10":7}}'


def test_headers(make_log):
    log = make_log([
        {"offset": 0, "headers": [("a", b"1"), ("b", b"2"), ("a", b"3")]}, {"offset": 1, "headers": []}, {"offset": 2},
    ])
    rows = log.withColumns({"m": H.headers_map(), "has": H.has_headers()}).orderBy("offset").collect()
    assert rows[0].m == {"a": b"3", "b": b"2"} and [r.has for r in rows] == [True, False, False]
    stamped = H.stamp_restore_headers(H.add_header(log, "c", "x"), 99).orderBy("offset").collect()
    assert [(h.key, bytes(h.value)) for h in stamped[2].headers] == [("x-old-offset", b"2"), ("x-restored", b"99"), ("c", b"x")]
    assert [h.key for h in stamped[0].headers] == ["x-old-offset", "x-restored", "a", "b", "a", "c"]


def test_old_offset_of_bad_text(make_log):
    log = make_log([{"offset": 0, "headers": [("x-old-offset", b"abc")]}, {"offset": 1, "headers": [("x-old-offset", b" 12 ")]}, {"offset": 2}])
    assert [r[0] for r in log.orderBy("offset").select(H.old_offset()).collect()] == [-1, 12, -1]


def test_unwrap_java_objects(make_log):
    magic = bytes.fromhex("ACED0005")
    array = magic + bytes.fromhex("757200025B42ACF317F8060854E00200007870") + struct.pack(">i", 3) + b"abc"
    values = [
        magic + b"t" + struct.pack(">H", 2) + b"hi", magic + b"|" + struct.pack(">Q", 2) + b"yo", array,
        array[:-1], b"raw", b"", magic + b"sr", None,
    ]
    log = make_log([{"headers": [(str(i), v) for i, v in enumerate(values)]}])
    got = [h.value if h.value is None else bytes(h.value) for h in H.unwrap_legacy_headers(log).first().headers]
    assert got == [b"hi", b"yo", b"abc", array[:-1], b"raw", b"", magic + b"sr", None]


def test_null_conventions(make_log):
    log = make_log([{"offset": 0, "key": None, "value": b""}, {"offset": 1, "key": b"", "value": None}])
    old = R.encode_nulls(log)
    assert old.filter("key = X'' AND value = X''").count() == 2
    assert R.decode_nulls(old).filter("key IS NULL AND value IS NULL").count() == 2


def test_rename(spark, make_log):
    log = make_log([{"topic": t} for t in "abc"])
    names = lambda m: sorted(r.topic for r in R.rename_topics(log, m).collect())
    assert names("a:b,c:d") == ["b", "b", "d"] and names("a:b") == ["b", "b", "c"] and names("a") == ["a", "b", "c"]
    assert names(spark.createDataFrame([("a", "z")], "source_topic string, target_topic string")) == ["b", "c", "z"]
    assert names("a:x,a:y,b") == ["b", "c", "x", "y"]
    assert N.parse_topic_map("a:b, c,a:d,a:b") == {"a": ["b", "d"], "c": ["c"]}


def test_resume_in_two_halves(spark, skewed_log):
    first = skewed_log.filter("offset < 30000 AND topic <> 't1'")
    positions = first.groupBy("topic", "partition").agg(F.max("offset").alias("last_offset"))
    rest = R.resume_after(skewed_log, positions)
    assert first.count() + rest.count() == 20_000
    assert first.select("topic", "partition", "offset").unionByName(rest.select("topic", "partition", "offset")).distinct().count() == 20_000


def test_dedupe_and_cap(make_log):
    log = make_log([{"partition": p, "offset": o} for p in (1, 0) for o in (2, 1, 1)])
    assert R.dedupe_log(log).count() == 4
    assert [(r.partition, r.offset) for r in R.batch_cap(R.dedupe_log(log), 3).collect()] == [(0, 1), (0, 2), (1, 1)]


def test_polls_hold_every_record(skewed_log):
    polls = R.poll_batches(skewed_log, 900).select("topic", "partition", "offset", "poll").collect()
    order = sorted((r.topic, r.partition, r.offset) for r in polls)
    assert {(r.topic, r.partition, r.offset): r.poll for r in polls} == {x: i // 900 for i, x in enumerate(order)}


def test_segment_names(spark):
    rows = spark.createDataFrame([("a-b", 0, 7), ("t", 12, 10**16)], "topic string, partition int, o bigint")
    plain = [r[0] for r in rows.select(N.segment_name("topic", "partition", "o")).collect()]
    assert plain == ["a-b/0/a-b-0-000000000000007.avro", "t/12/t-12-10000000000000000.avro"]
    named = rows.select(N.segment_name("topic", "partition", "o", F.lit("gen"), pad=3).alias("path"))
    got = [tuple(r)[1:] for r in N.parse_segment_path(named).collect()]
    assert got == [("a-b", "gen", 0, 7), ("t", "gen", 12, 10**16)]
    lead = N.parse_segment_path(rows.select(F.concat(F.lit("s3://store/x/"), N.segment_name("topic", "partition", "o")).alias("path")))
    assert lead.filter("generation IS NULL AND topic IN ('a-b', 't')").count() == 2


def test_offset_spec(spark):
    spec = lambda s: N.parse_offset_spec(spark.createDataFrame([(s,)], "spec string"))
    assert sorted(map(tuple, spec("0:10,1:100,0:11").collect())) == [(0, 11), (1, 100)]
    with pytest.raises(Exception, match="partition:offset"):
        spec("7").collect()


def test_topic_pair(spark):
    rows = spark.createDataFrame([("a:b",), ("a",)], "t string").select(N.parse_topic_pair("t").alias("p")).collect()
    assert [tuple(r.p) for r in rows] == [("a", "b"), ("a", "a")]


optional_bytes = st.none() | st.binary(max_size=200)


@settings(max_examples=200, deadline=None)
@given(
    st.text(max_size=20), st.integers(0, 2**31 - 1), st.integers(-(2**63), 2**63 - 1), st.integers(-(2**63), 2**63 - 1),
    optional_bytes, optional_bytes, st.none() | st.dictionaries(st.text(max_size=5), st.binary(max_size=9)),
)
def test_envelope_codec(topic, partition, offset, timestamp, key, value, headers):
    row = (topic, partition, offset, timestamp, key, value, None if headers is None else list(headers.items()))
    data = encode_record(*row)
    assert decode_record(data) == row and decode_record(MARKER + bytes(8) + data) == row
    assert decode_record(data[:-1]) is None


def test_envelope_against_avro(spark, make_log):
    """The JVM's Avro reads our bytes, and agrees on the fingerprint."""
    import json

    from tidelog.functions.envelopes import ENVELOPE

    avro = spark._jvm.org.apache.avro
    schema = avro.Schema.Parser().parse(json.dumps(ENVELOPE))
    log = make_log([{"offset": 5, "key": None, "value": b"\x00\xff", "headers": [("a", b"1"), ("a", b"2")]}, {"offset": -1}])
    coded = encode_envelopes(log)
    crc = avro.SchemaNormalization.parsingFingerprint64(schema) & (2**64 - 1)
    assert fingerprint() == struct.pack("<Q", crc)
    for row in coded.collect():
        data = bytes(row.envelope)
        assert data[:10] == MARKER + fingerprint()
        reader = avro.generic.GenericDatumReader(schema)
        record = reader.read(None, avro.io.DecoderFactory.get().binaryDecoder(data[10:], None))
        assert record.get("offset") == row.offset and record.get("topic").toString() == "t"
    back = decode_envelopes(coded.select("envelope")).select("record.*").orderBy("offset").collect()
    assert [r.offset for r in back] == [-1, 5] and back[1].key is None and bytes(back[1].value) == b"\x00\xff"
    assert [(h.key, bytes(h.value)) for h in back[1].headers] == [("a", b"2")] and back[0].headers is None


def test_null_timestamps_keep_wide_integers(make_log):
    big = 2**60 + 1
    log = make_log([{"offset": big, "timestamp": None}, {"offset": big + 1, "timestamp": big}])
    back = decode_envelopes(encode_envelopes(log).select("envelope")).select("record.*").orderBy("offset").collect()
    assert [r.offset for r in back] == [big, big + 1] and back[1].timestamp == big


def test_kafka_shape(spark):
    kafka = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, offset bigint").withColumns(
        {"timestamp": F.timestamp_millis(F.lit(1234)), "key": F.lit(b"k"), "value": F.lit(None).cast("binary"), "timestampType": F.lit(0)}
    )
    row = R.to_envelope(kafka).first()
    assert row.timestamp == 1234 and row.value is None and list(row.asDict()) == LOG_COLUMNS


def test_assigned_offsets_continue(spark, make_log):
    log = make_log([{"partition": p, "offset": o} for p in (0, 1) for o in (4, 9)])
    ends = spark.createDataFrame([("t", 1, 100)], "topic string, partition int, next_offset bigint")
    assert sorted((r.partition, r.offset) for r in assign_offsets(log, ends).collect()) == [(0, 0), (0, 1), (1, 100), (1, 101)]


def test_offset_index(spark, make_log):
    log = make_log([{"offset": o, "value": b"x" if o % 2 else None} for o in range(10)])
    restored = assign_offsets(H.stamp_restore_headers(R.rename_topics(log.filter("value IS NOT NULL"), "t:n"), 0))
    mapping = spark.createDataFrame([("t", "n")], "source_topic string, target_topic string")
    got = sorted((r.old_offset, r.new_offset, r.new_topic) for r in C.offset_index(log, restored, mapping).collect())
    assert got == [(1, 0, "n"), (3, 1, "n"), (5, 2, "n"), (7, 3, "n"), (9, 4, "n")]


def test_positions_per_target(spark, make_log):
    from tidelog.plans import jobs

    log = make_log([{"topic": t, "offset": o} for t in ("a", "b") for o in range(4)])
    done = jobs.restore_positions(log.filter("offset < 2"), "a:x,b:x").filter("source_topic = 'a'")
    got = sorted((r.topic, r.offset) for r in jobs.restore(log, "a:x,a:y,b:x", 0, done).collect())
    # a is continued in x and starts in y; b, which goes to x too, has no position of its own
    assert got == sorted([("x", 2), ("x", 3)] + [("y", o) for o in range(4)] + [("x", o) for o in range(4)])


def test_losses_are_named(make_log):
    from tidelog.functions.envelopes import envelope_losses

    log = make_log([
        {"offset": 0}, {"offset": 1, "timestamp": None}, {"offset": 2, "headers": [("a", b"1"), ("a", b"2")]},
        {"offset": 3, "headers": [("a", None)]}, {"offset": 4, "headers": [("a", b""), ("b", b"")]},
    ])
    got = {r.offset: (r.timestamp, r.null_header, r.repeated_header) for r in envelope_losses(log).collect()}
    assert got == {1: (True, False, False), 2: (False, False, True), 3: (False, True, False)}
