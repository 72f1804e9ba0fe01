"""The catalog's queries as SQL over the driver's tables."""

FLUSH, FILE_FLUSH, SCHEDULE_MS, INTERVAL_MS, MARK_EVERY = 50, 200, 25_200_000, 10_800_000, 100
DAY0, DAY_MS = 1_704_067_200_000, 86_400_000
MID = DAY0 + 15 * DAY_MS
NOW = 1_735_689_600_000

EV = """ev AS (
  SELECT 'ev-' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
         epoch_us(ts) // 1000 AS "timestamp", CAST(user_id AS VARCHAR) AS k,
         CASE WHEN value >= 5 THEN props END AS v,
         'event.id=' || hex(CAST(event_id AS VARCHAR)) || ';seq=31;seq=32' AS headers
  FROM events)"""
ORD = """od AS (
  SELECT 'or-' || o_orderstatus AS topic, CAST(o_custkey % 8 AS INTEGER) AS "partition",
         o_orderkey AS "offset", epoch_us(o_orderdate) // 1000 AS "timestamp" FROM orders)"""
CM = """cm AS (
  SELECT 'Grp-' || (user_id % 7) AS g, 'ev-' || event_type AS t, CAST(user_id % 4 AS INTEGER) AS p,
         CAST(user_id % 7 % 3 AS INTEGER) AS lp, event_id AS o, event_type AS meta,
         CAST(user_id - 10 AS INTEGER) AS epoch, epoch_us(ts) // 1000 AS ms,
         CAST(CASE event_id % 10 WHEN 0 THEN 2 WHEN 1 THEN 9 ELSE event_id % 2 END AS INTEGER) AS kv,
         CAST(CASE event_id % 6 WHEN 5 THEN 7 WHEN 4 THEN NULL ELSE event_id % 6 END AS INTEGER) AS vv
  FROM events)"""
LAST = CM + """, lc AS (
  SELECT g AS group_id, t AS topic, p AS "partition", arg_max(o, lp * 1000000000000 + o) AS committed,
         max(o) AS largest
  FROM cm WHERE kv IN (0, 1) AND vv <= 3 GROUP BY g, t, p)"""
RES = EV + """, res AS (
  SELECT 'r-' || substr(topic, 4) AS topic, "partition", topic AS old_topic, "offset" AS old_offset, "timestamp",
         row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS new_offset
  FROM ev WHERE v IS NOT NULL)"""
PAIRS = "WITH " + RES + ", " + LAST + """, tr AS (
  SELECT topic, "partition", min(CASE WHEN old_offset = committed THEN new_offset END) AS hit,
         max(new_offset) AS newest, min(CASE WHEN old_offset >= committed THEN new_offset END) AS later
  FROM res JOIN (SELECT 'r-' || substr(topic, 4) AS topic, "partition", committed FROM lc WHERE group_id = 'Grp-3')
       USING (topic, "partition") GROUP BY topic, "partition")"""

ROW = """topic, "partition", "offset", "timestamp", hex(k) AS key, hex(v) AS value, headers"""
EV_ROWS = f"WITH {EV} SELECT {ROW} FROM ev"
RENAMED = """CASE topic WHEN 'ev-click' THEN 'new-click' WHEN 'ev-view' THEN 'new-view' ELSE topic END"""
STAMP = f"""'x-old-offset=' || hex(CAST("offset" AS VARCHAR)) || ';x-restored=' || hex('{NOW}') || ';' || headers"""
ROW_RESTORED = f"""{RENAMED} AS topic, "partition", "offset", "timestamp", hex(k) AS key, hex(v) AS value, {STAMP} AS headers"""

BY_COUNT = """(row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) // {n}"""
SEG = f"""WITH {EV}, sg AS (SELECT *, {BY_COUNT.format(n=FLUSH)} AS segment_id FROM ev)"""
BUCKET = """({t} - ({t} % 86400000) % {ms})"""


def mixed(cte, table, flush, ms):
    return f"""WITH {cte}, ar AS (
      SELECT *, max("timestamp") OVER (PARTITION BY topic, "partition" ORDER BY "offset"
                ROWS UNBOUNDED PRECEDING) AS a FROM {table}),
    bk AS (SELECT *, {BUCKET.format(t='a', ms=ms)} AS b FROM ar),
    sg AS (SELECT *, CAST(b AS VARCHAR) || '-' || CAST((row_number() OVER (
             PARTITION BY topic, "partition", b ORDER BY "offset") - 1) // {flush} AS VARCHAR) AS segment_id FROM bk)"""


def manifest(name):
    pad = """lpad(CAST(min("offset") AS VARCHAR), greatest(15, length(CAST(min("offset") AS VARCHAR)))::INTEGER, '0')"""
    return f"""SELECT topic, "partition", segment_id, min("offset") AS first_offset, max("offset") AS last_offset,
        count(*) AS records, arg_max("timestamp", "offset") AS last_timestamp, max("timestamp") AS max_timestamp,
        topic || '/' || {name}"partition" || '/' || topic || '-' || "partition" || '-' || {pad} || '.avro' AS name
      FROM sg GROUP BY topic, "partition", segment_id"""


def commits(flush, last_seen="0", passed="false"):
    return f""", mf AS (SELECT topic, "partition", min("offset") AS f, max("offset") AS l, count(*) AS n,
                 {last_seen} AS a
                 FROM sg GROUP BY topic, "partition", segment_id),
    nw AS (SELECT topic, "partition", max(f) AS nf FROM mf GROUP BY 1, 2)
    SELECT topic, "partition", max(CASE WHEN f < nf OR n >= {flush} OR {passed} THEN l END) + 1 AS commit_offset
    FROM mf JOIN nw USING (topic, "partition") GROUP BY 1, 2"""


def greedy(source, x, width):
    """First position, then each first position at least ``width`` after the one before."""
    return f"""WITH RECURSIVE {source}, st AS (
      SELECT topic, "partition", min({x}) AS s FROM pos GROUP BY 1, 2
      UNION ALL
      SELECT st.topic, st."partition", min(pos.{x}) FROM st JOIN pos
        ON pos.topic = st.topic AND pos."partition" = st."partition" AND pos.{x} >= st.s + {width}
      GROUP BY st.topic, st."partition")"""


ARRIVAL = EV + """, pos AS (
  SELECT topic, "partition", "offset", max("timestamp") OVER (
    PARTITION BY topic, "partition" ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS a FROM ev)"""

LATEST = f"""WITH {EV}, lt AS (SELECT *, row_number() OVER (
  PARTITION BY topic, "partition", k ORDER BY "offset" DESC) AS r FROM ev)"""

POSITIONS = f"""ps AS (SELECT topic, "partition", max("offset") AS last_offset FROM ev
  WHERE "timestamp" < {MID} AND topic <> 'ev-error' GROUP BY 1, 2)"""

DOC = """doc AS (
  SELECT 'doc/' || lpad(CAST(doc_id AS VARCHAR), 18, '0') AS path, hex(encode(text)) AS h,
         (octet_length(encode(text)) + 999) // 1000 AS n FROM documents)"""
CHUNKS = DOC + """, ck AS (
  SELECT path, n, unnest(range(n)) AS pos, h FROM doc WHERE n > 0),
  ms AS (SELECT path, n, pos, substr(h, CAST(2000 * pos + 1 AS BIGINT), 2000) AS c FROM ck)"""
SPREAD = "WITH " + CHUNKS + """, ix AS (SELECT path, pos, row_number() OVER (ORDER BY path, pos) - 1 AS i FROM ms),
  sp AS (SELECT *, CAST(CASE WHEN i % 7 < 4 THEN 0 ELSE i % 7 - 3 END AS INTEGER) AS p FROM ix)"""

POLICY = """pol AS (
  SELECT 'job-rule-' || n_name AS rule_id, n_name AS topic, CASE WHEN n_regionkey = 0 THEN 'gen-a' END AS generation,
         CAST(n_nationkey AS INTEGER) AS days, n_regionkey <> 4 AS enabled FROM nation)"""

ORACLE = {
    # sources
    "read_log_from": EV_ROWS + """ WHERE topic IN ('ev-click', 'ev-view')
        AND NOT (topic = 'ev-click' AND "partition" = 0 AND "offset" < 500)
        AND NOT (topic = 'ev-click' AND "partition" = 2 AND "offset" < 900)""",
    "scan_backup": EV_ROWS,
    "scan_topic": EV_ROWS + " WHERE topic = 'ev-click'",
    "scan_partition": EV_ROWS + """ WHERE topic = 'ev-click' AND "partition" = 2""",
    "lookup_record": EV_ROWS + """ WHERE topic = 'ev-click' AND "partition" = 2 AND "offset" = 1""",
    "scan_time_range": EV_ROWS + f""" WHERE topic = 'ev-view' AND "partition" = 1
        AND "timestamp" BETWEEN {DAY0 + 5 * DAY_MS} AND {DAY0 + 10 * DAY_MS}""",
    "scan_offset_range": EV_ROWS + """ WHERE topic = 'ev-view' AND "partition" = 1 AND "offset" BETWEEN 100 AND 5000""",
    "scan_generation": LATEST + f" SELECT {ROW} FROM lt WHERE r = 1 AND v IS NOT NULL AND topic = 'ev-click'",
    "backup_inventory": f"""WITH {EV} SELECT topic AS source_topic, {RENAMED} AS target_topic,
        count(DISTINCT "partition") AS partitions,
        string_agg(DISTINCT CAST("partition" AS VARCHAR), ',' ORDER BY CAST("partition" AS VARCHAR)) AS ids
        FROM ev GROUP BY topic""",
    "check_layout": f"""WITH {EV}, tp AS (SELECT DISTINCT topic FROM ev)
        SELECT topic, 'gen-a' AS generation, true AS ok FROM tp
        UNION ALL SELECT topic, 'none', false FROM tp""",
    # record transforms
    "to_envelope": EV_ROWS,
    "select_topics": EV_ROWS + " WHERE topic IN ('ev-click', 'ev-error')",
    "headers_last_wins": f"""WITH {EV} SELECT topic, "partition", "offset", CAST(3 AS INTEGER) AS names,
        CAST("offset" AS VARCHAR) AS event_id, '2' AS seq, topic AS type, true AS has_headers FROM ev""",
    "encode_nulls": f"""WITH {EV} SELECT topic, "partition", "offset", "timestamp", hex(k) AS key,
        coalesce(hex(v), '') AS value, headers FROM ev""",
    "decode_nulls": EV_ROWS,
    "route": f"""WITH {EV} SELECT 'topic=' || topic || ';partition=' || "partition" AS route, count(*) AS records
        FROM ev GROUP BY 1""",
    "rename_topics": f"""WITH {EV} SELECT {RENAMED} AS topic, "partition", "offset", "timestamp",
        hex(k) AS key, hex(v) AS value, headers FROM ev""",
    "rename_topics_by_table": f"""WITH {EV} SELECT 'copy-' || substr(topic, 4) AS topic, "partition", "offset",
        "timestamp", hex(k) AS key, hex(v) AS value, headers FROM ev""",
    "stamp_headers": f"""WITH {EV} SELECT topic, "partition", "offset", "timestamp", hex(k) AS key, hex(v) AS value,
        {STAMP} AS headers FROM ev""",
    "old_offset": f"""WITH {EV} SELECT topic, "partition", "offset", "offset" AS old_offset FROM ev""",
    "unwrap_legacy_headers": EV_ROWS,
    "envelope_roundtrip": f"""WITH {EV} SELECT topic, "partition", "offset", "timestamp", hex(k) AS key,
        hex(v) AS value, replace(headers, ';seq=31', '') AS headers FROM ev""",
    "parse_segment_path": SEG + ", mf AS (" + manifest("'gen-a/' || ") + """)
        SELECT name, topic, 'gen-a' AS generation, "partition", first_offset FROM mf""",
    "parse_offset_spec": f"""WITH {LAST} SELECT topic, "partition", max(committed) AS committed FROM lc GROUP BY 1, 2""",
    "parse_topic_pair": """SELECT event_type AS source_topic,
        CASE WHEN event_type = 'view' THEN event_type ELSE 'r-' || event_type END AS target_topic,
        count(*) AS records FROM events GROUP BY 1, 2""",
    # filters, resume, order
    "exclude_group": f"""WITH {CM} SELECT lp AS "partition", o AS "offset",
        lpad(hex(kv), 4, '0') || lpad(hex(length(g)), 4, '0') || hex(g) || CASE WHEN kv = 2 THEN ''
          ELSE lpad(hex(length(t)), 4, '0') || hex(t) || lpad(hex(p), 8, '0') END AS key
        FROM cm WHERE NOT (g = 'Grp-3' AND kv <= 2 AND coalesce(vv <= 3, false))""",
    "valid_offset_records": f"""WITH {CM} SELECT o AS "offset", g AS "group", t AS topic, p AS of_partition
        FROM cm WHERE kv IN (0, 1)""",
    "resume_after": f"""WITH {EV}, {POSITIONS} SELECT {ROW} FROM ev LEFT JOIN ps USING (topic, "partition")
        WHERE last_offset IS NULL OR "offset" > last_offset""",
    "dedupe_log": """SELECT DISTINCT 'li-' || l_returnflag AS topic, CAST(l_orderkey % 8 AS INTEGER) AS "partition",
        l_orderkey * 8 + l_linenumber AS "offset" FROM lineitem""",
    "batch_cap": EV_ROWS + """ WHERE topic = 'ev-click' ORDER BY "partition", "offset" LIMIT 100""",
    "restore_order": EV_ROWS,
    "union_topics": f"""WITH {EV}, {ORD} SELECT topic, "partition", count(*) AS records, max("offset") AS last_offset
        FROM (SELECT topic, "partition", "offset" FROM ev UNION ALL SELECT topic, "partition", "offset" FROM od)
        GROUP BY 1, 2""",
    "restore_job": f"WITH {EV} SELECT {ROW_RESTORED} FROM ev",
    # offset log and translation
    "decode_offset_keys": f"""WITH {CM} SELECT o AS "offset", kv AS key_version,
        CASE WHEN kv <= 2 THEN g END AS group_id, CASE WHEN kv < 2 THEN t END AS of_topic,
        CASE WHEN kv < 2 THEN p END AS of_partition FROM cm""",
    "decode_offset_values": f"""WITH {CM} SELECT o AS "offset", vv AS value_version,
        CASE WHEN vv <= 3 THEN o END AS committed, CASE WHEN vv = 3 THEN epoch END AS leader_epoch,
        CASE WHEN vv <= 3 THEN meta END AS metadata, CASE WHEN vv <= 3 THEN ms END AS commit_timestamp,
        CASE WHEN vv = 1 THEN ms + 86400000 END AS expire_timestamp FROM cm""",
    "committed_last": f"""WITH {LAST} SELECT group_id, topic, "partition", committed FROM lc""",
    "committed_max": f"""WITH {LAST} SELECT group_id, topic, "partition", largest AS committed FROM lc""",
    "committed_from_log": f"""WITH {LAST} SELECT "partition", committed FROM lc
        WHERE group_id = 'Grp-3' AND topic = 'ev-click'""",
    "committed_from_table": """SELECT CAST(user_id % 4 AS INTEGER) AS "partition", max(event_id) AS committed
        FROM events WHERE user_id % 7 = 3 AND event_type = 'click' GROUP BY 1""",
    "offset_source": f"""WITH {LAST} SELECT "partition", committed FROM lc
        WHERE group_id = 'Grp-3' AND topic = 'ev-view'""",
    "translate_exact": PAIRS + """ SELECT topic, "partition", hit AS new_offset FROM tr WHERE hit IS NOT NULL""",
    "translate_or_last": PAIRS + """ SELECT topic, "partition", coalesce(hit, newest) AS new_offset FROM tr""",
    "translate_asof": PAIRS + """ SELECT topic, "partition", coalesce(later, newest + 1) AS new_offset FROM tr""",
    "starting_offsets": PAIRS + """ SELECT topic, '{"' || topic || '":{' || string_agg('"' || "partition" || '":' ||
        coalesce(later, newest + 1), ',' ORDER BY "partition") || '}}' AS starting_offsets FROM tr GROUP BY topic""",
    "translate_job": PAIRS + """ SELECT "partition", coalesce(later, newest + 1) AS new_offset
        FROM tr WHERE topic = 'r-click'""",
    "offset_index": f"""WITH {RES} SELECT old_topic, "partition" AS old_partition, old_offset,
        "timestamp" AS old_timestamp, topic AS new_topic, "partition" AS new_partition, new_offset,
        "timestamp" AS new_timestamp FROM res""",
    # segments
    "segment_by_count": SEG + """ SELECT topic, "partition", "offset", segment_id FROM sg""",
    "segment_by_schedule": f"""WITH {EV} SELECT topic, "partition", "offset",
        {BUCKET.format(t='"timestamp"', ms=SCHEDULE_MS)} AS segment_id FROM ev""",
    "segment_mixed": mixed(EV, "ev", 20, SCHEDULE_MS) + """ SELECT topic, "partition", "offset", segment_id FROM sg""",
    "segment_mixed_late": mixed(ORD, "od", FLUSH, DAY_MS) + """ SELECT topic, "partition", "offset", segment_id FROM sg""",
    "segment_by_interval": greedy(ARRIVAL, "a", INTERVAL_MS) + """ SELECT pos.topic, pos."partition", pos."offset",
        st.s AS segment_id FROM pos ASOF JOIN st
        ON pos.topic = st.topic AND pos."partition" = st."partition" AND pos.a >= st.s""",
    "segment_manifest": SEG + " " + manifest(""),
    "commit_offsets": SEG + commits(FLUSH),
    "commit_offsets_mixed": mixed(EV, "ev", 20, SCHEDULE_MS) + commits(20),
    # compaction and generations
    "latest_per_key": LATEST + f" SELECT {ROW} FROM lt WHERE r = 1 AND v IS NOT NULL",
    "latest_with_tombstones": LATEST + f" SELECT {ROW} FROM lt WHERE r = 1",
    "apply_events": """WITH co AS (
        SELECT 'inst' || (user_id % 13) || '-activate-' || (user_id % 4) AS key, value,
          CASE event_type WHEN 'click' THEN 'PASSIVATE' WHEN 'view' THEN NULL ELSE 'ACTIVATE' END AS event,
          CAST(CASE WHEN value > 200 THEN 9 ELSE user_id % 4 END AS INTEGER) AS p, user_id % 4 AS kp,
          event_id AS o, epoch_us(ts) // 1000 AS ms FROM events),
        rk AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o DESC) AS r FROM co
          WHERE event IS NULL OR (event = 'ACTIVATE' AND p = kp))
        SELECT CASE WHEN value > 100 THEN upper(key) ELSE key END AS key, event, key AS "connectorInstanceName",
          'ev-data' AS topic, p AS "partition", o AS "offset", ms AS "timestamp", o AS log_offset
        FROM rk WHERE r = 1 AND event IS NOT NULL""",
    "caught_up": f"""WITH {EV}, tp AS (SELECT topic, "partition", max("offset") AS target,
          max(CASE WHEN v IS NOT NULL THEN "offset" END) AS written FROM ev GROUP BY 1, 2)
        SELECT topic, count(*) AS partitions, count(*) FILTER (written >= target) AS reached,
          bool_and(coalesce(written >= target, false)) AS complete FROM tp GROUP BY topic""",
    "progress_marks": greedy(EV + """, pos AS (SELECT topic, "partition", "offset" AS x FROM ev)""", "x", MARK_EVERY + 1)
    + """ SELECT topic, "partition", s AS "offset" FROM st""",
    "coordination_events": f"""WITH {EV} SELECT 'backup-passivate-' || "partition" AS key, 'ACTIVATE' AS event,
        'backup-passivate-' || "partition" AS "connectorInstanceName", topic, "partition", max("offset") AS "offset",
        {NOW} AS "timestamp" FROM ev GROUP BY topic, "partition" """,
    "generation_due": f"""SELECT o_orderstatus AS topic, max(epoch_us(o_orderdate) // 1000) AS started_ms,
        {DAY0} > max(epoch_us(o_orderdate) // 1000) + 21600000 AS due FROM orders GROUP BY 1""",
    "promote_generation": f"""WITH {EV}, tp AS (SELECT topic, "partition", max("offset") AS target,
          max(CASE WHEN v IS NOT NULL THEN "offset" END) AS written FROM ev GROUP BY 1, 2)
        SELECT topic, CASE WHEN bool_and(coalesce(written >= target, false)) THEN 'gen-b' ELSE 'gen-a' END AS generation
        FROM tp GROUP BY topic""",
    "drop_generation_of_topic": f"""WITH {EV} SELECT topic, generation, "partition", count(*) AS records
        FROM ev, (SELECT unnest(['gen-a', 'gen-b']) AS generation)
        WHERE NOT (topic = 'ev-click' AND generation = 'gen-a')
          AND NOT (topic = 'ev-view' AND generation = 'gen-b' AND "partition" = 1) GROUP BY 1, 2, 3""",
    # retention
    "upsert_policy": f"""WITH {POLICY}, up AS (SELECT generation, min(topic) AS topic FROM pol GROUP BY generation)
        SELECT * FROM pol WHERE topic NOT IN (SELECT topic FROM up)
        UNION ALL SELECT 'JOB-RULE-' || topic, topic, generation, CAST(90 AS INTEGER), true FROM up""",
    "policy_scope": f"""WITH {POLICY} SELECT rule_id,
        topic || '/' || coalesce(generation || '/', '') AS scope FROM pol""",
    "expire_files": f"""WITH {EV} SELECT DISTINCT topic, "partition" FROM ev WHERE topic NOT IN ('ev-click', 'ev-view')""",
    "expire_records": f"""WITH {EV}, sg AS (SELECT *, {BY_COUNT.format(n=100)} AS segment_id FROM ev),
        ws AS (SELECT *, max("timestamp") OVER (PARTITION BY topic, "partition", segment_id) AS last_ts,
                 max(segment_id) OVER (PARTITION BY topic, "partition") AS newest FROM sg)
        SELECT topic, "partition", "offset", segment_id FROM ws
        WHERE last_ts >= {DAY0 + 20 * DAY_MS} OR segment_id = newest""",
    # generator
    "chunk_files": f"WITH {CHUNKS} SELECT path, pos, md5(c) AS digest FROM ms",
    "repeat_to": f"""WITH {DOC}, rp AS (SELECT path, h, n, unnest(range((6 // n + 1) * n)) AS pos FROM doc WHERE n > 0)
        SELECT path, pos, md5(substr(h, CAST(2000 * (pos % n) + 1 AS BIGINT), 2000)) AS digest FROM rp""",
    "weighted_round_robin": SPREAD + """ SELECT path, pos, i AS "index", p AS "partition" FROM sp""",
    "message_numbers": SPREAD + """ SELECT 'generated' AS topic, p AS "partition", i AS "offset",
        hex(substr(path, 5)) AS key,
        CAST(row_number() OVER (PARTITION BY p ORDER BY i) AS VARCHAR) AS number FROM sp""",
    "watch_files": """SELECT lang, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS bytes,
        md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS digest FROM documents GROUP BY lang""",
    # sinks and streams
    "write_log_table": f"""WITH {EV} SELECT {RENAMED} AS topic, "partition",
        row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS "offset", "timestamp",
        hex(k) AS key, hex(v) AS value, {STAMP} AS headers FROM ev""",
    "stream_backup": EV_ROWS,
    "stream_restore": f"""WITH {EV}, ps AS (SELECT topic, "partition", max("offset") AS last_offset FROM ev
        WHERE "timestamp" < {MID} GROUP BY 1, 2)
        SELECT {ROW_RESTORED} FROM ev LEFT JOIN ps USING (topic, "partition")
        WHERE last_offset IS NULL OR "offset" > last_offset""",
}
TARGETS = """tg AS (SELECT * FROM (VALUES ('ev-click', 'one'), ('ev-click', 'two'), ('ev-view', 'one')) t(topic, target))"""
ORACLE["restore_positions"] = f"""WITH {EV}, {TARGETS} SELECT topic AS source_topic, coalesce(target, topic) AS target_topic,
    "partition", max("offset") AS last_offset FROM ev LEFT JOIN tg USING (topic) GROUP BY 1, 2, 3"""
ORACLE["restore_resumed_by_target"] = f"""WITH {EV}, {TARGETS}, ps AS (
      SELECT topic, 'one' AS target, "partition", max("offset") AS last_offset FROM ev
      WHERE "timestamp" < {MID} AND topic IN ('ev-click', 'ev-view') GROUP BY 1, 3),
    rn AS (SELECT ev.*, coalesce(target, topic) AS target FROM ev LEFT JOIN tg USING (topic))
    SELECT target AS topic, "partition", "offset", "timestamp", hex(k) AS key, hex(v) AS value, {STAMP} AS headers
    FROM rn LEFT JOIN ps USING (topic, target, "partition") WHERE last_offset IS NULL OR "offset" > last_offset"""
ORACLE["import_avro_segments"] = ORACLE["envelope_roundtrip"]
ORACLE["scan_avro_backup"] = EV_ROWS + " WHERE topic IN ('ev-click', 'ev-view')"
ORACLE["replayed_batch"] = EV_ROWS
ORACLE["backup_offset_log"] = ORACLE["exclude_group"]
ORACLE["restore_from_backup"] = ORACLE["restore_job"] + " WHERE topic IN ('ev-click', 'ev-view', 'ev-error')"
NOW_IDLE = DAY0 + 30 * DAY_MS - SCHEDULE_MS // 2
ORACLE["commit_offsets_idle"] = mixed(EV, "ev", 20, SCHEDULE_MS) + commits(
    20, "max(a)", f"{BUCKET.format(t=NOW_IDLE, ms=SCHEDULE_MS)} > {BUCKET.format(t='a', ms=SCHEDULE_MS)}"
)
ORACLE["stream_dedupe"] = ORACLE["dedupe_log"]
ORACLE["stream_progress_marks"] = ORACLE["progress_marks"]
ORACLE["poll_batches"] = f"""WITH {EV} SELECT topic, "partition", "offset",
    (row_number() OVER (ORDER BY topic, "partition", "offset") - 1) // 100 AS poll FROM ev"""
ORACLE["read_log_latest"] = EV_ROWS + """ WHERE topic IN ('ev-click', 'ev-view', 'ev-error')
    AND NOT (topic = 'ev-click' AND "partition" = 0)
    AND NOT (topic = 'ev-view' AND "partition" = 0 AND "offset" < 500)
    AND NOT (topic = 'ev-view' AND "partition" = 1 AND "offset" >= 900)"""
ORACLE["segment_null_clock"] = f"""WITH {EV}, lt AS (
      SELECT topic, "partition", "offset", CASE WHEN "offset" >= 400 AND "offset" % 9 <> 0 THEN "timestamp" END AS t FROM ev),
    ar AS (SELECT *, max(t) OVER (PARTITION BY topic, "partition" ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS a FROM lt),
    bk AS (SELECT *, coalesce(CAST({BUCKET.format(t='a', ms=SCHEDULE_MS)} AS VARCHAR), 'none') AS b FROM ar)
    SELECT topic, "partition", "offset", b || '-' || CAST((row_number() OVER (
      PARTITION BY topic, "partition", b ORDER BY "offset") - 1) // 20 AS VARCHAR) AS segment_id FROM bk"""
ORACLE["expire_unknown_age"] = f"""WITH {EV}, sg AS (SELECT topic, "partition", "offset",
        CASE WHEN topic NOT IN ('ev-view', 'ev-error') THEN "timestamp" END AS t, {BY_COUNT.format(n=100)} AS segment_id FROM ev),
    ws AS (SELECT *, max(t) OVER (PARTITION BY topic, "partition", segment_id) AS last_ts,
             max(segment_id) OVER (PARTITION BY topic, "partition") AS newest FROM sg)
    SELECT topic, "partition", "offset", segment_id FROM ws
    WHERE last_ts IS NULL OR last_ts >= {DAY0 + 20 * DAY_MS} OR segment_id = newest"""
ORACLE["expire_files_by_age"] = LATEST + """ SELECT DISTINCT topic, "partition" FROM lt
    WHERE r = 1 AND v IS NOT NULL AND topic <> 'ev-click' AND "partition" + length(topic) > 9"""
ORACLE["backup_repeated"] = EV_ROWS + " WHERE topic IN ('ev-click', 'ev-view')"
ORACLE["generation_repeated"] = ORACLE["scan_generation"]
ORACLE["bulk_then_stream"] = EV_ROWS
ORACLE["write_log_appended"] = f"""WITH {EV} SELECT topic, "partition", row_number() OVER (PARTITION BY topic, "partition"
    ORDER BY "timestamp" >= {MID}, "offset") - 1 AS "offset", "timestamp", hex(k) AS key, hex(v) AS value, headers FROM ev"""
ORACLE["restore_merged_topics"] = f"""WITH {EV} SELECT CASE WHEN topic IN ('ev-click', 'ev-view') THEN 'all' ELSE topic END AS topic,
    "partition", count(*) AS records, count(*) AS offsets, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
    CAST(sum("offset") AS BIGINT) AS old_offsets FROM ev GROUP BY 1, 2"""
FILES = """ SELECT topic, "partition", min("offset") AS first_offset, CAST(1 AS BIGINT) AS files, count(*) AS records,
    min("offset") AS lowest, max("offset") AS last_offset FROM sg GROUP BY topic, "partition", segment_id"""
FILE_SEG = f"""WITH {EV}, sg AS (SELECT *, {BY_COUNT.format(n=FILE_FLUSH)} AS segment_id FROM ev)"""
ORACLE["write_segments"] = FILE_SEG + FILES
ORACLE["write_segments_mixed"] = mixed(EV, "ev", FILE_FLUSH, 5 * DAY_MS) + FILES
ORACLE["merge_batches"] = FILE_SEG + f""", nw AS (SELECT topic, "partition", max(segment_id) AS newest FROM sg GROUP BY 1, 2),
    cl AS (SELECT sg.topic, sg."partition", sg.segment_id, "offset",
             count(*) OVER (PARTITION BY sg.topic, sg."partition", sg.segment_id) AS n, newest
           FROM sg JOIN nw USING (topic, "partition"))
    SELECT topic, "partition", min("offset") AS first_offset, CAST(1 AS BIGINT) AS files, count(*) AS records,
      min("offset") AS lowest, max("offset") AS last_offset FROM cl WHERE segment_id < newest OR n = {FILE_FLUSH}
    GROUP BY topic, "partition", segment_id"""
ORACLE["translate_group_job"] = "SELECT * FROM (" + ORACLE["starting_offsets"] + ") WHERE topic = 'r-view'"
ORACLE["import_avro_generation"] = ORACLE["envelope_roundtrip"] + " WHERE topic IN ('ev-click', 'ev-error') AND v IS NOT NULL"
ORACLE["watched_log"] = """WITH tx AS (SELECT lang, hex(encode(string_agg(text || chr(10), '' ORDER BY doc_id))) AS h FROM documents GROUP BY lang),
    ck AS (SELECT lang, h, unnest(range((length(h) + 1999) // 2000)) AS pos FROM tx),
    ix AS (SELECT substr(h, CAST(2000 * pos + 1 AS BIGINT), 2000) AS c, row_number() OVER (ORDER BY lang, pos) - 1 AS i FROM ck),
    sp AS (SELECT c, i, CAST(CASE WHEN i % 7 < 4 THEN 0 ELSE i % 7 - 3 END AS INTEGER) AS p FROM ix)
    SELECT 'files' AS topic, p AS "partition", row_number() OVER (PARTITION BY p ORDER BY i) - 1 AS "offset", md5(c) AS digest FROM sp"""
ORACLE["envelope_losses"] = f"""WITH {EV} SELECT topic, "partition", "offset", "offset" % 5 = 0 AS "timestamp", false AS null_header,
    "offset" % 2 <> 0 AS repeated_header FROM ev WHERE "offset" % 5 = 0 OR "offset" % 2 <> 0"""
ORACLE["backup_in_two_runs"] = ORACLE["stream_new_checkpoint"] = EV_ROWS
ORACLE["batch_shrunk"] = EV_ROWS + f""" WHERE "timestamp" < {MID} OR "partition" <> 3"""
ORACLE["generation_shrunk"] = ORACLE["latest_per_key"] + """ AND "partition" = 0"""
ORACLE["restore_new_checkpoint"] = ORACLE["stream_backup_by_manifest"] = f"""WITH {EV} SELECT {RENAMED} AS topic,
    "partition", count(*) AS records, count(*) AS offsets, CAST(0 AS BIGINT) AS first_offset, count(*) - 1 AS last_offset,
    CAST(sum("offset") AS BIGINT) AS old_offsets FROM ev GROUP BY 1, 2"""
ORACLE["scan_time_range_indexed"] = f"""WITH {ORD} SELECT topic, "partition", "offset", "timestamp",
      hex(CAST(o_custkey AS VARCHAR)) AS key, hex(o_orderpriority) AS value, '' AS headers
    FROM od JOIN orders ON o_orderkey = "offset" WHERE topic = 'or-F' AND "partition" = 3
      AND "timestamp" BETWEEN 800000000000 AND 850000000000"""
ORACLE["offset_index_runs"] = f"""WITH {RES}, rn AS (SELECT *, old_offset - new_offset AS d FROM res),
    st AS (SELECT *, CASE WHEN old_offset = lag(old_offset) OVER w + 1 AND new_offset = lag(new_offset) OVER w + 1 THEN 0 ELSE 1 END AS fresh
           FROM rn WINDOW w AS (PARTITION BY topic, "partition" ORDER BY new_offset)),
    ru AS (SELECT *, sum(fresh) OVER (PARTITION BY topic, "partition" ORDER BY new_offset ROWS UNBOUNDED PRECEDING) AS run FROM st)
    SELECT old_topic, topic AS new_topic, "partition", min(old_offset) AS old_start, min(new_offset) AS new_start, count(*) AS length
    FROM ru GROUP BY old_topic, topic, "partition", run"""
ORACLE["translate_all_groups"] = f"""WITH {RES}, {LAST}
    SELECT lc.topic AS old_topic, lc."partition" AS "partition", committed, group_id, any_value(res.topic) AS new_topic,
      coalesce(min(CASE WHEN old_offset >= committed THEN new_offset END), max(new_offset) + 1) AS new_offset
    FROM lc JOIN res ON res.old_topic = lc.topic AND res."partition" = lc."partition"
    GROUP BY lc.topic, lc."partition", committed, group_id"""
ORACLE["compact_incremental"] = ORACLE["latest_per_key"]
ORACLE["generation_cycle"] = f"""WITH {EV}, lt AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition", k ORDER BY "offset" DESC) AS r
      FROM ev WHERE "timestamp" < {DAY0 + 35 * DAY_MS})
    SELECT topic || '@backup-activate' AS topic, "partition", "offset", "timestamp", hex(k) AS key, hex(v) AS value, headers
    FROM lt WHERE r = 1 AND v IS NOT NULL"""
ORACLE["stream_segments"] = mixed(EV, "ev", FILE_FLUSH, 5 * DAY_MS) + f""", fs AS (SELECT topic, "partition", segment_id, min("offset") AS f
      FROM sg GROUP BY ALL), nw AS (SELECT topic, "partition", max(f) AS nf FROM fs GROUP BY 1, 2)
    SELECT topic, "partition", min("offset") AS first_offset, CAST(1 AS BIGINT) AS files, count(*) AS records,
      min("offset") AS lowest, max("offset") AS last_offset FROM sg JOIN nw USING (topic, "partition")
    GROUP BY topic, "partition", segment_id, nf HAVING min("offset") < nf OR count(*) = {FILE_FLUSH}"""
ORACLE["scan_avro_topics"] = EV_ROWS
