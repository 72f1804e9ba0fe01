"""WARC archives: write payloads as records, read archives back, reassemble segmented records.

Archives are written by Spark's text writer and read by its text reader, so any store that Spark reaches will do, a
task streams an archive record by record, and a lost task is run again. ``MARK`` divides the records. A payload is
framed in chunks that never hold ``MARK`` whole, so an archive written here always divides rightly; a foreign archive
whose block holds it gives records shorter than their Content-Length, which come back with ``whole`` false.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import scratch, slices, table

VERSION = "WARC/1.1"
MARK = f"{VERSION}\r\n"
#: Largest block of a record; longer records go on in continuation records.
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
DATE = "2025-01-01T00:00:00Z"

RECORD_DDL = (
    "record_id string, warc_type string, target_uri string, date string, payload_digest string, refers_to string, "
    "segment_number int, origin_id string, total_length bigint, whole boolean, block binary"
)
READ_DDL = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
    "payload_bytes bigint, payload binary, whole boolean"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def frame_chunks(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing. A chunk ends inside every ``VERSION`` text, so the framed bytes hold none."""
    inside = [m.start() + 4 for m in re.finditer(re.escape(VERSION.encode()), payload)]
    cuts = sorted({*range(size, len(payload), size), *inside, len(payload)} - {0})
    parts, start = [], 0
    for end in cuts:
        parts.append(b"%x\r\n%b\r\n" % (end - start, payload[start:end]))
        start = end
    return b"".join([*parts, b"0\r\n\r\n"])


def unframe_chunks(body: bytes) -> tuple[bytes, bool]:
    """Payload of a chunked body, and whether it ended as it should. Extensions and trailers are skipped."""
    parts, at = [], 0
    while (eol := body.find(b"\r\n", at)) >= 0:
        text = body[at:eol].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", text):
            break
        size = int(text, 16)
        if not size:
            return b"".join(parts), True
        part = body[eol + 2 : eol + 2 + size]
        parts.append(part)
        at = eol + 2 + size + 2
        if len(part) < size or body[at - 2 : at] != b"\r\n":
            break
    return b"".join(parts), False


def http_payload(message: bytes) -> tuple[bytes, bool]:
    """Payload of an HTTP message, freed of its transfer framing, and whether it is complete."""
    head, _, body = message.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    return unframe_chunks(body) if b"chunked" in fields.get(b"transfer-encoding", b"") else (body, True)


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return MARK.encode() + lines.encode() + b"\r\n" + block


def _records(record_id, uri, payload, refers_to, digest, segment_bytes) -> list[bytes]:
    """The record of one payload, as the first segment and its continuations if it is long."""
    own = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    own += [("WARC-Target-URI", uri or None), ("WARC-Payload-Digest", f"sha1:{digest}")]
    own += [("Content-Type", "application/http;msgtype=response")]
    if refers_to:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        own += [("WARC-Profile", profile), ("WARC-Refers-To", f"<{refers_to}>")]
        return [_record(own, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n")]
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + frame_chunks(payload)
    if len(block) <= segment_bytes:
        return [_record(own, block)]
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record([*own, ("WARC-Segment-Number", 1)], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}/{i}>"), ("WARC-Date", DATE)]
        fields += [("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", i)]
        last = [("WARC-Segment-Total-Length", len(block))] if i == len(parts) else []
        out.append(_record(fields + last, part))
    return out


def mark_revisits(records: DataFrame, order: str, min_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the ``record_id`` of the record with an equal payload and the smallest ``order``.

    It is null for that record itself and for payloads under ``min_bytes``. Rows equal in payload and ``order`` are
    equal records, none of which refers to another. A null ``order`` comes last. Digests decide equality. The digests
    are aggregated before the shuffle, and the one row per digest joins back, which adaptive execution splits if hot.
    """
    digests = records.withColumn("_sha1", F.sha1("payload")).withColumn("_key", F.struct(F.col(order).isNull(), F.col(order)))
    first = (
        digests.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("_sha1").alias("_first_sha1"))
        .agg(F.min(F.struct("_key", F.col("record_id").alias("id"))).alias("_first"))
    )
    joined = digests.join(first, F.col("_sha1") == F.col("_first_sha1"), "left")
    refers = F.when(F.col("_first._key") != F.col("_key"), F.col("_first.id"))
    return joined.withColumn("refers_to", refers).drop("_sha1", "_key", "_first_sha1", "_first")


def write_archives(records: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``record_id``, ``target_uri``, ``payload`` and ``refers_to`` as gzipped WARC archives below ``path``.

    One archive for each partition. A null payload is an empty one; control characters and blanks in an address are
    written percent-encoded, as a header line cannot hold them, and so is the slash of a ``VERSION`` that ends it, as the
    line would be a ``MARK``.
    """

    def pack(batches):
        for batch in batches:
            for part in slices(batch, "payload"):
                out = []
                for r in part.to_pylist():
                    payload = r["payload"] or b""
                    uri = re.sub(r"[\x00-\x20\x7f]|(?<=WARC)/(?=1\.1\Z)", lambda m: f"%{ord(m[0]):02X}", r["target_uri"] or "")
                    out += _records(r["record_id"], uri, payload, r["refers_to"], sha1_base32(payload), segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = records.select("record_id", "target_uri", "payload", "refers_to")
    lines = rows.mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    # the line separator is the end that every record has
    lines.write.text(path, compression="gzip", lineSep="\r\n\r\n")


def read_records(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Every record of the archives below ``path``, segments apart (``RECORD_DDL``).

    ``where`` chooses records by their header, as text in column ``head``, before they leave the JVM.
    """
    raw = spark.read.text(path, lineSep=MARK).filter(F.length("value") > 0)
    raw = raw.withColumn("head", F.substring_index("value", "\r\n\r\n", 1))
    raw = raw.select(F.col("value").cast("binary")) if where is None else raw.filter(where).select(F.col("value").cast("binary"))
    schema = spark.createDataFrame([], RECORD_DDL).schema

    def parse(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, "value"):
                rows = [_parsed(v.as_py()) for v in part.column(0)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return raw.mapInArrow(parse, RECORD_DDL)


def _parsed(value: bytes) -> dict:
    head, _, rest = value.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    whole_number = lambda name: int(fields[name]) if fields.get(name, "").isdecimal() else None
    bare = lambda name: fields[name].strip("<>") if name in fields else None
    length = whole_number("content-length")
    digest = fields.get("warc-payload-digest")
    return {
        "record_id": bare("warc-record-id"), "warc_type": fields.get("warc-type"), "target_uri": bare("warc-target-uri"),
        "date": fields.get("warc-date"), "payload_digest": digest and digest.rpartition(":")[2].upper(),
        "refers_to": bare("warc-refers-to"), "segment_number": whole_number("warc-segment-number"),
        "origin_id": bare("warc-segment-origin-id"), "total_length": whole_number("warc-segment-total-length"),
        "whole": length is not None and len(rest) >= length, "block": rest[:length],
    }


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit of the archives below ``path`` with its full payload (``READ_DDL``).

    Unsegmented records are decoded where they are read. Segments are grouped by the identifier of their origin, put
    in order, checked (numbers without gap, total length, Content-Length of each) and decoded. A record written
    several times under one identifier comes back as often. A revisit holds no payload: ``payload_bytes`` is null
    until ``resolve_revisits``. ``payload_digest`` is that of the bytes read for a response, that of the header for a
    revisit. ``whole`` tells whether all checks held; damaged records come back with what could be read. Continuations
    whose first segment is missing give a row with type ``continuation``. One group is one record, so it is no larger
    than a row.
    """
    in_parts = F.col("head").rlike(r"(?i)(^|\r\n)WARC-Segment-Number:")
    apart = read_records(spark, path, ~in_parts).filter("warc_type IN ('response', 'revisit')")
    parts = read_records(spark, path, in_parts).withColumn("key", F.coalesce("origin_id", "record_id"))
    fields = [c for c in apart.columns]
    grouped = parts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("segment_number", *[c for c in fields if c != "segment_number"]))).alias("parts"))

    def decode(batches):
        for batch in batches:
            for part in slices(batch, "block"):
                yield _read([_payload([r]) for r in part.to_pylist()])

    def reassemble(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = batch.slice(i, 1).to_pylist()[0]["parts"]
                by_number: dict = {}
                for p in found:
                    by_number.setdefault(p["segment_number"], []).append(p)
                copies = len(by_number.get(1, [0]))
                yield _read([_payload([x[0] for x in by_number.values()])] * copies)

    return apart.mapInArrow(decode, READ_DDL).unionByName(grouped.mapInArrow(reassemble, READ_DDL))


def _payload(parts: list[dict]) -> dict:
    """One record from its segments in order."""
    first = parts[0]
    numbers = [p["segment_number"] for p in parts]
    block = b"".join(p["block"] for p in parts)
    whole = all(p["whole"] for p in parts)
    if numbers != [None]:
        whole = whole and numbers == [*range(1, len(parts) + 1)] and parts[-1]["total_length"] == len(block)
    out = {"record_id": first["record_id"] if numbers[0] in (None, 1) else first["origin_id"], "record_type": first["warc_type"], "target_uri": first["target_uri"], "refers_to": first["refers_to"]}
    if first["warc_type"] == "revisit":
        return out | {"payload_digest": first["payload_digest"], "payload_bytes": None, "payload": None, "whole": whole}
    payload, complete = http_payload(block)
    digest = sha1_base32(payload)
    whole = whole and complete and first["payload_digest"] in (None, digest)
    return out | {"payload_digest": digest, "payload_bytes": len(payload), "payload": payload, "whole": whole}


def _read(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary(), "whole": pa.bool_()}
    names = [x.split()[0] for x in READ_DDL.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def resolve_revisits(read: DataFrame) -> DataFrame:
    """Give revisits the ``payload_bytes`` of the response they refer to (null if the archives hold none)."""
    said = (
        read.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("_id"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    joined = read.join(said, F.col("refers_to") == F.col("_id"), "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_id", "_bytes")


def op1_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through an archive. A page without an identifier is kept with a null ``page_id``."""
    page_id = F.col("page_id").cast("bigint")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = table(spark, sf_dir, "pages").select(page_id.alias("page_id"), F.col("url").alias("target_uri"), payload.alias("payload"))
    # a repeated page_id with another payload is another record
    record_id = F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), F.sha1("payload"))
    path = scratch(spark, "warc")
    write_archives(mark_revisits(pages.withColumn("record_id", record_id), "page_id"), path)
    read = resolve_revisits(read_payloads(spark, path).drop("payload"))
    damaged = F.raise_error(F.concat(F.lit("not read back whole: "), F.coalesce("record_id", F.lit("")))).cast("boolean")
    read = read.filter(F.when(F.col("whole"), F.lit(True)).otherwise(damaged))
    number = lambda c: F.expr(f"try_cast(nullif(split_part({c}, ':', 3), '') AS bigint)")
    return read.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"),
    )


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(p.h, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT) + 1, 1)), '')
         AS payload_digest,
       CASE WHEN p.page_id IS DISTINCT FROM f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
FROM p JOIN f ON p.h = f.h
"""
