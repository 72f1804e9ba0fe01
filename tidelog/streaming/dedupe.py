"""Deduplication of a stream by bitmaps of offsets in the state store.

The key of the state is a block of offsets of a topic-partition, so a hot topic-partition is many keys, and a key holds at
most ``BLOCK`` bits. A bitmap is compressed: a full or an empty block takes some hundred bytes. The store keeps a version per
micro-batch and writes changes only, so the cost of a micro-batch does not depend on what came before it.

Spark hands the rows of a key to Python one at a time, so records travel in packs: those of a block that a task reads
together are one row, an Arrow batch in a binary column, and are packed before the state and unpacked after it.
"""

from __future__ import annotations

import zlib
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidelog.operators.ordering import BLOCK, offset_block
from tidelog.schema import HEADERS_DDL, LOG_COLUMNS, TOPIC_PARTITION

KEYS = list(TOPIC_PARTITION)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Records, and bytes of them, about, that a task looks at together to pack them, and bytes of a pack.
LOOK_ROWS = 1 << 19
LOOK_BYTES = 32 << 20
PACK_BYTES = 1 << 17
#: Records that a task hands over at once, about.
HANDED_ROWS = 10_000
#: A record in a pack.
RECORD = pa.schema([
    ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.int64()), ("key", pa.binary()), ("value", pa.binary()),
    ("headers", pa.list_(pa.field("element", pa.struct([("key", pa.string()), ("value", pa.binary())])))),
])
RECORD_DDL = f"topic string, partition int, offset bigint, timestamp bigint, key binary, value binary, headers {HEADERS_DDL}"
PACK_DDL = "topic string, partition int, block bigint, records binary"


@contextmanager
def state_store(spark: SparkSession):
    """Settings for a query with keyed state; a query keeps those that it is started with."""
    # a row may be a pack of records: a tenth of the default
    wanted = {PROVIDER: ROCKSDB, CHANGELOG: "true", BATCH_ROWS: "1000"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _pack(batches):
    """Records of ``LOG_COLUMNS`` and ``block``, in packs (``PACK_DDL``) of one block each."""
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= LOOK_ROWS or size >= LOOK_BYTES:
            yield _packs(held)
            held, rows, size = [], 0, 0
    if rows:
        yield _packs(held)


def _packs(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    of = np.zeros(table.num_rows, np.int64)
    for c in (*KEYS, "block"):
        codes = table.column(c).combine_chunks().dictionary_encode("encode")
        # numbers of the keys so far stay below the number of rows
        of = np.unique(of * len(codes.dictionary) + codes.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(of, kind="stable")
    bounds = np.append(np.flatnonzero(np.diff(of[order], prepend=-1)), len(of))
    (records,) = table.select(LOG_COLUMNS).cast(RECORD).take(pa.array(order)).combine_chunks().to_batches()
    first, packs = [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        step = -(-(b - a) // -(-records.slice(a, b - a).nbytes // PACK_BYTES))
        for at in range(a, b, step):
            first.append(at)
            packs.append(records.slice(at, min(step, b - at)).serialize().to_pybytes())
    heads = table.select([*KEYS, "block"]).take(order[first]).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays([*heads.columns, pa.array(packs, pa.binary())], names=[*KEYS, "block", "records"])


def _unpack(batches):
    for batch in batches:
        held, rows, size = [], 0, 0
        for pack in batch.column("records"):
            held.append(pa.ipc.read_record_batch(pack.as_buffer(), RECORD))
            rows, size = rows + held[-1].num_rows, size + held[-1].nbytes
            if rows >= HANDED_ROWS or size >= LOOK_BYTES:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows, size = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()


class SeenOffsets(StatefulProcessor):
    """Lets the first record of every offset pass."""

    def __init__(self, block: int):
        self.block = block

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "bits binary")

    def _bits(self) -> np.ndarray:
        if not self.seen.exists():
            return np.zeros(self.block, bool)
        packed = np.frombuffer(zlib.decompress(bytes(self.seen.get()[0])), np.uint8)
        return np.unpackbits(packed, count=self.block).astype(bool)

    def _keep(self, bits: np.ndarray) -> None:
        self.seen.update((zlib.compress(np.packbits(bits).tobytes(), 1),))

    def handleInputRows(self, key, rows, timerValues):
        bits, changed = self._bits(), False
        for pdf in rows:
            left = []
            for pack in pdf["records"]:
                records = pa.ipc.read_record_batch(pa.py_buffer(pack), RECORD)
                at = records.column("offset").to_numpy() % self.block
                _, first = np.unique(at, return_index=True)
                fresh = np.sort(first[~bits[at[first]]])
                if len(fresh):
                    bits[at] = changed = True
                    some = records if len(fresh) == len(at) else records.take(fresh)
                    left.append(some.serialize().to_pybytes())
            if left:
                yield pd.DataFrame({"records": left})
        if changed:
            self._keep(bits)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        bits = self._bits()
        for offsets in initialState["offsets"]:
            bits[np.asarray(offsets, np.int64) % self.block] = True
        self._keep(bits)

    def close(self) -> None:
        pass


def first_seen(df: DataFrame, seen: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """The records of a stream whose coordinate has not come before, nor is in ``seen`` (topic, partition, offset).

    ``seen`` counts at the first start of a query alone; a row of it per block comes together, which holds ``block`` offsets at
    most.
    """
    # a trigger may be few files, which few tasks read; the records of a block meet, and make few packs
    rows = df.select(*LOG_COLUMNS, offset_block("offset", block).alias("block")).repartition(*KEYS, "block")
    keyed = rows.mapInArrow(_pack, PACK_DDL)
    initial = None
    if seen is not None:
        blocks = seen.groupBy(*KEYS, offset_block("offset", block).alias("block")).agg(F.collect_set("offset").alias("offsets"))
        initial = blocks.groupBy(*KEYS, "block")
    fresh = keyed.groupBy(*KEYS, "block").transformWithStateInPandas(
        statefulProcessor=SeenOffsets(block), outputStructType="records binary", outputMode="Append", timeMode="None", initialState=initial
    )
    return fresh.mapInArrow(_unpack, RECORD_DDL)
