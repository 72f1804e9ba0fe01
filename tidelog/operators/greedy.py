"""Greedy cuts: the first position is a start, the next start is the first one at least ``width`` later.

The chain of starts is sequential, so it is no window function. It is still computed block by block:

1. Every block of positions is reduced to a step function "last start before the block -> last
   start after the block". It is monotone and has at most ``min(width, positions)`` steps.
2. Step functions are composed over runs of blocks, the functions of a key's runs are followed in
   order, and then those of the blocks inside every run, which gives every block the last start
   before it.
3. Every block marks its own starts from there.

All but the following of runs works in parallel over the blocks or runs of one key, in Arrow
batches, with numpy inside the tasks. A block spans at least 16 widths and a run 64 blocks, and
only the positions within a width of its begin matter to a function, so what one task follows is
at most a thousandth of a key's positions.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.schema import TOPIC_PARTITION

SPAN = 1 << 20
WIDTHS_PER_SPAN = 16
BLOCKS_PER_RUN = 64
NEVER = -(1 << 62)
BATCH = 1 << 20
FRAME = 1 << 14


def _merge(at, to):
    """Keep the last threshold of every run of equal results."""
    keep = np.ones(len(to), bool)
    keep[:-1] = to[1:] != to[:-1]
    return at[keep], to[keep]


def step_function(x, width):
    """Thresholds and results of one sorted run of positions.

    A chain whose last start is s continues with the first threshold >= s + width, if any, and
    then ends at its result.
    """
    after = np.searchsorted(x, x + width)
    hop = np.where(after < len(x), after, np.arange(len(x)))
    while True:
        twice = hop[hop]
        if np.array_equal(twice, hop):
            return _merge(x, x[hop])
        hop = twice


def follow(steps, start, width):
    """Last start after a run, for one or many last starts before it."""
    at, to = steps
    start = np.asarray(start, dtype=np.int64)
    if not len(at):
        return start
    i = np.searchsorted(at, start + width)
    return np.where(i < len(at), to[np.minimum(i, len(at) - 1)], start)


def compose(first, second, width):
    """Step function of one run followed by a later one."""
    return _merge(
        np.concatenate([first[0], second[0]]), np.concatenate([follow(second, first[1], width), second[1]])
    )


def mark(x, start, width):
    """Indices of the starts among sorted positions that follow a last start."""
    found = np.searchsorted(x, [start + width])
    hop = np.append(np.searchsorted(x, x + width), len(x))
    found = found[found < len(x)]
    while len(found):
        # with the first n starts and n hops at once: the next n
        more = hop[found]
        more = more[more < len(x)]
        found, full, hop = np.concatenate([found, more]), len(more) == len(found), hop[hop]
        if not full:
            break
    return found


def _runs(batches, names, values):
    """Consecutive pieces of equal ``names`` from sorted batches: group values and arrays."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for name in names:
            column = batch.column(name)
            changed = pc.not_equal(column.slice(1), column.slice(0, n - 1))
            new[1:] |= changed.to_numpy(zero_copy_only=False)
        cuts = [0, *np.flatnonzero(new).tolist(), n]
        arrays = [batch.column(v).to_numpy() for v in values]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield tuple(batch.column(name)[lo].as_py() for name in names), [v[lo:hi] for v in arrays]


class _Out:
    """Collects pieces of output and hands them on as batches of a good size."""

    def __init__(self, names, types, values):
        self.names, self.types, self.values = names, types, values
        self.pieces, self.rows = [], 0

    def add(self, group, *arrays):
        if len(arrays[0]):
            self.pieces.append((group, arrays))
            self.rows += len(arrays[0])

    def batches(self, last=False):
        if self.pieces and (last or self.rows >= FRAME):
            which = np.repeat(np.arange(len(self.pieces)), [len(arrays[0]) for _, arrays in self.pieces])
            columns = [
                pa.array([g[i] for g, _ in self.pieces], type).take(pa.array(which))
                for i, type in enumerate(self.types)
            ]
            for i in range(len(self.values)):
                columns.append(pa.array(np.concatenate([arrays[i] for _, arrays in self.pieces]), pa.int64()))
            self.pieces, self.rows = [], 0
            yield pa.RecordBatch.from_arrays(columns, [*self.names, *self.values])


def _summarize(names, types, width):
    def run(batches):
        out, group, waiting, size, steps = _Out(names, types, ["_at", "_to"]), None, [], 0, None

        def absorb():
            part = step_function(np.concatenate(waiting), width)
            return part if steps is None else compose(steps, part, width)

        for key, (x,) in _runs(batches, names, ["_x"]):
            if key != group:
                if group is not None:
                    out.add(group, *absorb())
                    yield from out.batches()
                group, waiting, size, steps = key, [], 0, None
            elif size >= BATCH:
                steps, waiting, size = absorb(), [], 0
            waiting.append(x)
            size += len(x)
        if group is not None:
            out.add(group, *absorb())
        yield from out.batches(last=True)

    return run


def _compose_runs(names, types, width, reach):
    """Step functions of blocks, in order, to those of their runs; ``reach`` of a run's number bounds the thresholds that matter."""

    def run(batches):
        out, group, at, to, steps = _Out(names[:-1], types[:-1], ["_at", "_to"]), None, [], [], None

        def absorb():
            part = (np.concatenate(at), np.concatenate(to))
            return part if steps is None else compose(steps, part, width)

        def done(key, whole):
            if reach:
                n = int(np.searchsorted(whole[0], reach(key[-2]))) + 1
                whole = whole[0][:n], whole[1][:n]
            out.add(key[:-1], *whole)

        for key, (x, y) in _runs(batches, names, ["_at", "_to"]):
            if key != group and group is not None:
                steps = absorb()
                at, to = [], []
                if key[:-1] != group[:-1]:
                    done(group, steps)
                    steps = None
                    yield from out.batches()
            group = key
            at.append(x)
            to.append(y)
        if group is not None:
            done(group, absorb())
        yield from out.batches(last=True)

    return run


def _enter(names, types, width):
    def run(batches):
        out, group, at, to, start = _Out(names, types, ["_x", "_and"]), None, [], [], NEVER
        for key, (x, y) in _runs(batches, names, ["_at", "_to"]):
            if key != group:
                if group is not None:
                    after = int(follow((np.concatenate(at), np.concatenate(to)), start, width))
                    start = after if key[:-1] == group[:-1] else NEVER
                group, at, to = key, [], []
                out.add(group, np.array([NEVER]), np.array([start]))
                yield from out.batches()
            at.append(x)
            to.append(y)
        yield from out.batches(last=True)

    return run


def _mark(names, types, width):
    def run(batches):
        out, group, start = _Out(names, types, ["_x", "_and"]), None, NEVER
        for key, (x, extra) in _runs(batches, names, ["_x", "_and"]):
            if key != group:
                # the first row of a block is not a position, it brings the last start before it
                group, start, x, extra = key, int(extra[0]), x[1:], extra[1:]
            found = mark(x, start, width)
            if len(found):
                start = int(x[found[-1]])
                out.add(key, x[found], extra[found])
                yield from out.batches()
        yield from out.batches(last=True)

    return run


def greedy_starts(
    positions: DataFrame,
    at: str,
    width: int,
    keys=TOPIC_PARTITION,
    extra: str | None = None,
    resume: DataFrame | None = None,
    span: int | None = None,
) -> DataFrame:
    """The starts among ``positions``: rows (keys, ``at``[, ``extra``]).

    ``positions`` are distinct inside ``keys`` and are read twice. ``extra`` is an integer column to
    bring along. ``resume`` holds (keys, start): a chain already begun, which the positions continue.
    """
    keys = list(keys)
    span = span or max(SPAN, WIDTHS_PER_SPAN * width)
    names = [*keys, "_block"]
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    types = [*[kinds[positions.schema[k].dataType.simpleString()] for k in keys], pa.int64()]
    ddl = ", ".join(f"`{k}` {positions.schema[k].dataType.simpleString()}" for k in keys) + ", _block bigint"

    def sorted_blocks(df, *order):
        return df.repartition(*names).sortWithinPartitions(*names, *order)

    blocks = positions.select(
        *keys, F.col(at).cast("bigint").alias("_x"), F.col(extra or at).cast("bigint").alias("_and")
    ).withColumn("_block", F.expr(f"_x div {span}"))
    steps = sorted_blocks(blocks.drop("_and"), "_x").mapInArrow(
        _summarize(names, types, width), f"{ddl}, _at bigint, _to bigint"
    )
    many = BLOCKS_PER_RUN
    in_runs = steps.withColumn("_run", F.floor(F.col("_block") / many).cast("bigint"))
    by_block, run_types = [*keys, "_run", "_block"], [*types, pa.int64()]
    run_ddl = ddl.removesuffix("_block bigint") + "_run bigint"
    # a chain that was begun elsewhere may enter a run anywhere, any other one before its first position
    reach = None if resume is not None else lambda run: run * many * span + width
    composed = (
        in_runs.repartition(*keys, "_run")
        .sortWithinPartitions(*by_block, "_at")
        .mapInArrow(_compose_runs(by_block, run_types, width, reach), f"{run_ddl}, _at bigint, _to bigint")
    )

    def constant(df, start):
        # a step function that ends every chain at the given start
        return df.withColumns({"_at": F.lit(-NEVER), "_to": F.col(start).cast("bigint")})

    if resume is not None:
        begun = constant(resume.select(*keys, F.lit(NEVER).alias("_run"), "start"), "start")
        composed = composed.unionByName(begun.drop("start"))
    by_run = [*keys, "_run"]
    into_runs = (
        composed.repartition(*keys)
        .sortWithinPartitions(*by_run, "_at")
        .mapInArrow(_enter(by_run, types, width), f"{run_ddl}, _x bigint, _and bigint")
    )
    first = constant(into_runs.withColumn("_block", F.lit(NEVER)), "_and").drop("_x", "_and")
    entered = (
        in_runs.unionByName(first)
        .repartition(*keys, "_run")
        .sortWithinPartitions(*by_block, "_at")
        .mapInArrow(_enter(by_block, run_types, width), f"{run_ddl}, _block bigint, _x bigint, _and bigint")
        .filter(F.col("_block") > NEVER)
        .drop("_run")
    )
    starts = sorted_blocks(blocks.unionByName(entered), "_x").mapInArrow(
        _mark(names, types, width), f"{ddl}, _x bigint, _and bigint"
    )
    return starts.select(*keys, F.col("_x").alias(at), *([F.col("_and").alias(extra)] if extra else []))
