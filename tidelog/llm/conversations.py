"""Repair of conversations whose roles do not alternate, by integer minima over scalar weights.

The roles of a repaired conversation are an optional system turn and then pairs of user and assistant. Rows may be kept,
given another role, deleted, or inserted. A plan's weight is one integer: its high digits are the cost, its low digits,
of a fixed width, are the letters of its edits in order, ended by zeros. The least integer is the cheapest plan and, among
those of equal cost, the one whose letters come first in ASCII.

Inserted rows stand before a row, so no plan for the first rows of a conversation is the beginning of another that leads
to the same place, and a least weight stays least whatever follows: one integer per row and state is enough. Blocks of
sorted rows are solved in parallel from each of the four states to each, and their plans are joined by the same minima,
so a conversation may be larger than a task.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import release, stored, table
from tidelog.session import join_null_safe

#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Letters of the edits in ASCII order; a letter's digit is its place, 0 ends the letters.
LETTERS = "DIKR"
DIGIT_BITS = 3
#: Rows of a block, and blocks that are joined at once.
BLOCK = 512
JOINED = 32
#: Plans that a task remembers; conversations are short and alike.
KNOWN = 20_000

#: What the last row left is: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Role that can follow a state, and the state after it.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Rows as letters: first letter of the role (x for another), in upper case if truncated; - must be deleted.
FORCED = "-"

SPACE = r"\x20\x09-\x0D"


def _edits(symbol: str, state: int):
    """Edits of a row in a state: letter, cost, state after it."""
    yield "D", DELETE, state
    if symbol == FORCED:
        return
    extra, initial = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
    if initial == "s" and state == START:
        yield "K", KEEP + extra, SYSTEM
    if initial == "ua"[NEXT[state] - USER]:
        yield "K", KEEP + extra, NEXT[state]
    yield "R", REROLE + extra, NEXT[state]


def _letter(letter: str) -> int:
    return LETTERS.index(letter) + 1


def _inserted(values: dict, width: int) -> dict:
    """``values`` after at most two inserted rows; a longer run of them never pays."""
    out = dict(values)
    for _ in range(2):
        for state, (value, used) in list(out.items()):
            weight = (INSERT << DIGIT_BITS * width) + (_letter("I") << DIGIT_BITS * (width - 1 - used))
            _least(out, NEXT[state], (value + weight, used + 1))
    return out


def _least(values: dict, state: int, new: tuple[int, int]) -> None:
    if state not in values or new < values[state]:
        values[state] = new


def _read(value: int, used: int, width: int) -> tuple[int, str]:
    digits = (value & ((1 << DIGIT_BITS * width) - 1)) >> DIGIT_BITS * (width - used)
    letters = format(digits, "o").translate(str.maketrans("1234", LETTERS)) if used else ""
    return value >> DIGIT_BITS * width, letters


def solve(symbols: str, starts: tuple[int, ...] = tuple(STATES)) -> dict:
    """Cheapest plans for rows (``symbols``): (state before, state after) to (cost, letters)."""
    width, plans = 3 * len(symbols) + 1, {}
    for start in starts:
        values = {start: (0, 0)}
        for symbol in symbols:
            after: dict = {}
            for state, (value, used) in _inserted(values, width).items():
                for letter, cost, to in _edits(symbol, state):
                    weight = (cost << DIGIT_BITS * width) + (_letter(letter) << DIGIT_BITS * (width - 1 - used))
                    _least(after, to, (value + weight, used + 1))
            values = after
        plans |= {(start, state): _read(*value, width) for state, value in values.items()}
    return plans


def _weight(cost: int, letters: str, width: int) -> int:
    digits = int(letters.translate(str.maketrans(LETTERS, "1234")) or "0", 8)
    return (cost << DIGIT_BITS * width) + (digits << DIGIT_BITS * (width - len(letters)))


def joined(first: dict, second: dict) -> dict:
    """Cheapest plans for the rows of ``first`` and then those of ``second``."""
    width = max((len(x) for _, x in first.values()), default=0) + max((len(x) for _, x in second.values()), default=0)
    plans: dict = {}
    for (start, middle), (cost, letters) in first.items():
        for end in STATES:
            if (middle, end) in second:
                more, rest = second[middle, end]
                new = (_weight(cost + more, letters + rest, width), cost + more, letters + rest)
                if (start, end) not in plans or new < plans[start, end]:
                    plans[start, end] = new
    return {k: v[1:] for k, v in plans.items()}


def finished(plans: dict) -> tuple[int, str]:
    """The cheapest plan from the start to a whole conversation, rows inserted at the end included."""
    own = {end: v for (start, end), v in plans.items() if start == START}
    width = max((len(x) for _, x in own.values()), default=0) + 2
    values = _inserted({s: (_weight(cost, x, width), len(x)) for s, (cost, x) in own.items()}, width)
    return _read(*min(values[s] for s in (START, ASSISTANT) if s in values), width)


BLOCK_FIELDS = [
    ("blank", pa.int64()),
    ("duplicate", pa.int64()),
    ("truncated", pa.int64()),
    ("illegal", pa.int64()),
    ("turns", pa.int64()),
    ("first_turn", pa.int64()),
    ("last_turn", pa.int64()),
    ("first_initial", pa.string()),
    ("last_initial", pa.string()),
    ("plans", pa.map_(pa.int32(), pa.struct([("cost", pa.int64()), ("letters", pa.string())]))),
]
BLOCK_DDL = (
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, "
    "first_initial string, last_initial string, plans map<int, struct<cost: bigint, letters: string>>"
)
LEGAL = ("su", "ua", "au")


def _block(rows: list, starts: tuple[int, ...], known: dict) -> dict:
    """The record of a block of sorted rows (turn, initial, fault, symbol). ``known`` holds plans of short blocks."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1] for r in rows]
    faults = [r[2] for r in rows]
    symbols = "".join(r[3] for r in rows)
    plans = known.get((symbols, starts))
    if plans is None:
        plans = solve(symbols, starts)
        if len(rows) <= 32 and len(known) < KNOWN:
            known[symbols, starts] = plans
    return {
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in LEGAL for a, b in pairwise(initials)),
        "turns": len(set(turns)),
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        "first_initial": initials[0],
        "last_initial": initials[-1],
        "plans": _stored(plans),
    }


def _stored(plans: dict) -> list:
    return [(4 * a + b, {"cost": cost, "letters": letters}) for (a, b), (cost, letters) in plans.items()]


def _plans(stored_plans) -> dict:
    return {divmod(k, 4): (v["cost"], v["letters"]) for k, v in stored_plans}


def _merged(blocks: list[dict]) -> dict:
    """The record of adjacent blocks, in order."""
    out = blocks[0]
    for other in blocks[1:]:
        same = out["last_turn"] is not None and out["last_turn"] == other["first_turn"]
        out = {
            **{f: out[f] + other[f] for f in ("blank", "duplicate", "truncated")},
            "illegal": out["illegal"] + other["illegal"] + (out["last_initial"] + other["first_initial"] not in LEGAL),
            "turns": out["turns"] + other["turns"] - same,
            "first_turn": out["first_turn"] if out["first_turn"] is not None else other["first_turn"],
            "last_turn": other["last_turn"] if other["last_turn"] is not None else out["last_turn"],
            "first_initial": out["first_initial"],
            "last_initial": other["last_initial"],
            "plans": _stored(joined(_plans(out["plans"]), _plans(other["plans"]))),
        }
    return out


def _columns(records: list[dict], names_types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in names_types], names=[n for n, _ in names_types])


def _marked(rows: DataFrame) -> DataFrame:
    """Distinct rows (``conv_id``, ``turn``, ``role``, ``text``) with their number (``copies``), ``initial``, ``fault`` and ``symbol``.

    A row's fault is its first one; further copies of a row are duplicates unless it is blank.
    """
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    seen = once.groupBy("conv_id", "role", "text").agg(F.min("turn").alias("first_turn"), F.max(F.col("turn").isNull()).alias("no_turn"))
    both = join_null_safe(once, seen, ["conv_id", "role", "text"])
    first = F.when(F.col("no_turn"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn"))
    fault = F.when(~F.col("text").rlike(f"[^{SPACE}]"), "blank").when(~first, "duplicate")
    fault = fault.when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), FORCED).when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    return both.withColumns({"initial": initial, "fault": fault}).withColumn("symbol", symbol).drop("first_turn", "no_turn")


ORDER = ["conv_id", "turn", "role", "text"]


def _blocks(marked: DataFrame) -> DataFrame:
    """``conv_id``, ``task`` and ``number`` (the order of blocks) and the record of every block."""

    def cut(batches):
        task = TaskContext.get().partitionId()
        ids, numbers, records = [], [], []
        conv, rows, whole, any_conv, known = None, [], False, False, {}

        def close(last: bool) -> None:
            if rows:
                ids.append(conv)
                numbers.append(len(numbers) + done)
                records.append(_block(rows, (START,) if whole and last else tuple(STATES), known))
                rows.clear()

        done = 0
        for batch in batches:
            for c, turn, initial, fault, symbol, copies in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "initial", "fault", "symbol", "copies")), strict=True):
                if not any_conv or c != conv:
                    close(True)
                    # a conversation that begins after another one in this task is here from its first row on
                    conv, whole, any_conv = c, any_conv, True
                for k in range(copies):
                    rows.append((turn, initial, fault, symbol) if not k else (turn, initial, fault if fault == "blank" else "duplicate", FORCED))
                    if len(rows) == BLOCK:
                        close(False)
                        whole = False
            if len(records) > 5_000:
                yield _emit(ids, task, numbers, records)
                done += len(numbers)
                ids, numbers, records = [], [], []
        # the last conversation may go on in the next task
        close(False)
        if records:
            yield _emit(ids, task, numbers, records)

    def _emit(ids, task, numbers, records):
        part = _columns(records, BLOCK_FIELDS)
        head = [pa.array(ids, pa.int64()), pa.array([task] * len(ids), pa.int32()), pa.array(numbers, pa.int64())]
        return pa.RecordBatch.from_arrays([*head, *part.columns], names=["conv_id", "task", "number", *part.schema.names])

    narrow = marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("conv_id", "turn", "initial", "fault", "symbol", "copies")
    return narrow.mapInArrow(cut, f"conv_id bigint, task int, number bigint, {BLOCK_DDL}")


def _whole(blocks: DataFrame) -> DataFrame:
    """One record per conversation: adjacent blocks are joined, so many at once, until one is left."""
    order = Window.partitionBy("conv_id").orderBy("task", "number")
    each = blocks.withColumns({"i": F.row_number().over(order) - 1, "n": F.count("*").over(Window.partitionBy("conv_id"))}).drop("task", "number")
    each = stored(each, "blocks")
    out, several = each.filter("n = 1").drop("i", "n"), each.filter("n > 1")
    most = several.agg(F.max("n")).first()[0] or 1

    def join(part: pa.Table) -> pa.Table:
        part = part.sort_by("i")
        merged = _columns([_merged(part.select([n for n, _ in BLOCK_FIELDS]).to_pylist())], BLOCK_FIELDS)
        head = [part.column("conv_id").slice(0, 1), pa.array([part.column("chunk")[0].as_py()], pa.int32())]
        return pa.Table.from_arrays([*head, *merged.columns], names=["conv_id", "i", *merged.schema.names])

    while most > 1:
        chunked = several.drop("n").withColumn("chunk", (F.col("i") / JOINED).cast("int"))
        several = stored(chunked.groupBy("conv_id", "chunk").applyInArrow(join, f"conv_id bigint, i int, {BLOCK_DDL}"), "blocks")
        most = -(-most // JOINED)
        if most == 1:
            out = out.unionByName(several.drop("i"))
    return out


def _plan_columns(whole: DataFrame) -> DataFrame:
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def finish(batches):
        for batch in batches:
            ends = [finished(_plans(x)) for x in batch.column("plans").to_pylist()]
            cost, audit = pa.array([x[0] for x in ends], pa.int64()), pa.array([x[1] for x in ends], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:6]), cost, audit], names=names)

    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    counts = whole.select("conv_id", gaps, "blank", "duplicate", "truncated", "illegal", "plans")
    return counts.mapInArrow(finish, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


def plans_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations in ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, ``copies``): faults and the cheapest plan
    (``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``), and the rows that it applies to.

    Rows are taken by turn, those without one first; rows of one turn by role, then by text. ``copies`` are adjacent.
    Rows without ``conv_id`` are one conversation. Roles and texts must not be null.
    """
    marked = stored(_marked(rows), "marked")
    return stored(_plan_columns(_whole(stored(_blocks(marked), "blocks"))), "plans"), marked


def _replayed(plans: DataFrame, marked: DataFrame, emit, ddl: str) -> DataFrame:
    """``emit`` gets an iterator of (``conv_id``, repaired rows) per task; a row is its edit, role and text.

    Rows stream past in order, so a task holds a plan, not a conversation.
    """
    heads = plans.select("conv_id", F.lit(0).alias("is_row"), F.lit(None).cast("bigint").alias("turn"), F.col("audit").alias("role"), F.lit("").alias("text"), F.lit(0).cast("bigint").alias("copies"))
    rows = marked.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", "text", "copies")
    order = ["conv_id", "is_row", "turn", "role", "text"]
    dealt = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order)

    def insert(state):
        return "I", ROLES[NEXT[state]], ""

    def replay(batches):
        audit, at, state, conv, begun = "", 0, START, None, False

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                yield conv, insert(state)
                state, at = NEXT[state], at + 1

        for batch in batches:
            for c, is_row, role, text, copies in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "is_row", "role", "text", "copies")), strict=True):
                if not is_row:
                    yield from inserts()
                    if begun:
                        yield conv, None
                    conv, audit, at, state, begun = c, role, 0, START, True
                for _ in range(copies):
                    yield from inserts()
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    if edit == "K":
                        yield conv, ("K", role, text)
                        state = SYSTEM if role[:1] == "s" else NEXT[state]
                    else:
                        yield conv, ("R", ROLES[NEXT[state]], text)
                        state = NEXT[state]
        yield from inserts()
        if begun:
            yield conv, None

    return dealt.mapInArrow(lambda batches: emit(replay(batches)), ddl)


def repaired_rows(plans: DataFrame, marked: DataFrame) -> DataFrame:
    """The conversations after their plans: ``conv_id``, ``place`` (from 0), ``edit`` (K, R or I), ``role``, ``text``."""

    def emit(events):
        rows, size, place = [], 0, 0
        for conv, row in events:
            if row is None:
                place = 0
                continue
            rows.append((conv, place, *row))
            place, size = place + 1, size + len(row[2])
            if len(rows) == 10_000 or size > 1 << 24:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    def batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv_id", "place", "edit", "role", "text"])

    return _replayed(plans, marked, emit, "conv_id bigint, place bigint, edit string, role string, text string")


def repaired_digests(plans: DataFrame, marked: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``, of ``role:text`` of the repaired rows, joined by newlines."""

    def emit(events):
        found, digest, first = [], hashlib.sha256(), True
        for conv, row in events:
            if row is None:
                found.append((conv, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(found) == 10_000:
                    yield batch(found)
                    found = []
                continue
            digest.update(f"{'' if first else chr(10)}{row[1]}:{row[2]}".encode())
            first = False
        if found:
            yield batch(found)

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())], names=["conv_id", "repaired_sha256"])

    return _replayed(plans, marked, emit, "conv_id bigint, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` after the damage of the query: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2
    takes ``.!?`` out of it, 3 repeats it and 4 makes it the user's. Nulls are one space there."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(as_text[0], F.lit(":"), as_text[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    out = rows.filter(kind != 0)
    return out.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its digest of every conversation after damage.

    A conversation of which nothing is left has zeros, no edits and the digest of nothing. Rows alike are copies.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    plans, marked = plans_of(damaged(rows))
    digests = stored(repaired_digests(plans, marked), "digests")
    release(spark)
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    found = join_null_safe(join_null_safe(every, plans, ["conv_id"], "left"), digests, ["conv_id"], "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return found.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _sql() -> str:
    """The same by a recursion over the rows of all conversations; a state's weight is its cost in nine digits, then the letters."""

    def edit(value: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST(substr({value}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}'"

    def when(test: str, value: str) -> str:
        return f"CASE WHEN {test} THEN {value} END"

    extra = f"(CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END)"
    stays = "fault NOT IN ('blank', 'duplicate')"
    before_user = "least(b0, b1, b3)"
    rerole = f"({extra} + {REROLE})"
    space = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE
t AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
s AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
k AS (SELECT s.*, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM s, t),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM k, range(2) AS copy(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, substr(role, 1, 1) AS ini, trim(text, {space}) AS body, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM i),
r AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM f),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
p AS (SELECT conv_id, 0 AS i, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, CAST(NULL AS VARCHAR) AS v2, CAST(NULL AS VARCHAR) AS v3 FROM c
      UNION ALL
      SELECT conv_id, i, {edit("b0", str(DELETE), "D")},
        least({edit("b1", str(DELETE), "D")}, {when(f"{stays} AND ini = 's'", edit("b0", extra, "K"))}),
        least({edit("b2", str(DELETE), "D")}, {when(stays, edit(before_user, rerole, "R"))}, {when(f"{stays} AND ini = 'u'", edit(before_user, extra, "K"))}),
        least({edit("b3", str(DELETE), "D")}, {when(stays, edit("b2", rerole, "R"))}, {when(f"{stays} AND ini = 'a'", edit("b2", extra, "K"))})
      FROM (SELECT p.conv_id, r.i, r.ini, r.fault, v0 AS b0, v1 AS b1, least(v2, {edit("least(v0, v1, v3)", str(INSERT), "I")}) AS b2,
              least(v3, {edit("v2", str(INSERT), "I")}) AS b3
            FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1)),
e AS (SELECT p.conv_id, least(v0, v3, {edit("v2", str(INSERT), "I")}) AS v FROM p JOIN c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n),
l AS (SELECT conv_id, substr(v, 10) AS audit, unnest(range(1, length(v) - 8)) AS j FROM e),
m AS (SELECT conv_id, j, substr(audit, CAST(j AS BIGINT), 1) AS op FROM l),
o AS (SELECT *, sum(CASE WHEN op = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN op = 'D' THEN 0 ELSE 1 END) OVER w AS place
      FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY j ROWS UNBOUNDED PRECEDING)),
q AS (SELECT o.conv_id, o.j, o.op, o.place, r.role, r.text, r.ini FROM o LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND o.i = r.i AND o.op <> 'I'
      WHERE o.op <> 'D'),
y AS (SELECT *, max(CASE WHEN place = 1 AND op = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM q),
z AS (SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (place - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS x
      FROM y GROUP BY conv_id),
a AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       CAST(coalesce(CAST(substr(v, 1, 9) AS INT), 0) AS BIGINT) AS cost, coalesce(substr(v, 10), '') AS audit, sha256(coalesce(x, '')) AS repaired_sha256
FROM a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN z ON a.conv_id IS NOT DISTINCT FROM z.conv_id
"""


OP13_SQL = _sql()
