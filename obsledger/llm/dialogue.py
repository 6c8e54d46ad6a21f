"""Repair of conversations: the cheapest edits that make the turns alternate, by iterative-deepening A*.

A sound conversation is empty, or an optional system turn and then pairs of user and assistant turns. Four edits lead
there: Delete a row, Insert an empty user or assistant turn, Keep a row, Rerole it to user or assistant. The
audit is the edits' initials in order; of the cheapest audits the least in ASCII order counts.

The search walks depth first through (row, state of the pattern), tries the edits in ASCII order under a cost bound and
raises the bound until a path is accepted; a table remembers with how much money a place has failed. Long conversations
are searched in blocks from the last to the first: what a block's end costs from each state of the pattern is known
exactly from the blocks behind it, so the joined paths are the cheapest of the whole, and the least in order.

Rows pass through Spark sorted by conversation and turn (nulls first, ties by role and digest of the text). No task holds
a conversation's texts: the search holds one byte for each row, the second pass one row and the audit. Identical rows are
counted before they are shuffled; so are turns said earlier, which are found by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

BLANKS = " \t\n\x0b\x0c\r"
CLOSERS = ".!?"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLOCK = 64  # rows searched at once
# The pattern: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; accepted at 0 and 3.
STEPS = ((2, None, 1, None), (2, None, None, None), (None, 3, None, None), (2, None, None, None))  # by state and u, a, s, other
NEXT = (2, 2, 3, 2)  # where an inserted or reroled turn leads
TAIL = ("", "II", "I", "")  # inserts that end a conversation from each state
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3


def search(codes: bytes, start: int, ends: list[int], tried: dict[int, int]) -> tuple[int, str, int]:
    """Cost, audit and last state of the cheapest path over a block of rows, least in ASCII order.

    A code is the role (0 user, 1 assistant, 2 system, 3 other) plus four times the fault. ``ends`` is what each state costs
    behind the block; ``tried`` holds for 4 x row + state the most money with which it has failed.
    """
    n = len(codes)
    later = [[min(ends)] * (n + 1), [min(ends)] * (n + 1)]  # least cost still to come: at the start, and after it
    for i in range(n - 1, -1, -1):
        role, fault = codes[i] & 3, codes[i] >> 2
        least = DELETE if fault else REROLE if role == 3 else 0
        later[0][i] = later[0][i + 1] + least
        later[1][i] = later[1][i + 1] + (least or (REROLE if role == 2 else 0))
    path: list[str] = []

    def walk(i: int, state: int, money: int) -> int:
        """Last state of the first accepted path, or -1."""
        if i == n:
            return state if ends[state] <= money else -1
        if later[state > 0][i] > money or tried.get(4 * i + state, -1) >= money:
            return -1
        role, fault = codes[i] & 3, codes[i] >> 2
        extra = TRUNCATED if fault == CUT else 0
        moves = [("D", i + 1, state, DELETE), ("I", i, NEXT[state], INSERT)]
        if fault in (NONE, CUT):
            if STEPS[state][role] is not None:
                moves.append(("K", i + 1, STEPS[state][role], extra))
            moves.append(("R", i + 1, NEXT[state], REROLE + extra))
        for initial, following, reached, cost in moves:
            if cost <= money:
                path.append(initial)
                last = walk(following, reached, money - cost)
                if last >= 0:
                    return last
                path.pop()
        tried[4 * i + state] = money
        return -1

    bound = later[start > 0][0]
    while (last := walk(0, start, bound)) < 0:
        bound += 1
    return bound, "".join(path), last


def cheapest(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a whole conversation, searched in blocks from its end."""
    ends, found = [INSERT * len(t) for t in TAIL], []
    for at in range((len(codes) - 1) // block * block if codes else 0, -1, -block):
        tried: dict[int, int] = {}
        part = codes[at:at + block]
        found.append([search(part, state, ends, tried) if at or not state else (0, "", 0) for state in range(4)])
        ends = [cost for cost, _, _ in found[-1]]
    state, audit = 0, []
    for paths in reversed(found):
        _, edits, state = paths[state]
        audit.append(edits)
    return ends[0], "".join(audit) + TAIL[state]


def _space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the CRC-32 of ``conv_id:turn``: a test of the repair.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's.
    Nulls count as one space.
    """
    kind = F.crc32(F.concat(_space(rows[conv_id]), F.lit(":"), _space(rows[turn])).cast("binary")) % 20
    said = _space(rows[text])
    return rows.where(kind != 0).select(
        rows[conv_id].alias("conv_id"), rows[turn].alias("turn"), F.when(kind == 4, "user").otherwise(_space(rows[role])).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, CLOSERS, "")).otherwise(said).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _plain(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns under fixed names, and a digest of role and text."""
    out = rows.select(rows[conv_id].alias("conv_id"), rows[turn].alias("turn"), _space(rows[role]).alias("role"), _space(rows[text]).alias("text"))
    return out.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Conversations whole in a partition, sorted."""
    return rows.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in (*first, "turn", "role", "digest")])


def plan(rows: DataFrame, conversations: DataFrame | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs) and audit.

    A row's first fault counts: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), truncated
    (its last character is no sentence end). Blank rows and duplicates must go; a truncated row that stays adds 5. ``gaps`` counts
    missing turn numbers between the least and the greatest (null turns left out), ``illegal`` neighbours whose role initials
    are not su, ua or au. Ids of ``conversations`` (its first column) without rows give zeros and an empty audit. A null id is
    a conversation like any other; null roles and texts count as one space; other columns are ignored; no rows give none.
    """
    plain = _plain(rows, conv_id, turn, role, text)
    spoken = F.rtrim(F.col("text"), F.lit(BLANKS))
    who = F.substring("role", 1, 1)
    slim = plain.select(
        "conv_id", "turn", "role", "digest",
        F.when(who == "u", 0).when(who == "a", 1).when(who == "s", 2).otherwise(3).alias("who"),
        F.when(spoken == "", BLANK).when(F.instr(F.lit(CLOSERS), F.substring(spoken, -1, 1)) == 0, CUT).otherwise(NONE).alias("fault"))
    counted = slim.groupBy(*slim.columns).agg(F.count(F.lit(1)).alias("times"))
    said = Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())
    seen = counted.withColumn("first", F.row_number().over(said) == 1)
    if conversations is not None:
        ids = conversations.select(F.col(conversations.columns[0]).alias("conv_id")).distinct()
        seen = seen.unionByName(ids.withColumn("times", F.lit(0)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repaired = lru_cache(4096)(cheapest)
        held: list = []  # the conversation, its codes, least and greatest turn, distinct turns
        out: list[tuple] = []

        def close() -> None:
            key, codes, low, high, distinct = held
            counts = [sum(1 for c in codes if c >> 2 == f) for f in (BLANK, DUPLICATE, CUT)]
            whose = bytes(c & 3 for c in codes)
            legal = sum(1 for pair in zip(whose, whose[1:]) if pair in {(2, 0), (0, 1), (1, 0)})
            cost, audit = repaired(bytes(codes)) if len(codes) <= BLOCK else cheapest(bytes(codes))
            out.append((key, 0 if low is None else high - low + 1 - distinct, *counts, max(len(codes) - 1, 0) - legal, cost, audit))

        for batch in batches:
            for key, at, who, fault, times, first in zip(*[batch.column(c).to_pylist() for c in range(6)]):
                if not held or held[0] != key:
                    if held:
                        close()
                    held = [key, bytearray(), None, None, 0]
                if not times:
                    continue
                if at is not None:
                    held[4] += at != held[3]
                    held[2], held[3] = at if held[2] is None else held[2], at
                repeated = who | 4 * (fault if fault == BLANK else DUPLICATE)
                held[1].append(who | 4 * fault if first else repeated)
                held[1].extend(bytes([repeated]) * (times - 1))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)
                out = []
        if held:
            close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], arrow)

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    schema = StructType([StructField("conv_id", plain.schema["conv_id"].dataType),
                         *StructType.fromDDL(", ".join(f"{n} long" for n in names[1:7]) + ", audit string").fields])
    arrow = to_arrow_schema(schema)
    return _in_order(seen, "conv_id").select("conv_id", F.col("turn").cast("long"), "who", "fault", "times", "first").mapInArrow(run, schema)


def _replayed(rows: DataFrame, plans: DataFrame, names: tuple, schema: StructType, work: Callable) -> DataFrame:
    """Rows and plans side by side, sorted: ``work`` gets each partition's (key, plan's columns or None, role, text)."""
    carried = F.struct(*[plans[c] for c in plans.columns if c != "conv_id"])
    both = _plain(rows, *names).unionByName(plans.select("conv_id", carried.alias("plan")), allowMissingColumns=True)
    both = both.withColumn("kind", F.col("plan").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in range(4)]))
        yield from work(rows)

    return _in_order(both, "conv_id", "kind").select("conv_id", "plan", "role", "text").mapInArrow(run, schema)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Plans and repaired turns in order: (key, plan) at a conversation's start, then (key, None, role, text) for each turn."""
    key, edits, state, edit = None, iter(""), 0, ""

    def inserts() -> Iterator[tuple]:
        """Turns inserted before the next edit of a row, which is left in ``edit``."""
        nonlocal state, edit
        for edit in edits:
            if edit != "I":
                break
            state = NEXT[state]
            yield key, None, "user" if state == 2 else "assistant", ""
        else:
            edit = ""

    for at, planned, role, text in rows:
        if planned is not None:
            yield from inserts()
            key, edits, state = at, iter(planned["audit"]), 0
            yield key, planned
            continue
        yield from inserts()
        if edit == "K":
            state = STEPS[state][{"u": 0, "a": 1, "s": 2}[role[:1]]]
            yield key, None, role, text
        elif edit == "R":
            state = NEXT[state]
            yield key, None, "user" if state == 2 else "assistant", text
    yield from inserts()


def repaired_turns(rows: DataFrame, plans: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text. ``plans`` is what ``plan`` returned for the same rows."""
    kind = StructField("conv_id", rows.schema[conv_id].dataType)
    schema = StructType([kind, *StructType.fromDDL("place long, role string, text string").fields])
    arrow = to_arrow_schema(schema)

    def work(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out, place, size = [], 0, 0
        for row in _edited(found):
            if len(row) == 2:
                place = 0
                continue
            out.append((row[0], place, row[2], row[3]))
            place, size = place + 1, size + len(row[3]) + 50
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], arrow.names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], arrow.names)

    return _replayed(rows, plans, (conv_id, turn, role, text), schema, work)


def with_digest(rows: DataFrame, plans: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """``plans`` with repaired_sha256: SHA-256 of the repaired ``role:text`` lines, joined by newlines (no turns: of nothing)."""
    schema = StructType([*plans.schema.fields, *StructType.fromDDL("repaired_sha256 string").fields])
    arrow = to_arrow_schema(schema)

    def work(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        key = planned = state = None
        lines = 0

        def close() -> None:
            out.append({"conv_id": key, **planned, "repaired_sha256": state.hexdigest()})

        for row in _edited(found):
            if len(row) == 2:
                if planned is not None:
                    close()
                (key, planned), state, lines = row, hashlib.sha256(), 0
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out = []
            else:
                state.update(("\n" * bool(lines) + f"{row[2]}:{row[3]}").encode("utf-8"))
                lines += 1
        if planned is not None:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return _replayed(rows, plans, (conv_id, turn, role, text), schema, work)
