"""Operator 12: repair of conversations by an auction for shortest paths.

A conversation's rows and the four states of its role pattern span a lattice: node
(i, state) stands before row i.  Keeping, changing the role of, deleting and inserting
a row are arcs of whole-number costs; a cheapest repair is a shortest path.  The
auction keeps a price per node that never exceeds an arc's cost plus the price at its
end, and a path from the start that it lengthens along an arc that meets this bound
with equality, or shortens while raising the price of its last node.  Prices start at
what every path must pay, the forced deletions and truncated rows that lie ahead.
When the path arrives, every shortest path consists of tight arcs, which are
searched depth first in the order of the edits' letters: the first path found is the
least of them.

Long conversations are cut into chunks; prices at the end of one are the shortest
distances from the start of the next, so the result is that of one lattice.

Rows are range-partitioned by conversation and turn, so a hot conversation spreads over
many tasks.  One that lies within a task and is short is settled there.  The others
(two per task at most, and long ones) are open: their duplicates are found by one
aggregation, each task's share is folded to the 16 distances between its end states,
these few numbers per share go back along the conversation, every share is traced
from each state, and the states go forth again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .tables import table, written

# Costs of the edits, and what a truncated row adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
WHITE_CHARACTERS = " \t\n\x0b\x0c\r"
DAMAGES = 20
CHUNK = 64
BLOCK = 256
LONGEST = 4096
ROWS_OUT = 256
NEVER = 1 << 60

# States of a repaired conversation: nothing yet, after a system turn, after a user, after an assistant.
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Where the one turn that may be made in a state leads, and where a kept initial leads.
MADE = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# The inserts that complete a conversation in each state, and their costs.
TAIL = ("", "II", "I", "")
COMPLETE = tuple(INSERT * len(edits) for edits in TAIL)

# A row's letter: its role's initial, upper case where it is truncated, x where it must go.
FORCED = "x"


def _least(letter: str) -> int:
    return DELETE if letter == FORCED else TRUNCATED if letter.isupper() else 0


def _arcs(code: str, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """Edits before or at row i in the order of their letters: letter, cost, next row, next state."""
    letter = code[i]
    yield "D", DELETE, i + 1, state
    yield "I", INSERT, i, MADE[state]
    if letter == FORCED:
        return
    extra = TRUNCATED if letter.isupper() else 0
    to = KEPT.get(letter.lower(), {}).get(state)
    if to is not None:
        yield "K", extra, i + 1, to
    yield "R", REROLE + extra, i + 1, MADE[state]


class Lattice:
    """The lattice of a chunk's rows with a price at each of its end states (none: not allowed)."""

    def __init__(self, code: str, ends: Sequence[int | None]):
        n = len(code)
        self._target = 4 * (n + 1)
        self._arcs = [
            [(cost, 4 * j + to, edit) for edit, cost, j, to in _arcs(code, i, state)]
            for i in range(n)
            for state in STATES
        ]
        self._arcs += [[] if end is None else [(end, self._target, "")] for end in ends]
        ahead = min(end for end in ends if end is not None)
        self._price = [ahead] * 4 + [0]
        for letter in reversed(code):
            ahead += _least(letter)
            self._price[:0] = [ahead] * 4

    def distance(self, origin: int) -> int:
        """The auction from a state before the first row; its price becomes the shortest distance."""
        price, path = self._price, [origin]
        while True:
            node = path[-1]
            best, to = NEVER, None
            for cost, end, _ in self._arcs[node]:
                if cost + price[end] < best:
                    best, to = cost + price[end], end
            if price[node] < best:
                price[node] = best
                if node != origin:
                    path.pop()
            elif to == self._target:
                return price[origin]
            else:
                path.append(to)

    def trace(self, origin: int) -> tuple[str, int]:
        """The least word of edits along tight arcs, and the state it ends in."""
        price, dead = self._price, set()
        path, edits = [origin], []
        choices = [iter(self._arcs[origin])]
        while True:
            for cost, end, edit in choices[-1]:
                if end not in dead and price[path[-1]] == cost + price[end]:
                    if end == self._target:
                        return "".join(edits), path[-1] % 4
                    path.append(end)
                    edits.append(edit)
                    choices.append(iter(self._arcs[end]))
                    break
            else:
                choices.pop()
                dead.add(path.pop())
                edits.pop()


@lru_cache(maxsize=50_000)
def _solved(code: str, ends: tuple[int | None, ...], origins: tuple[int, ...]) -> tuple:
    """Distance, edits and end state from each origin; equal chunks are solved once."""
    lattice = Lattice(code, ends)
    return tuple((lattice.distance(state), *lattice.trace(state)) for state in origins)


def _chunk(code: str, ends: Sequence[int | None], origins: Sequence[int]) -> list[tuple[int, str, int]]:
    low = min(end for end in ends if end is not None)
    level = tuple(None if end is None else end - low for end in ends)
    return [(cost + low, edits, end) for cost, edits, end in _solved(code, level, tuple(origins))]


def _chunks(code: str) -> list[str]:
    return [code[i : i + CHUNK] for i in range(0, len(code), CHUNK)]


def _backwards(code: str, ends: Sequence[int | None]) -> list[list[int | None]]:
    """Prices before every chunk of a code and, last, behind it."""
    prices = [list(ends)]
    for part in reversed(_chunks(code)):
        prices.append([cost for cost, _, _ in _chunk(part, prices[-1], STATES)])
    return prices[::-1]


def cheapest(code: str, ends: Sequence[int] = COMPLETE, origin: int = START) -> tuple[int, list[str], int]:
    """Cost of the cheapest repair, the edits of each chunk, and the state after the last row.

    The cost includes the price of that state; the inserts that it stands for are not
    among the edits.
    """
    parts = _chunks(code)
    if len(parts) <= 1:
        if not parts:
            return ends[origin], [], origin
        cost, edits, end = _chunk(code, ends, (origin,))[0]
        return cost, [edits], end
    prices, pieces, state = _backwards(code, ends), [], origin
    for part, behind in zip(parts, prices[1:], strict=True):
        _, edits, state = _chunk(part, behind, STATES)[state]
        pieces.append(edits)
    return prices[0][origin], pieces, state


def distances(code: str) -> list[int]:
    """Shortest distances from every state before the rows to every state behind them, row by row."""
    n, kept = len(code), (0 if "s" in code else TRUNCATED if "S" in code else NEVER)
    # The first two states are left for good, so they are reached by deletions alone or a kept system row.
    to_start = [DELETE * n, NEVER, NEVER, NEVER]
    to_system = [min(DELETE * (n - 1) + kept, NEVER), DELETE * n, NEVER, NEVER]
    rest = []
    for end in (USER, ASSISTANT):
        rest.append(_backwards(code, [0 if state == end else None for state in STATES])[0])
    columns = [to_start, to_system, *rest]
    return [columns[end][state] for state in STATES for end in STATES]


def apply_edits(rows: Sequence[tuple[str, str]], edits: str, state: int) -> list[tuple[str, str]]:
    """The rows (role, text) that the edits leave or make, beginning in a state."""
    out, at = [], 0
    for edit in edits:
        if edit == "I":
            state = MADE[state]
            out.append((ROLES[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if edit == "K":
            state = KEPT[role[0]][state]
            out.append((role, text))
        elif edit == "R":
            state = MADE[state]
            out.append((ROLES[state], text))
    return out


def _structs(rows: Sequence[tuple[str, str]]) -> list[dict]:
    return [{"role": role, "text": text} for role, text in rows]


def split_edits(edits: str, sizes: Sequence[int]) -> list[str]:
    """Cut edits where the given numbers of rows end; inserts belong to the row behind them."""
    pieces, at = [], 0
    for size in sizes:
        start = at
        while size:
            size -= edits[at] != "I"
            at += 1
        pieces.append(edits[start:at])
    return pieces


def row_letter(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """A row's letter in the lattice and its first fault (blank, duplicate, truncated or none)."""
    shown = text.rstrip(WHITE_CHARACTERS)
    if not shown:
        return FORCED, "blank"
    if repeated:
        return FORCED, "duplicate"
    letter = role[:1] if role[:1] in KEPT else "o"
    return (letter, "") if shown[-1] in ".!?" else (letter.upper(), "truncated")


LEGAL = {"su", "ua", "au"}
REPAIRED = "repaired array<struct<role:string,text:string>>"
COUNTS = "rows bigint, turns bigint, first_turn {turn}, last_turn {turn}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_role string, last_role string"
FAULTS = ("blank", "duplicate", "truncated")


def _counts(rows: Sequence[tuple], faults: Sequence[str]) -> dict:
    """Counts of consecutive rows (turn, role, text); turns are in order, without one first."""
    turns = [turn for turn, _, _ in rows if turn is not None]
    initials = [role[:1] for _, role, _ in rows]
    return {
        "rows": len(rows),
        "turns": len(set(turns)),
        "first_turn": turns[0] if turns else None,
        "last_turn": turns[-1] if turns else None,
        **{fault: sum(f == fault for f in faults) for fault in FAULTS},
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
        "first_role": initials[0] if rows else None,
        "last_role": initials[-1] if rows else None,
    }


def _settled(rows: list[tuple]) -> dict:
    """Counts and repair of one whole conversation."""
    seen, letters, faults = set(), [], []
    for _, role, text in rows:
        letter, fault = row_letter(role, text, (role, text) in seen)
        seen.add((role, text))
        letters.append(letter)
        faults.append(fault)
    cost, pieces, state = cheapest("".join(letters))
    edits = "".join(pieces) + TAIL[state]
    repaired = _structs(apply_edits([row[1:] for row in rows], edits, START))
    return {"cost": cost, "edits": edits, "repaired": repaired, **_counts(rows, faults)}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True)


def _conversations(rows: Iterator[tuple], longest: int) -> Iterator[tuple[object, list[tuple], bool, bool]]:
    """Runs of rows of one conversation, cut at ``longest``; whether it begins and whether it ends there."""
    for conv_id, group in groupby(rows, key=lambda row: row[0]):
        part, begins = [], True
        for _, turn, role, text, real in group:
            if len(part) >= longest:
                yield conv_id, part, begins, False
                part, begins = [], False
            if real:
                part.append((turn, role, text))
        yield conv_id, part, begins, True


def _first_pass(
    batches: Iterator[pa.RecordBatch], schema: pa.Schema, size: int, longest: int
) -> Iterator[pa.RecordBatch]:
    """Settle the conversations inside a task; pass on the blocks of the others."""
    task, number, out = TaskContext.get().partitionId(), 0, []
    found = _conversations(_rows(batches), longest)
    current, first = next(found, None), True
    while current is not None:
        conv_id, rows, begins, ends = current
        current = next(found, None)
        if begins and ends and not first and current is not None:
            out.append({"conv_id": conv_id, "open": False, **_settled(rows)})
        else:
            for at in range(0, max(len(rows), 1), size):
                block = [{"turn": t, "role": r, "text": x} for t, r, x in rows[at : at + size]]
                out.append({"conv_id": conv_id, "open": True, "task": task, "block": number, "block_rows": block})
                number += 1
        first = first and not ends
        if len(out) >= ROWS_OUT:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def repair(
    turns: DataFrame, partitions: int | None = None, block: int = BLOCK, longest: int = LONGEST
) -> DataFrame:
    """Cheapest repairs of conversations: one row per conversation, or several parts of an open one.

    ``turns`` has ``conv_id``, ``turn`` (a whole number), ``role``, ``text`` and, where
    wanted, ``real``: false marks a row that only names its conversation.  Other columns
    are left out, whatever their names.  Null roles and texts count as one space and
    null ids as one conversation of their own; null turns come first.  Rows of one turn
    stand in the order of a hash of role and text, and equal rows side by side, all but the
    first of them duplicates.  Empty and blank texts are faults; texts of any length are
    kept whole.  A role without or with another initial than s, u or a is never legal.
    An empty table gives an empty one.  ``block`` rows of an open conversation make a part;
    more than ``longest`` rows make a conversation open.

    Returned per part: ``conv_id``, ``part`` (in order within a conversation), counts
    (rows, distinct turns and their ends, first faults, illegal neighbours, first and
    last initial), ``edits`` and ``repaired`` rows, and the ``cost`` of the conversation.
    ``whole`` tells that a part is all of its conversation.
    """
    spark = turns.sparkSession
    if "real" not in turns.columns:
        turns = turns.withColumn("real", F.lit(True))
    rows = turns.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), "real")
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Copies of a row are alike, so the task that read them may tell them apart.
    place = ["conv_id", "turn", "_hash", "_copy"]
    ordered = (
        rows.withColumns({"_hash": F.xxhash64("role", "text"), "_copy": F.spark_partition_id()})
        .repartitionByRange(partitions, *place)
        .sortWithinPartitions(*place, "role", "text")
        .select("conv_id", "turn", "role", "text", "real")
    )
    ids, turn = StructField("conv_id", rows.schema["conv_id"].dataType), rows.schema["turn"].dataType
    counts = COUNTS.format(turn=turn.simpleString())
    more = f"cost bigint, edits string, {REPAIRED}, {counts}"
    rows_of = f"task int, block int, block_rows array<struct<turn:{turn.simpleString()},role:string,text:string>>"
    schema = StructType([ids, *StructType.fromDDL(f"open boolean, {rows_of}, {more}")])
    arrow = to_arrow_schema(schema)
    passed = ordered.mapInArrow(lambda batches: _first_pass(batches, arrow, block, longest), schema)
    passed = written(passed, "conversations")
    names = [field.name for field in StructType.fromDDL(more)]
    closed = passed.where("not open").select("conv_id", F.lit(0).cast("long").alias("part"), F.lit(True).alias("whole"), *names)
    blocks = passed.where("open").select("conv_id", "task", "block", "block_rows")
    schema = StructType([ids, *StructType.fromDDL(f"part bigint, whole boolean, {more}")])
    return closed.unionByName(_open_parts(blocks, schema, ids))


SHARE = ["conv_id", "task"]
HERE = [*SHARE, "block"]


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null ids match each other; the right side's keys go."""
    renamed = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    condition = same[0]
    for one in same[1:]:
        condition &= one
    return left.join(renamed, condition, how).drop(*[f"_{key}" for key in keys])


def _open_parts(blocks: DataFrame, schema: StructType, ids: StructField) -> DataFrame:
    """Repairs of conversations that lie in several tasks or are long, a part per block."""
    flagged = written(_with_duplicates(blocks), "flagged")
    coded_schema = StructType([ids, *StructType.fromDDL("task int, block int, rows int, code string")])
    arrow = to_arrow_schema(coded_schema)
    codes = flagged.select(*HERE, "block_rows", "repeated").mapInArrow(lambda batches: _codes(batches, arrow), coded_schema)
    coded = written(codes, "codes")
    # A share is what one task of the first pass read of a conversation, a letter a row.
    folded_schema = StructType([ids, *StructType.fromDDL("task int, matrix array<bigint>")])
    folded = coded.groupBy(*SHARE).applyInPandas(_fold, folded_schema)
    priced_schema = StructType([ids, *StructType.fromDDL("task int, cost bigint, ends array<bigint>")])
    priced = written(folded.groupBy("conv_id").applyInPandas(_prices, priced_schema), "prices")
    traced_schema = StructType([ids, *StructType.fromDDL("task int, block int, origin int, entry int, edits string, to int")])
    # The prices of a share ride on its blocks, four numbers each.
    traced = written(
        _joined(coded, priced.select(*SHARE, "ends"), SHARE).groupBy(*SHARE).applyInPandas(_trace, traced_schema),
        "traced",
    )
    shares = traced.groupBy(*SHARE, "origin").agg(F.max_by("to", "block").alias("to"))
    entry_schema = StructType([ids, *StructType.fromDDL("task int, origin int, final int")])
    entries = written(shares.groupBy("conv_id").applyInPandas(_entries, entry_schema), "entries")
    chosen = _joined(traced, entries.drop("final"), [*SHARE, "origin"])
    parts = _joined(_joined(flagged, chosen, HERE), priced.select(*SHARE, "cost"), SHARE)
    arrow = to_arrow_schema(schema)
    # A row per block, and one for the inserts that close a conversation.
    closing = entries.where(F.col("final").isin(SYSTEM, USER)).select("conv_id", "final").distinct()
    return (
        parts.select(*HERE, "block_rows", "repeated", "entry", "edits", "cost")
        .mapInArrow(lambda batches: _parts(batches, arrow), schema)
        .unionByName(closing.mapInArrow(lambda batches: _closing(batches, arrow), schema))
    )


def _with_duplicates(blocks: DataFrame) -> DataFrame:
    """Blocks with the places of rows whose role and text an earlier row of the conversation has."""
    rows = blocks.select(*HERE, F.posexplode("block_rows").alias("at", "row")).select(
        *HERE,
        "at",
        F.md5(F.concat(F.length("row.role").cast("string"), F.lit(":"), "row.role", "row.text")).alias("same"),
    )
    place = F.struct("task", "block", "at")
    first = rows.groupBy("conv_id", "same").agg(F.min(place).alias("first"))
    later = _joined(rows, first, ["conv_id", "same"]).where(place > F.col("first"))
    places = later.groupBy(*HERE).agg(F.collect_list("at").alias("repeated"))  # as many as a block has rows
    return _joined(blocks, places, HERE, "left")


def _letters(rows: list[dict], repeated: list[int] | None) -> tuple[str, list[str]]:
    again = set(repeated or ())
    pairs = [row_letter(row["role"], row["text"], i in again) for i, row in enumerate(rows)]
    return "".join(letter for letter, _ in pairs), [fault for _, fault in pairs]


def _codes(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            code, _ = _letters(row["block_rows"], row["repeated"])
            out.append({**{key: row[key] for key in HERE}, "rows": len(code), "code": code})
        yield pa.RecordBatch.from_pylist(out, schema)


def _key(frame: pd.DataFrame) -> dict:
    return {"conv_id": frame["conv_id"].iloc[0]}


def _fold(share: pd.DataFrame) -> pd.DataFrame:
    code = "".join(share.sort_values("block")["code"])
    matrix = distances(code) if code else [0 if a == b else NEVER for a in STATES for b in STATES]
    return pd.DataFrame([{**_key(share), "task": share["task"].iloc[0], "matrix": matrix}])


def _prices(shares: pd.DataFrame) -> pd.DataFrame:
    """What the rest of the conversation costs from each state behind a share; a row per task at most."""
    shares = shares.sort_values("task", ascending=False)
    ends, out = list(COMPLETE), []
    for task, matrix in zip(shares["task"], shares["matrix"], strict=True):
        out.append({**_key(shares), "task": task, "ends": ends})
        ends = [min(int(matrix[4 * a + b]) + ends[b] for b in STATES) for a in STATES]
    frame = pd.DataFrame(out)
    frame["cost"] = ends[START]
    return frame[["conv_id", "task", "cost", "ends"]]


def _trace(share: pd.DataFrame) -> pd.DataFrame:
    """Edits of every block of a share from each state that it may be entered in."""
    share = share.sort_values("block")
    code, sizes = "".join(share["code"]), share["rows"].tolist()
    ends, out = [int(end) for end in share["ends"].iloc[0]], []
    for origin in STATES:
        _, pieces, _ = cheapest(code, ends, origin)
        state, row = origin, 0
        for block, size, edits in zip(share["block"], sizes, split_edits("".join(pieces), sizes), strict=True):
            entry = state
            for edit in edits:
                if edit in "IR":
                    state = MADE[state]
                elif edit == "K":
                    state = KEPT[code[row].lower()][state]
                row += edit != "I"
            out.append((block, origin, entry, edits, state))
    frame = pd.DataFrame(out, columns=["block", "origin", "entry", "edits", "to"])
    frame.insert(0, "task", share["task"].iloc[0])
    frame.insert(0, "conv_id", share["conv_id"].iloc[0])
    return frame


def _entries(shares: pd.DataFrame) -> pd.DataFrame:
    """The state in which each share of a conversation is entered, and the state at the very end."""
    state, out = START, []
    for task, of in shares.sort_values("task").groupby("task"):
        out.append((task, state))
        state = int(of.loc[of["origin"] == state, "to"].iloc[0])
    frame = pd.DataFrame(out, columns=["task", "origin"])
    frame["final"] = state
    frame.insert(0, "conv_id", shares["conv_id"].iloc[0])
    return frame


def _parts(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repaired rows and counts of each block."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            rows = [(r["turn"], r["role"], r["text"]) for r in row["block_rows"]]
            _, faults = _letters(row["block_rows"], row["repeated"])
            part = {key: row[key] for key in ("conv_id", "cost", "edits")}
            part |= {"part": (row["task"] << 32) + row["block"], "whole": False, **_counts(rows, faults)}
            part["repaired"] = _structs(apply_edits([row[1:] for row in rows], row["edits"], row["entry"]))
            out.append(part)
        yield pa.RecordBatch.from_pylist(out, schema)


def _closing(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The inserts behind the last rows of conversations."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            edits = TAIL[row["final"]]
            part = {"conv_id": row["conv_id"], "part": NEVER, "whole": False, "edits": edits, **_counts([], [])}
            out.append(part | {"repaired": _structs(apply_edits([], edits, row["final"]))})
        yield pa.RecordBatch.from_pylist(out, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """The damage of op12: a fate per row from the checksum of its id and turn; see its contract.

    A dropped row stays as one that only names its conversation.
    """
    fate = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % DAMAGES
    role, text = _text("role"), _text("text")
    shorn = F.when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return turns.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate < 2, "").otherwise(shorn).alias("text"),
        (fate != 0).alias("real"),
        F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    ).drop("_copy")


RESULT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def digests(parts: DataFrame) -> DataFrame:
    """One row per conversation with the digests of op12.

    The digest of a conversation in parts runs over them in order; it keeps its state, not the rows.
    """
    names = [field.name for field in StructType.fromDDL(RESULT)]
    line = F.transform("repaired", lambda row: F.concat(row["role"], F.lit(":"), row["text"]))
    gaps = F.col("last_turn").cast("long") - F.col("first_turn") + 1 - F.col("turns")
    whole = parts.where("whole").select(
        "conv_id",
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *FAULTS,
        "illegal",
        "cost",
        F.col("edits").alias("audit"),
        F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"),
    )
    rows = parts.where("not whole").select(
        "conv_id", "part", "turns", "first_turn", "last_turn", *FAULTS, "illegal",
        "first_role", "last_role", "cost", "edits", "repaired",
    )
    schema = StructType([parts.schema["conv_id"], *StructType.fromDDL(RESULT)])
    arrow = to_arrow_schema(schema)
    # Where many small parts of many conversations meet, each conversation is one stream.
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    joined = ordered.mapInArrow(lambda batches: _streamed(batches, arrow), schema)
    return whole.unionByName(joined.select("conv_id", *names))


def _streamed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = chain.from_iterable(batch.to_pylist() for batch in batches)
    out = [_one_digest(conv_id, parts) for conv_id, parts in groupby(rows, key=lambda row: row["conv_id"])]
    yield pa.RecordBatch.from_pylist(out, schema)


def _one_digest(conv_id: object, parts: Iterator[dict]) -> dict:
    total = dict.fromkeys(("turns", *FAULTS, "illegal"), 0)
    first_turn = last_turn = last_role = cost = None
    edits, hashed, lines = [], hashlib.sha256(), 0
    for part in parts:
        for name in total:
            total[name] += part[name]
        if part["first_turn"] is not None:
            first_turn = part["first_turn"] if first_turn is None else first_turn
            total["turns"] -= part["first_turn"] == last_turn
            last_turn = part["last_turn"]
        if part["first_role"] is not None:
            total["illegal"] += last_role is not None and last_role + part["first_role"] not in LEGAL
            last_role = part["last_role"]
        cost = part["cost"] if cost is None else cost
        edits.append(part["edits"])
        for row in part["repaired"]:
            hashed.update(("\n" if lines else "").encode() + f"{row['role']}:{row['text']}".encode())
            lines += 1
    turns = total.pop("turns")
    gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
    result = {"conv_id": conv_id, "gaps": gaps, **total, "cost": cost}
    return result | {"audit": "".join(edits), "repaired_sha256": hashed.hexdigest()}


def op12_auction_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damage all conversations, find their cheapest repairs, and digest them."""
    return digests(repair(damaged(table(spark, folder, "conversations"))))


def _sql() -> str:
    """The same results as SQL: the lattice row by row, with the least (cost, edits) of every state.

    A value is the cost in eight digits and the edits, so the least text is the cheapest
    and then least repair; the repaired rows follow behind a separator.
    """

    def more(value: str, cost: str, edit: str, line: str | None = None) -> str:
        edits = f"{value}.v[9:] || '{edit}'"
        priced = f"lpad(({value}.v[:8]::bigint + {cost})::varchar, 8, '0') || {edits}"
        lines = f"{value}.r" if line is None else f"{value}.r || chr(10) || {line}"
        return f"CASE WHEN {value} IS NULL THEN NULL ELSE {{'v': {priced}, 'r': {lines}}} END"

    def least(*values: str) -> str:
        return f"list_min(list_filter([{', '.join(values)}], lambda x: x IS NOT NULL))"

    def kept(initial: str, value: str) -> str:
        return f"CASE WHEN NOT gone AND role[:1] = '{initial}' THEN {more(value, 'extra', 'K', 'line')} END"

    def made(role: str, value: str) -> str:
        made_line = f"'{role}:' || text"
        return f"CASE WHEN NOT gone THEN {more(value, f'{REROLE} + extra', 'R', made_line)} END"

    user = least("b2", *[more(b, str(INSERT), "I", "'user:'") for b in ("b0", "b1", "b3")])
    assistant = least("b3", more("u2", str(INSERT), "I", "'assistant:'"))
    return f"""
WITH RECURSIVE bytes AS (
    SELECT list_transform(range(256), lambda i: list_reduce(
        [i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), given AS (
    SELECT conv_id, turn, coalesce(conv_id::varchar, ' ') AS id,
           coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS key
    FROM conversations
), fated AS (
    SELECT given.*, xor(list_reduce(
        [4294967295] || list_transform(string_split(key, ''), lambda x: ascii(x)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % {DAMAGES} AS fate
    FROM given, bytes
), turns AS (
    SELECT conv_id, id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM fated, (VALUES (1), (2)) AS copies (copy)
    WHERE fate <> 0 AND (copy = 1 OR fate = 3)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text) AS n,
           regexp_extract(text, '([^ \\t-\\r])[ \\t-\\r]*$', 1) AS last
    FROM turns
), seen AS (
    SELECT *, row_number() OVER (PARTITION BY id, role, text ORDER BY n) > 1 AS again,
           lag(role[:1]) OVER (PARTITION BY id ORDER BY n) || role[:1] AS pair
    FROM numbered
), judged AS (
    SELECT *, role || ':' || text AS line, last = '' AS blank, last <> '' AND again AS duplicate,
           last <> '' AND NOT again AND last NOT IN ('.', '!', '?') AS truncated,
           last = '' OR again AS gone,
           CASE WHEN last NOT IN ('.', '!', '?') THEN {TRUNCATED} ELSE 0 END AS extra
    FROM seen
), counted AS (
    SELECT id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY id
), walk AS (
    SELECT id, 0::bigint AS n, {{'v': '00000000', 'r': ''}} AS b0, NULL::struct(v varchar, r varchar) AS b1,
           NULL::struct(v varchar, r varchar) AS b2, NULL::struct(v varchar, r varchar) AS b3
    FROM (SELECT DISTINCT id FROM given)
    UNION ALL
    SELECT id, n,
           {more("b0", str(DELETE), "D")} AS b0,
           {least(more("b1", str(DELETE), "D"), kept("s", "b0"))} AS b1,
           {least(*[more("u2", str(DELETE), "D")], *[f(x, y) for y in ("b0", "b1", "u3") for f, x in ((kept, "u"), (made, "user"))])} AS b2,
           {least(more("u3", str(DELETE), "D"), kept("a", "u2"), made("assistant", "u2"))} AS b3
    FROM (
        SELECT *, {assistant} AS u3
        FROM (
            SELECT judged.*, b0, b1, b2, b3, {user} AS u2
            FROM walk JOIN judged ON judged.id = walk.id AND judged.n = walk.n + 1
        )
    )
), done AS (
    SELECT id, n, {least("b0", "u3")} AS best
    FROM (SELECT *, {assistant} AS u3 FROM (SELECT *, {user} AS u2 FROM walk))
)
SELECT ids.conv_id, coalesce(gaps, 0)::bigint AS gaps, coalesce(blank, 0)::bigint AS blank,
       coalesce(duplicate, 0)::bigint AS duplicate, coalesce(truncated, 0)::bigint AS truncated,
       coalesce(illegal, 0)::bigint AS illegal, best.v[:8]::bigint AS cost, best.v[9:] AS audit,
       sha256(best.r[2:]) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, id FROM given) AS ids
LEFT JOIN counted USING (id)
JOIN done ON done.id = ids.id AND done.n = coalesce(size, 0)
"""


OP12_SQL = _sql()
