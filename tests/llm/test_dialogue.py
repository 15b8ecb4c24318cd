from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from vintagemill.llm import dialogue
from vintagemill.llm.dialogue import (
    COMPLETE,
    TAIL,
    Lattice,
    apply_edits,
    cheapest,
    damaged,
    digests,
    distances,
    repair,
)

TURNS = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def exhaustive(code: str) -> tuple[int, str]:
    """Least cost, then least edits: a search by cost over strings of edits, apart from the lattice."""
    heap = [(0, "", 0, "")]
    seen = set()
    while heap:
        cost, edits, at, roles = heapq.heappop(heap)
        if at == len(code) and PATTERN.fullmatch(roles):
            return cost, edits
        state = roles if len(roles) < 2 else ("s" if roles[0] == "s" else "") + "ua" * 0 + roles[-1] + "+"
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for role in "ua":
            if PATTERN.match(roles + role) and legal_prefix(roles + role):
                heapq.heappush(heap, (cost + 3, edits + "I", at, roles + role))
        if at < len(code):
            letter, extra = code[at], 3 if code[at].isupper() else 0
            heapq.heappush(heap, (cost + 4, edits + "D", at + 1, roles))
            if letter != "x":
                if legal_prefix(roles + letter.lower()):
                    heapq.heappush(heap, (cost + extra, edits + "K", at + 1, roles + letter.lower()))
                for role in "ua":
                    if legal_prefix(roles + role):
                        heapq.heappush(heap, (cost + 3 + extra, edits + "R", at + 1, roles + role))
    raise AssertionError


def legal_prefix(roles: str) -> bool:
    return any(PATTERN.fullmatch(roles + rest) and roles + rest for rest in ("", "a", "ua"))


def all_edits(code: str) -> tuple[int, str]:
    """Every string of edits of short conversations."""
    best = None
    for inserts in itertools.product(range(4), repeat=len(code) + 1):
        for edits in itertools.product("DKR", repeat=len(code)):
            word = "".join("I" * k + e for k, e in zip(inserts, (*edits, ""), strict=True))
            cost, roles, at = 0, [""], 0
            for e in word:
                letter = code[at] if at < len(code) else ""
                extra = 3 if letter.isupper() else 0
                if e == "I":
                    cost, roles = cost + 3, [r + x for r in roles for x in "ua"]
                elif e == "D":
                    cost, at = cost + 4, at + 1
                elif letter == "x":
                    roles = []
                    break
                elif e == "K":
                    cost, at, roles = cost + extra, at + 1, [r + letter.lower() for r in roles]
                else:
                    cost, at, roles = cost + 3 + extra, at + 1, [r + x for r in roles for x in "ua"]
            if any(PATTERN.fullmatch(r) for r in roles) and (best is None or (cost, word) < best):
                best = cost, word
    return best


def whole(code: str) -> tuple[int, str]:
    cost, pieces, state = cheapest(code)
    return cost, "".join(pieces) + TAIL[state]


def test_every_short_code():
    for n in range(3):
        for letters in itertools.product("suaoSUAOx", repeat=n):
            code = "".join(letters)
            assert whole(code) == all_edits(code) == exhaustive(code), code


def test_longer_codes(monkeypatch):
    monkeypatch.setattr(dialogue, "CHUNK", 3)
    rng = random.Random(5)
    for _ in range(1500):
        code = "".join(rng.choice("ssuuuaaaoUAxx") for _ in range(rng.randint(0, 12)))
        assert whole(code) == exhaustive(code), code


def test_prices_are_distances():
    rng = random.Random(6)
    for _ in range(200):
        code = "".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(1, 9)))
        matrix = distances(code)
        lattice = Lattice(code, COMPLETE)
        for state in range(4):
            composed = min(matrix[4 * state + end] + COMPLETE[end] for end in range(4))
            assert lattice.distance(state) == composed, (code, state)


def brute(turns: list[tuple]) -> dict:
    """The contract of op12, row by row."""
    conversations: dict = {}
    for conv_id, turn, role, text in turns:
        rows = conversations.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        if fate:
            rows += [(turn, role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv_id, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))  # no ties of unlike rows here
        counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        seen, code = set(), ""
        for _, role, text in rows:
            shown = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not shown:
                counts["blank"] += 1
                letter = "x"
            elif (role, text) in seen:
                counts["duplicate"] += 1
                letter = "x"
            elif shown[-1] not in ".!?":
                counts["truncated"] += 1
                letter = letter.upper()
            seen.add((role, text))
            code += letter
        cost, edits = exhaustive(code)
        known = [t for t, _, _ in rows if t is not None]
        repaired = apply_edits([(role, text) for _, role, text in rows], edits, 0)
        assert PATTERN.fullmatch("".join(role[0] for role, _ in repaired))
        out[conv_id] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *counts.values(),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost,
            edits,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        )
    return out


def result(df) -> dict:
    rows = df.collect()
    found = {row["conv_id"]: tuple(row[1:]) for row in rows}
    assert len(found) == len(rows)
    return found


def random_turns(seed: int, conversations: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    turns = []
    for conv_id in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No.", "a b", "", " \t", None, "What? ", "end.\n", f"t{turn}."])
            turns.append((conv_id, turn * rng.choice([1, 1, 1, 2]) if conv_id % 7 else turn, role, text))
    return [turn for i, turn in enumerate(turns) if (turn[0], turn[1]) not in {t[:2] for t in turns[max(0, i - 40) : i]}]


def test_query_equals_brute_force(spark):
    turns = random_turns(1, 400, 9)
    df = spark.createDataFrame(turns, TURNS).repartition(5)
    assert result(digests(repair(damaged(df)))) == brute(turns)


def test_open_conversations(spark):
    """Every conversation lies in many tasks or blocks."""
    rng = random.Random(3)
    turns = [
        (c, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "B.", "C", "", f"u{t}.", f"v{t}"]))
        for c in (1, 2, None)
        for t in range(300)
    ]
    turns += random_turns(4, 20, 30)[5:]
    turns = [t for t in turns if t[0] not in (1, 2)] + [t for t in turns if t[0] in (1, 2) and t[2] != "system"]
    turns = list({t[:2]: t for t in turns}.values())
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    parts = repair(damaged(df), partitions=16, block=4, longest=10)
    assert parts.where("not whole").count() > 200
    assert result(digests(parts)) == brute(turns)


def test_edges(spark):
    nothing = spark.createDataFrame([], TURNS)
    assert repair(nothing).count() == 0 and digests(repair(damaged(nothing))).count() == 0
    long = "word " * 300_000 + "."
    turns = [
        (None, None, None, None),
        (None, None, None, None),
        (5, None, "user", "Hi."),
        (5, 1, "assistant", long),
        (6, 0, "", "no role."),
        (7, 0, "system", ""),
    ]
    clashing = spark.createDataFrame(turns, TURNS).selectExpr("*", "'x' part", "'y' edits", "'z' _hash", "1 block")
    parts = {row["conv_id"]: row for row in repair(clashing).groupBy("conv_id").agg(
        F.max("cost").alias("cost"), F.concat_ws("", F.array_sort(F.collect_list("edits"))).alias("edits"), F.sum("blank").alias("blank")
    ).collect()}
    assert (parts[None]["cost"], parts[None]["edits"], parts[None]["blank"]) == (8, "DD", 2)
    assert (parts[5]["cost"], parts[5]["edits"]) == (0, "KK")
    assert (parts[6]["cost"], parts[6]["edits"]) == (4, "D")
    assert (parts[7]["cost"], parts[7]["edits"]) == (4, "D")


def test_equal_rows_are_duplicates(spark):
    rows = [(1, 1, "user", "Hello.")] * 3 + [(1, 2, "assistant", "Yes.")]
    found = repair(spark.createDataFrame(rows, TURNS)).agg(F.sum("duplicate"), F.max("cost")).first()
    assert tuple(found) == (2, 8)


@pytest.mark.parametrize("code", ["u" * 500, "xa" * 200, "sU" * 150])
def test_long_codes_end(code):
    cost, edits = whole(code)
    assert cost == exhaustive(code)[0]
