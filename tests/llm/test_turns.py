"""Conversation repair against exhaustive search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from obslake.llm import catalog_turns, registered, turn_edits, turn_repair
from tests.conftest import SMALL

SPACES = " \t\n\x0b\f\r"
SHAPE = "conv_id long, turn long, role string, text string"


def after_damage(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        spaced = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind, role, text = zlib.crc32(":".join(spaced[:2]).encode()) % 20, *spaced[2:]
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


def described(turns):
    """Faults, and the least (cost, audit) over all edits with the lines they leave."""
    turns = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen, faults = set(), []
    for _, role, text in turns:
        inner = text.strip(SPACES)
        fault = "blank" if not inner else "duplicate" if (role, text) in seen else "" if inner[-1] in ".!?" else "truncated"
        faults.append(fault)
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(at, last, inserted):
        ways = []
        if at == len(turns):
            if last in ("", "a"):
                ways.append((0, "", ()))
        else:
            _, role, text = turns[at]
            ways.append(add(2, "D", None, best(at + 1, last, 0)))
            if faults[at] in ("", "truncated"):
                for cost, letter, new in ((0, "K", role), (1, "R", "user"), (1, "R", "assistant")):
                    if new and new[0] in follows[last]:
                        cost += 5 * (faults[at] == "truncated")
                        ways.append(add(cost, letter, f"{new}:{text}", best(at + 1, new[0], 0)))
        if inserted < 3:
            for new in ("user", "assistant"):
                if new[0] in follows[last]:
                    ways.append(add(5, "I", f"{new}:", best(at, new[0], inserted + 1)))
        return min((w for w in ways if w), default=None, key=lambda w: w[:2])

    def add(cost, letter, line, rest):
        return rest and (cost + rest[0], letter + rest[1], (line, rest[2]) if line is not None else rest[2])

    cost, audit, chain = best(0, "", 0)
    lines = []
    while chain:
        lines.append(chain[0])
        chain = chain[1]
    return gaps, *[faults.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, lines


def expected(rows):
    damaged = after_damage(rows)
    found = set()
    for conv in {r[0] for r in rows}:
        *numbers, lines = described(damaged[conv])
        found.add((conv, *numbers, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return found


def repaired(df):
    found = turn_repair.repair(df)
    lines = defaultdict(list)
    for r in found.turns.orderBy("conv_id", "at", "nth").collect():
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    return {r[0]: (*r[1:], lines[r[0]]) for r in map(tuple, found.report.collect())}


def made_up(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "User"]
    texts = ["Yes.", "No!", "cut off", " ", "", "Why? ", "more", "one\ntwo."]
    return [(rng.randint(0, n), rng.choice(roles), rng.choice(texts) + rng.choice(["", "", str(rng.randint(0, 9)) + "."])) for _ in range(n)]


def test_tables_against_all_edits():
    rng = random.Random(5)
    tables = turn_edits.Tables(turn_edits.Costs(), 3)
    assert tables.size < 50
    for _ in range(300):
        turns = made_up(rng, rng.randint(0, 11))
        turns.sort()
        *_, duplicate, _, _, cost, audit, _ = described(turns)
        seen, signs = set(), ""
        for _, role, text in turns:
            gone = not text.strip(SPACES) or (role, text) in seen
            seen.add((role, text))
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            signs += str(turn_edits.MUST_GO if gone else turn_edits.symbol(initial, text.strip(SPACES)[-1] not in ".!?"))
        whole = tables.edit(signs.encode())
        assert (whole.cost, turn_edits.audit(whole.fates, [1] * len(signs), whole.tail)) == (cost, audit)
        at = rng.randint(0, len(signs))
        behind, _ = tables.stretch(signs[at:].encode())
        _, leaves = tables.stretch(signs[:at].encode())
        left = tables.edit(signs[:at].encode(), int(behind[0]), last=False)
        right = tables.edit(signs[at:].encode(), 0, left.state)
        assert left.state == leaves[behind[0]][turn_edits.START]
        assert left.fates + right.fates == whole.fates and left.cost + right.cost == cost


def test_query_against_all_edits(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = registered()["op11_repair_turns"](spark, SMALL).collect()
    assert {tuple(r) for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_conversations_cut_by_ranges(spark, coalesce):
    rng = random.Random(7)
    turns = {conv: made_up(rng, n) for conv, n in ((1, 150), (2, 3), (3, 260), (4, 1), (None, 40))}
    rows = [(conv, *t) for conv, ts in turns.items() for t in ts]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = repaired(spark.createDataFrame(rows, SHAPE))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == {conv: described(ts) for conv, ts in turns.items()}


def test_repeated_rows_and_odd_values(spark):
    rows = [
        (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, None, None, None), (1, 5, "assistant", "Ok."),
        (2, None, "user", "a."), (2, None, "assistant", "b."), (3, 1, "system", "Only."), (4, 1, "", "x."), (5, 1, "user", "w " * 200_000 + "."),
        (6, -(2**63), "user", "far."), (6, 2**63 - 1, "assistant", "apart."),
    ]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], SHAPE + ", _conv string, audit int")
    got = repaired(df)
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    want = {conv: described(ts) for conv, ts in turns.items()}
    want[6] = (None, *want[6][1:])
    assert got == want
    assert got[1][6] == "DKDDK" and got[5][6] == "D"


def test_dropped_conversations_and_empty_tables(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Hello."), (None, None, None, None)]
    damaged = catalog_turns.damaged(spark.createDataFrame(rows, SHAPE))
    assert damaged.where(F.col("conv_id") == lost).count() == 0
    empty = turn_repair.repair(spark.createDataFrame([], SHAPE))
    assert empty.report.collect() == [] and empty.turns.collect() == []


def test_digests_follow_the_order(spark):
    rows = [(i % 3, i, f"line {i}") for i in range(50_000)] + [(None, 1, "é"), (7, 0, "")]
    df = spark.createDataFrame(rows, "key long, at long, text string")
    got = {r[0]: r[1] for r in turn_repair.line_digests(df, "key", ["at"], F.col("text")).collect()}
    lines = defaultdict(list)
    for key, _, text in sorted(rows, key=lambda r: r[1]):
        lines[key].append(text)
    assert got == {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in lines.items()}
