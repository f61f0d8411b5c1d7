"""Repair of conversations: the fewest edits after which roles read system?, (user, assistant)+.

Turns are sorted by conversation and turn over range partitions, so that a conversation of
any length spreads over tasks; what a partition holds of one conversation is a stretch.
A stretch is a string of symbols, one a turn, edited by block tables (``turn_edits``).
Only conversations cut by a partition's edge need more: each of their stretches tells what
it makes of every cost vector behind it, and these few rows, one a partition, are chained.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm import turn_edits
from obslake.llm.turn_edits import Costs
from obslake.llm.words import SPACE, text_or_empty
from obslake.llm.worker import memory
from obslake.session import stored

BLOCK = 4  # turns
LEGAL = ("su", "ua", "au")
RANGE_KEY_CHARS = 64  # of a text, in the keys that cut ranges; rows are sorted by whole texts


@dataclass
class Repaired:
    report: DataFrame
    turns: DataFrame


def _tables(costs: Costs) -> turn_edits.Tables:
    """Built once a Python worker."""
    kept = memory("turn-tables")
    if (costs, BLOCK) not in kept:
        kept[costs, BLOCK] = turn_edits.Tables(costs, BLOCK)
    return kept[costs, BLOCK]


def blank(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE)) == ""


def ended(text: Column) -> Column:
    """The last character that is no white space closes a sentence."""
    return F.substring(F.btrim(text, F.lit(SPACE)), -1, 1).isin(".", "!", "?")


def _sorted_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct turns with their copies, in order; ``_at`` numbers them, its high bits the range."""
    rows = df.select(
        F.col(conv_id).alias("_conv"), F.col(turn).alias("_turn"),
        text_or_empty(F.col(role)).alias("_role"), text_or_empty(F.col(text)).alias("_text"),
    )
    copies = rows.groupBy("_conv", "_turn", "_role", "_text").agg(F.count(F.lit(1)).alias("_n"))
    ranges = copies.repartitionByRange("_conv", "_turn", "_role", F.left("_text", F.lit(RANGE_KEY_CHARS)))
    ordered = ranges.sortWithinPartitions("_conv", "_turn", "_role", "_text")
    initial = F.substring("_role", 1, 1)
    return stored(
        ordered.select(
            F.monotonically_increasing_id().alias("_at"), "*",
            blank(F.col("_text")).alias("_blank"), ended(F.col("_text")).alias("_ended"),
            F.sha2("_text", 256).alias("_key"),
            F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("_initial"),
        ),
        "turns",
    )


def _stretches(turns: DataFrame) -> DataFrame:
    """One row for each conversation and range: its symbols, copies and faults."""
    first = (
        turns.where(~F.col("_blank")).groupBy("_conv", "_role", "_key").agg(F.min("_at").alias("_at"))
        .select("_at", F.lit(True).alias("_first"))
    )
    known = turns.select("_conv", "_at", "_n", "_blank", "_ended", "_initial").join(first, "_at", "left")
    gone = F.col("_blank") | F.col("_first").isNull()
    signs = [(i, e) for i in turn_edits.INITIALS for e in (True, False)]
    sign = F.when(gone, F.lit(str(turn_edits.MUST_GO)))
    for initial, end in signs:
        own = (F.col("_initial") == initial) & (F.col("_ended") == end)
        sign = sign.when(own, F.lit(str(turn_edits.symbol(initial, not end))))
    in_order = F.array_sort(F.collect_list(F.struct("_at", sign.alias("sign"), "_n", "_initial")))
    one = lambda condition, value: F.sum(F.when(condition, value).otherwise(0))
    return (
        known.groupBy("_conv", F.shiftright("_at", 33).alias("_range"))
        .agg(
            in_order.alias("_rows"),
            one(F.col("_blank"), F.col("_n")).alias("blank"),
            one(~F.col("_blank"), F.col("_n") - F.when(gone, 0).otherwise(1)).alias("duplicate"),
            one(~gone & ~F.col("_ended"), F.lit(1)).cast("bigint").alias("truncated"),
        )
        .select(
            "_conv", "_range", "blank", "duplicate", "truncated",
            F.col("_rows._at").alias("_ats"), F.col("_rows._n").alias("_copies"),
            F.array_join("_rows.sign", "").alias("_signs"), F.array_join("_rows._initial", "").alias("_initials"),
        )
    )


def _described(stretches: DataFrame, costs: Costs) -> DataFrame:
    """What each stretch makes of every vector behind it."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(costs)
        for batch in batches:
            maps = [tables.stretch(s.encode()) for s in batch.column("_signs").to_pylist()]
            initials = batch.column("_initials").to_pylist()
            yield pa.record_batch(
                {
                    "_conv": batch.column("_conv"), "_range": batch.column("_range"),
                    "_edges": pa.array([s[0] + s[-1] for s in initials], pa.string()),
                    "_before": pa.array([m[0].tolist() for m in maps], pa.list_(pa.int64())),
                    "_leaves": pa.array([m[1].ravel().tolist() for m in maps], pa.list_(pa.int64())),
                }
            )

    kind = stretches.schema["_conv"].dataType.simpleString()
    shape = f"_conv {kind}, _range long, _edges string, _before array<long>, _leaves array<long>"
    return stretches.select("_conv", "_range", "_signs", "_initials").mapInArrow(describe, shape)


def _chain(stretches: pd.DataFrame) -> pd.DataFrame:
    """One conversation's stretches: the vector behind each, and the state it is entered in."""
    stretches = stretches.sort_values("_range", ignore_index=True)
    behind, vector = [], 0
    for before in stretches["_before"][::-1]:
        behind.append(vector)
        vector = int(before[vector])
    behind.reverse()
    entered, state = [], turn_edits.START
    for leaves, vector in zip(stretches["_leaves"], behind):
        entered.append(state)
        state = int(leaves[4 * vector + state])
    meets = [False] + [a[1] + b[0] not in LEGAL for a, b in zip(stretches["_edges"], stretches["_edges"][1:])]
    return pd.DataFrame(
        {
            "_conv": stretches["_conv"], "_range": stretches["_range"], "_behind": behind, "_entered": entered,
            "_last": np.arange(len(stretches)) == len(stretches) - 1, "_meets": np.array(meets, dtype="int64"),
        }
    )


def _edited(stretches: DataFrame, costs: Costs) -> DataFrame:
    """Fates, audit, cost and illegal neighbours of each stretch."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(costs)
        for batch in batches:
            rows = batch.to_pylist()
            done = [tables.edit(r["_signs"].encode(), r["_behind"], r["_entered"], r["_last"]) for r in rows]
            audits, illegal, spent = [], [], []
            for r, e in zip(rows, done):
                more = sum(r["_copies"]) - len(r["_copies"])
                roles = r["_initials"]
                audits.append(turn_edits.audit(e.fates, r["_copies"], e.tail))
                illegal.append(more + r["_meets"] + sum(a + b not in LEGAL for a, b in zip(roles, roles[1:])))
                spent.append(e.cost + more * costs.delete)
            new = {
                "_fates": pa.array([e.fates for e in done], pa.list_(pa.string())),
                "_tail": pa.array([e.tail for e in done], pa.string()),
                "audit": pa.array(audits, pa.string()),
                "illegal": pa.array(illegal, pa.int64()),
                "cost": pa.array(spent, pa.int64()),
            }
            yield pa.record_batch({**{c: batch.column(c) for c in kept}, **new})

    kept = ["_conv", "_range", "_ats", "blank", "duplicate", "truncated"]
    shape = ", ".join(f"{c} {stretches.schema[c].dataType.simpleString()}" for c in kept)
    return stretches.mapInArrow(edit, f"{shape}, _fates array<string>, _tail string, audit string, illegal long, cost long")


def repair(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    costs: Costs = Costs(),
) -> Repaired:
    """Faults and the cheapest repair of each conversation.

    A turn's first fault counts: blank, duplicate (same role and text earlier), truncated
    (does not end in . ! ?). Turns are kept, given the role user or assistant, deleted (blank
    ones and duplicates always), and empty ones inserted, at the least cost such that role
    initials read ``(s?(ua)+)?``; a kept truncated turn costs more. Of the cheapest edits
    those whose initials (D, I, K, R in order) are the ASCII-least are taken.

    ``report``: conv_id, gaps, blank, duplicate, truncated, illegal (neighbouring role
    initials other than su, ua, au), cost, audit. ``turns``: conv_id, at and nth (the order),
    edit, role, text of the repaired conversation.

    Turns come in the order of turn (null first), then role and text; repeated rows lie side
    by side. Null roles and texts count as empty, a role with another or no initial is kept
    nowhere. A null conversation is one of its own. gaps is null where turns are further
    apart than 64 bits count. Other columns do not matter. An empty table gives empty
    results. An audit is one value, a letter an edit.
    """
    turns = _sorted_turns(df, conv_id, turn, role, text)
    stretches = stored(_stretches(turns), "stretches")
    pieces = F.count(F.lit(1)).over(Window.partitionBy("_conv"))
    counted = stretches.withColumn("_pieces", pieces)
    whole = counted.where("_pieces = 1").withColumns(
        {"_behind": F.lit(0).cast("long"), "_entered": F.lit(turn_edits.START).cast("long"), "_last": F.lit(True), "_meets": F.lit(0).cast("long")}
    )
    cut = counted.where("_pieces > 1")
    kind = turns.schema["_conv"].dataType.simpleString()
    chained = _described(cut, costs).groupBy("_conv").applyInPandas(
        _chain, f"_conv {kind}, _range long, _behind long, _entered long, _last boolean, _meets long"
    )
    same = (F.col("c._range") == F.col("h._range")) & F.col("c._conv").eqNullSafe(F.col("h._conv"))
    placed = cut.alias("c").join(chained.alias("h"), same).select("c.*", "h._behind", "h._entered", "h._last", "h._meets")
    edited = stored(_edited(whole.unionByName(placed), costs), "edited-turns")

    in_order = F.array_sort(F.collect_list(F.struct("_range", "audit")))
    sums = edited.groupBy("_conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(in_order, lambda x: x["audit"]), "").alias("audit"),
    )
    span = F.try_add(F.try_subtract(F.max("_turn"), F.min("_turn")), F.lit(1).cast("bigint"))
    distinct = turns.groupBy("_conv").agg(span.alias("_span"), F.count_distinct("_turn").alias("_turns"))
    gaps = F.when(F.col("_turns") == 0, F.lit(0).cast("bigint")).otherwise(F.col("_span") - F.col("_turns"))
    report = sums.alias("s").join(distinct.alias("d"), F.col("s._conv").eqNullSafe(F.col("d._conv"))).select(
        F.col("s._conv").alias(conv_id), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )

    fates = edited.select("_conv", F.explode(F.arrays_zip("_ats", "_fates")).alias("f")).select(
        "_conv", F.col("f._ats").alias("at"), F.col("f._fates").alias("fate")
    ).where("fate <> 'D'")
    added = F.regexp_extract("fate", "^([ua]*)", 1)
    own = F.substring(F.regexp_extract("fate", "([DKR])", 1), 1, 1)
    texts = turns.select(F.col("_at").alias("at"), "_role", "_text")
    behind = edited.where("_tail <> ''").select(
        "_conv", F.element_at("_ats", -1).alias("at"), F.col("_tail").alias("_added"), F.lit("").alias("_own"),
        F.lit("").alias("_given"), F.lit("").alias("_role"), F.lit("").alias("_text"), F.lit(1).alias("_side"),
    )
    before = fates.join(texts, "at").select(
        "_conv", "at", added.alias("_added"), own.alias("_own"), F.regexp_extract("fate", "R([ua])", 1).alias("_given"),
        "_role", "_text", F.lit(0).alias("_side"),
    )
    named = lambda initial: F.when(initial == "u", "user").otherwise("assistant")
    entry = lambda edit, role, text: F.struct(edit.alias("edit"), role.alias("role"), text.alias("text"))
    inserted = F.transform(
        F.filter(F.split("_added", ""), lambda x: x != ""), lambda x: entry(F.lit("I"), named(x), F.lit(""))
    )
    itself = F.when(
        F.col("_own").isin("K", "R"),
        F.array(
            entry(F.col("_own"), F.when(F.col("_own") == "K", F.col("_role")).otherwise(named(F.col("_given"))), F.col("_text"))
        ),
    ).otherwise(F.array().cast("array<struct<edit:string,role:string,text:string>>"))
    made = before.unionByName(behind).select("_conv", "at", "_side", F.posexplode(F.concat(inserted, itself)).alias("nth", "t"))
    repaired = made.select(
        F.col("_conv").alias(conv_id), "at", (F.col("_side") * 1000 + F.col("nth")).alias("nth"), "t.edit", "t.role", "t.text"
    )
    return Repaired(report, repaired)


def line_digests(df: DataFrame, key: str, order: list[str], line: Column) -> DataFrame:
    """Per key the sha256 of its lines in order, joined by newlines: key, sha256.

    A digest is taken from first to last by its nature: the lines of a key stream through
    one task, sorted, of which no more than a batch is in memory.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []  # key and digest of the key being read

        def found() -> pa.RecordBatch:
            return pa.record_batch({key: pa.array([k for k, _ in now], kind), "sha256": [d.hexdigest() for _, d in now]})

        kind = None
        for batch in batches:
            kind, ended = batch.column(0).type, []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                if now and now[0][0] == own:
                    now[0][1].update(b"\n" + raw)
                else:
                    ended += now
                    now = [(own, hashlib.sha256(raw))]
            if ended:
                now, ended = ended, now
                yield found()
                now = ended
        if now:
            yield found()

    rows = df.select(F.col(key), line.alias("_line"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    by = [f"_o{i}" for i in range(len(order))]
    lines = rows.repartition(key).sortWithinPartitions(key, *by).select(key, "_line")
    return lines.mapInArrow(digest, f"{key} {df.schema[key].dataType.simpleString()}, sha256 string")
