"""The query over conversation repair."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables
from obslake.llm import turn_repair
from obslake.llm.registry import query


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut, repeated or given the role user by a checksum of their place."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    role = F.when(kind == 4, "user").otherwise(spaced("role"))
    times: Column = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")
    ).drop("_copy")


@query()
def op11_repair_turns(t: Tables):
    repaired = turn_repair.repair(damaged(t.conversations))
    line = F.concat("role", F.lit(":"), "text")
    digests = turn_repair.line_digests(repaired.turns, "conv_id", ["at", "nth"], line)
    ids = t.conversations.select("conv_id").distinct()
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    joined = ids.alias("i").join(repaired.report.alias("r"), same("i", "r"), "left").join(
        digests.alias("d"), same("i", "d"), "left"
    )
    counts = [
        F.when(F.col("audit").isNull(), F.lit(0).cast("bigint")).otherwise(F.col(c)).alias(c)
        for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "i.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
