"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source is cut into shards by a seeded hash. The mix is dealt to the shards in blocks
of equally many words by the highest quotients target / (2 * seats + 1); a shard fills its
quota with whole documents in a seeded order, round after round. Built-in functions only;
the driver sees sums, never sources or documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.llm.words import text_or_empty, word_count
from obslake.operators.keys import number_rows
from obslake.session import stored

BLOCKS = 1024  # at least as many in the target of a shard, unless a block is one word


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source its size, its weight and its target in words.

    Sources in code point order, null last, take the weights in turn. Targets share all
    words by weight; a target stops at ``most`` times the source's size and the excess is
    shared again, until none is above.
    """
    sources = (
        sizes.groupBy("_source")
        .agg(F.sum("_size").alias("_source_size"))
        .withColumn("_last", F.col("_source").isNull())
    )
    ranked = number_rows(sources, ["_last", "_source"], "_rank")
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    ranked = stored(
        ranked.select("_source", "_source_size", weight.cast("double").alias("_weight")), "mix-sources"
    )
    total = ranked.agg(F.sum("_source_size")).first()[0] or 0
    cap = F.col("_source_size") * float(most)
    level, stopped = 0.0, -1
    while total:
        full = cap <= F.lit(level) * F.col("_weight") if stopped >= 0 else F.lit(False)
        caps, open_weight, n = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))),
            F.count_if(full),
        ).first()
        if n == stopped or not open_weight:
            break
        level, stopped = (total - caps) / open_weight, n
    return ranked.withColumn("_target", F.least(cap, F.lit(level) * F.col("_weight")))


def apportion(cells: DataFrame, target: str, most: str, seats: int, order: list[str]) -> DataFrame:
    """Sainte-Lague: ``_seats`` for each row of ``cells``, ``seats`` in all, ``most`` a row at most.

    Seats that every divisor in question gives are counted at once; the few that are left,
    no more than there are rows, go to the highest quotients, ties in ``order``.
    """
    n, total = cells.agg(F.count(F.lit(1)), F.sum(target)).first()
    t = F.col(target)

    def rounded(divisor: float) -> Column:
        return F.least(F.floor(t / F.lit(divisor) + 0.5), F.col(most)).cast("bigint")

    if not total or seats <= 0:
        return cells.withColumn("_seats", F.lit(0).cast("bigint"))
    # Rounding errs by at most half a seat a row: the first divisor deals no seat too many,
    # the second, lowered step by step where rows are at their limit, deals enough.
    sure = rounded(total / (seats - n / 2)) if seats > n / 2 else F.lit(0).cast("bigint")
    spare = n / 2
    while True:
        divisor = total / (seats + spare)
        dealt, limit = cells.agg(F.sum(rounded(divisor)), F.sum(most)).first()
        if dealt >= min(seats, limit):
            break
        spare *= 2
    cells = cells.withColumns({"_sure": sure, "_highest": rounded(divisor)})
    left = seats - cells.agg(F.sum("_sure")).first()[0]
    claims = (
        cells.where("_highest > _sure")
        .withColumn("_seat", F.explode(F.sequence("_sure", F.col("_highest") - 1)))
        .select(*order, (-t / (2 * F.col("_seat") + 1)).alias("_quotient"), "_seat")
    )
    won = (
        number_rows(claims, ["_quotient", *order, "_seat"], "_claim")
        .where(F.col("_claim") <= left)
        .groupBy(*order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    same = [F.col(f"_c.{c}").eqNullSafe(F.col(f"_w.{c}")) for c in order]
    seated = (F.col("_c._sure") + F.coalesce("_w._won", F.lit(0))).alias("_seats")
    kept = [F.col(f"_c.{c}") for c in cells.columns if c not in ("_sure", "_highest")]
    return cells.alias("_c").join(won.alias("_w"), same, "left").select(*kept, seated)


def mix_sources(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    block_words: int = 64,
    shard_words: int = 1 << 20,
    seed: int = 7,
) -> DataFrame:
    """Per row of ``df``: its id, source, size, source_size, target of its source, and taken words.

    ``taken`` counts the words drawn, repeats included, and never exceeds ``most`` times the
    size. It is a multiple of the size, so documents are drawn whole, except for the one
    document of a shard at which its quota ends. Blocks have ``block_words`` words; sources of
    which a shard's target is under 1024 of these share their words in blocks of one. The
    draw depends on ids, sizes and ``seed`` alone.

    Null text has size 0 and nothing is taken of it; a null source is a source, the last.
    Null and repeated ids are rows of their own; equal rows are interchangeable. Other
    columns do not matter. An empty table gives an empty result.
    """
    rows = stored(
        df.select(
            F.col(doc_id).alias("_id"),
            F.col(source).alias("_source"),
            word_count(text_or_empty(text)).cast("bigint").alias("_size"),
        ),
        "mix-rows",
    )
    plan = source_targets(rows, weights, most)
    shards = F.greatest(F.ceil(F.col("_source_size") / shard_words), F.lit(1))
    rows = rows.alias("_d").join(
        plan.alias("_p"), F.col("_d._source").eqNullSafe(F.col("_p._source"))
    ).select(
        "_d._id", "_d._source", "_size", "_source_size", "_target",
        F.pmod(F.xxhash64(F.lit(seed), "_d._id"), shards).alias("_shard"),
    )
    cells = rows.where("_size > 0").groupBy("_source", "_shard").agg(
        F.sum("_size").alias("_cell_size"), F.first("_source_size").alias("_whole"), F.first("_target").alias("_of")
    )
    cells = stored(
        cells.select(
            "_source", "_shard", "_cell_size",
            (F.col("_of") * F.col("_cell_size") / F.col("_whole")).alias("_cell_target"),
            F.when(F.col("_of") >= block_words * BLOCKS * F.greatest(F.ceil(F.col("_whole") / shard_words), F.lit(1)), block_words)
            .otherwise(1).alias("_block"),
        ),
        "mix-shards",
    )
    # A block is a small part of a shard's target, so that no source is lost to rounding.
    cells = cells.withColumn("_most", F.ceil(F.col("_cell_size") * most / F.col("_block")))
    totals = {r["_block"]: r["_total"] for r in cells.groupBy("_block").agg(F.sum("_cell_target").alias("_total")).collect()}
    dealt = [
        apportion(cells.where(F.col("_block") == block), "_cell_target", "_most", max(round(totals.get(block, 0) / block), 1), ["_source", "_shard"])
        for block in sorted(totals) or [block_words]
    ]
    quotas = functools.reduce(DataFrame.unionByName, dealt)
    quota = F.least(F.col("_seats") * F.col("_block"), F.col("_cell_size") * most)

    cell = Window.partitionBy("_source", "_shard").orderBy(F.xxhash64(F.lit(seed), "_id"), "_id", "_size")
    placed = rows.where("_size > 0").withColumn(
        "_start", F.sum("_size").over(cell.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    )
    # What each document gives whole times, and how many words of the next round the cell still takes.
    rounds = quotas.select(
        "_source", "_shard",
        F.floor(quota / F.col("_cell_size")).alias("_rounds"), (quota % F.col("_cell_size")).alias("_left"),
    )
    same = F.col("_a._source").eqNullSafe(F.col("_b._source")) & (F.col("_a._shard") == F.col("_b._shard"))
    last = F.least(F.greatest(F.col("_left") - F.col("_start"), F.lit(0)), F.col("_size"))
    taken = placed.alias("_a").join(rounds.alias("_b"), same).select(
        "_id", "_a._source", "_size", "_source_size", "_target",
        (F.col("_rounds") * F.col("_size") + last).cast("bigint").alias("_taken"),
    )
    none = rows.where("_size = 0").select(
        "_id", "_source", "_size", "_source_size", "_target", F.lit(0).cast("bigint").alias("_taken")
    )
    return taken.unionByName(none).select(
        F.col("_id").alias(doc_id), F.col("_source").alias(source), F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"),
    )
