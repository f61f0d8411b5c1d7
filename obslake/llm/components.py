"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.session import stored


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("_a").agg(F.least(F.min("_b"), F.first("_a")).alias("_m"))


def components(links: DataFrame) -> DataFrame:
    """Rows (_node, _component) for every node of the links (_a, _b); the smallest node names it.

    Large-star and small-star steps by turns: every node's neighbours are hooked to the
    smallest one, until nothing changes. Only minima are grouped, so a node with many
    links needs no more room than others; each round is written to the shared folder.
    """
    links = stored(
        links.where("_a <> _b").select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).distinct(),
        "links",
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        large = both.join(_smallest(both), "_a").where("_b > _a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        large = large.where("_a <> _b").distinct()
        down = large.join(_smallest(large), "_a")
        small = down.select(F.col("_b").alias("_a"), F.col("_m").alias("_b")).unionByName(
            down.select("_a", F.col("_m").alias("_b"))
        )
        links = stored(small.where("_a <> _b").distinct(), "links")
        state = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_a", "_b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    named = links.select(F.col("_a").alias("_node"), F.col("_b").alias("_component"))
    return named.unionByName(links.select(F.col("_b").alias("_node"), F.col("_b").alias("_component"))).groupBy("_node").agg(
        F.min("_component").alias("_component")
    )
