"""Labelled grids held as array columns, flattened to long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_grid(
    df: DataFrame, axes: Mapping[str, str], grid: str, value: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per grid cell with its axis labels; cells without a value are dropped.

    ``axes`` maps output names to label arrays, outermost first; the grid is an array
    nested as deep as there are axes.
    """
    labels = list(axes.values())
    level = df.select(*keep, *labels, F.col(grid).alias("_level"))
    done: list[str] = []
    for depth, (name, label) in enumerate(axes.items()):
        pairs = F.arrays_zip(F.col(label).alias("at"), F.col("_level").alias("cell"))
        opened = level.withColumn("_pair", F.explode(pairs))
        level = opened.select(
            *keep,
            *done,
            *labels[depth + 1 :],
            F.col("_pair")["at"].alias(name),
            F.col("_pair")["cell"].alias("_level"),
        )
        done.append(name)
    return level.where(F.col("_level").isNotNull() & ~F.isnan("_level")).select(
        *keep, *done, F.col("_level").alias(value)
    )
