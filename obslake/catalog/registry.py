"""Registration of queries with their SQL, and the table shorthands they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.session import ready

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


class Tables:
    """The tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = ready(spark)
        self._folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables under its own name, with its SQL if it has one."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        _queries[build.__name__] = run
        if sql is not None:
            _oracles[build.__name__] = sql
        return run

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def money(column: str) -> Column:
    """Amounts as exact decimals, so that sums do not depend on row order."""
    return F.col(column).cast("decimal(18,2)")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals handed out as doubles."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles rounded through decimal, for comparison across engines."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("decimal(28,10)"), digits).cast("double") for c in columns}
    )


def r(expression: str, digits: int) -> str:
    """SQL for the same rounding."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def amount(column: str) -> str:
    """SQL for the same exact amounts."""
    return f"CAST({column} AS DECIMAL(18,2))"
