"""Ranged against plain operators where one entity holds a third of all rows.

python tools/skew.py [rows]: prints wall times and the largest share of rows any one
group (window partition) holds.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from obslake.operators import ordered  # noqa: E402
from obslake.session import local_session, stored  # noqa: E402


def seconds(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def largest_share(df, *group) -> float:
    total = df.count()
    return df.groupBy(*group).count().agg(F.max("count")).first()[0] / total


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    spark = local_session(8, shuffle_partitions=64)
    n = F.col("id")
    crowded = F.when(n % 4 == 0, n % 3_600_000).otherwise(n * 350)
    readings = spark.range(rows).select(
        F.when(n % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).alias("entity"),
        F.timestamp_micros(crowded * 1000).alias("at"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).cast("decimal(9,2)").alias("v"),
    )
    readings = stored(readings, "skew")
    start = time.perf_counter()
    ranges = ordered.balanced_ranges(readings, "at")
    print(f"ranges: {len(ranges.edges)} in {time.perf_counter() - start:.1f} s")
    plain = F.lag("v").over(Window.partitionBy("entity").orderBy("at"))
    print(f"plain window lag: {seconds(readings.withColumn('before', plain)):.1f} s, "
          f"largest group {largest_share(readings, 'entity'):.1%}")  # fmt: skip
    ranged = ordered.with_ranges(readings, "at", ranges)
    lagged = ordered.lag_in_order(readings, ["entity"], "at", "v", "before", ranges)
    print(f"ranged lag: {seconds(lagged):.1f} s, "
          f"largest group {largest_share(ranged, 'entity', ordered.RANGE):.1%}")  # fmt: skip
    exact = readings.groupBy("entity").agg(F.percentile("v", F.lit(0.9)))
    print(f"built-in percentile: {seconds(exact):.1f} s")
    start = time.perf_counter()
    quantiles = ordered.exact_quantiles(readings, ["entity"], "v", {"p90": 0.9})
    planned = time.perf_counter() - start
    print(f"ranged quantiles: {planned + seconds(quantiles):.1f} s")


if __name__ == "__main__":
    main()
