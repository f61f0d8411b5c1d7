"""Reports of broken rules, reconciliation, constraint checks and the quality gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.calendar import whole_days
from obslake.functions.numbers import half_even, half_up, percent
from obslake.session import stored

Bounds = Mapping[str, tuple[float, float]]


def missing_rows(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows lacking any required value."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in required]))


def out_of_range(df: DataFrame, required: Bounds, optional: Bounds | None = None) -> DataFrame:
    """Rows outside inclusive bounds; a missing value breaks only a required bound."""
    return df.where(_breaks_bounds(required, optional or {}))


def _breaks_bounds(required: Bounds, optional: Bounds) -> Column:
    broken = F.lit(False)
    for column, (low, high) in required.items():
        broken = broken | F.col(column).isNull() | ~F.col(column).between(low, high)
    for column, (low, high) in optional.items():
        broken = broken | (F.col(column).isNotNull() & ~F.col(column).between(low, high))
    return broken


def duplicate_keys(df: DataFrame, key: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Keys that occur more than once."""
    return group_counts(df, key, out).where(F.col(out) > 1)


def group_counts(df: DataFrame, key: Sequence[str], out: str = "n_rows") -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(out))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Fact keys without a dimension row, with their row counts.

    Rows are counted per key before the join, so a hot key costs one row in it.
    """
    return group_counts(fact, key).join(dim.select(*key), list(key), "left_anti")


def coverage(
    dim: DataFrame, fact: DataFrame, key: Sequence[str], out: str, counted: Column | None = None
) -> DataFrame:
    """Every dimension row with its number of fact rows (that meet ``counted``), zero included."""
    if counted is None:
        counts = group_counts(fact, key, out)
    else:
        counts = fact.groupBy(*key).agg(F.count_if(counted).alias(out))
    return dim.join(counts, list(key), "left").withColumn(out, F.coalesce(F.col(out), F.lit(0)))


def reconciliation_exceptions(
    sums: DataFrame, published: DataFrame, key: Sequence[str], summed: str, stated: str,
    tolerance: float,
) -> DataFrame:
    """Groups whose sum differs from the published total by more than the tolerance.

    A group without any reported value has a NULL sum and is not an exception.
    """
    gap = F.col(summed) - F.col(stated)
    return (
        sums.join(published.select(*key, stated), list(key))
        .where(F.abs(gap) > tolerance)
        .select(*key, half_up(F.col(summed), 2).alias(summed), stated,
                half_up(gap, 2).alias("diff"))
    )


def reconciliation_report(
    published: DataFrame, sums: DataFrame, key: Sequence[str], stated: str, summed: str,
    tolerance: float,
) -> DataFrame:
    """Every published total with the sum, difference and verdict.

    Here a group whose rows are all unreported sums to zero, while a group with no
    rows at all keeps NULL and does not reconcile.
    """
    present = sums.withColumn(summed, F.coalesce(F.col(summed).cast("double"), F.lit(0.0)))
    joined = published.select(*key, stated).join(present, list(key), "left")
    diff = half_even(F.col(stated).cast("double") - F.col(summed), 2)
    return joined.select(*key, stated, summed, diff.alias("diff")).withColumn(
        "reconciles", F.coalesce(F.abs("diff") < tolerance, F.lit(False))
    )


def bad_rates(df: DataFrame, by: Sequence[str], bad: Column, threshold: float) -> DataFrame:
    """Groups whose share of bad rows, in percent with one decimal, is above the threshold."""
    rate = half_up(percent(F.count_if(bad), F.count(F.lit(1))), 1)
    return df.groupBy(*by).agg(rate.alias("bad_pct")).where(F.col("bad_pct") > threshold)


def filtered_counts(df: DataFrame, total: str, conditions: Mapping[str, Column]) -> DataFrame:
    """Row count and the number of rows meeting each condition, in one pass."""
    counts = [F.count_if(c).alias(name) for name, c in conditions.items()]
    return df.agg(F.count(F.lit(1)).alias(total), *counts)


def filter_funnel(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each filter in turn, counted in one pass over the input."""
    kept, counts = F.lit(True), [F.count(F.lit(1)).alias("n_before")]
    for name, condition in steps.items():
        kept = kept & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(kept).alias(name))
    return df.agg(*counts)


def freshness(df: DataFrame, moment: str, as_of: datetime) -> DataFrame:
    """Newest moment and its age in whole days at ``as_of``."""
    newest = df.agg(F.max(F.col(moment).cast("timestamp")).alias("latest"))
    reference = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return newest.withColumn("age_days", whole_days(F.col("latest"), reference))


# --- constraints -----------------------------------------------------------------


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per row rule in one pass. As in SQL, a CHECK that is NULL passes."""
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    return counted.select(F.inline(F.array(*pairs)))


def unique_violations(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    surplus = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("violations"))
    return surplus.select(F.lit(name).alias("rule"), "violations")


def reference_violations(df: DataFrame, name: str, dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of rows whose key, where present, is missing from the dimension."""
    orphans = orphan_keys(df.dropna(subset=list(key)), dim, key)
    total = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations")
    return orphans.agg(total).select(F.lit(name).alias("rule"), "violations")


def constraint_report(
    df: DataFrame,
    checks: Mapping[str, Column],
    unique: Mapping[str, Sequence[str]] | None = None,
    references: Mapping[str, tuple[DataFrame, Sequence[str]]] | None = None,
) -> DataFrame:
    """(rule, violations) for CHECK / NOT NULL, UNIQUE and foreign-key rules."""
    report = rule_violations(df, checks)
    for name, key in (unique or {}).items():
        report = report.unionByName(unique_violations(df, name, key))
    for name, (dim, key) in (references or {}).items():
        report = report.unionByName(reference_violations(df, name, dim, key))
    return report


def enforce(df: DataFrame, report: DataFrame) -> DataFrame:
    """Return ``df`` if the constraint report is clean, else refuse."""
    broken = report.where("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))
    return df


# --- two-tier gate -----------------------------------------------------------------


def gate_check(
    df: DataFrame, check: str, tier: str, observed: Column, threshold: float,
    subject: Column | None = None,
) -> DataFrame:
    """Rows of the gate: a value above its threshold, or missing, is not ok."""
    value = observed.cast("double")
    return df.select(
        F.lit(check).alias("check"),
        F.lit(tier).alias("tier"),
        (F.lit(None).cast("string") if subject is None else subject).alias("subject"),
        value.alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(value <= threshold, F.lit(False)).alias("ok"),
    )


def quality_gate(
    fact: DataFrame,
    dim: DataFrame,
    audit: DataFrame,
    *,
    key: Sequence[str],
    dim_key: Sequence[str],
    required: Bounds,
    optional: Bounds,
    moment: str,
    as_of: datetime,
    bad: Column,
    bad_by: Sequence[str],
    max_age_days: float = 14,
    max_bad_pct: float = 15.0,
    max_rejected_pct: float = 5.0,
) -> DataFrame:
    """FAIL rows for wrong data, WARN rows for data worth a look.

    FAIL: duplicate keys, values out of bounds, fact rows without a dimension row.
    WARN: stale data, groups with many bad readings, a high rejection rate in the
    last load, or no load on record. Duplicates take one pass over the facts; all else
    comes from a stored summary with one row per entity.
    """
    per_entity = fact.groupBy(*dict.fromkeys([*dim_key, *bad_by])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad).alias("n_bad"),
        F.count_if(_breaks_bounds(required, optional)).alias("n_wrong"),
        F.max(moment).alias("latest"),
    )
    profile = stored(per_entity, "gate-profile")
    wrong = profile.agg(F.coalesce(F.sum("n_wrong"), F.lit(0)).alias("violations"))
    strays = profile.join(dim.select(*dim_key), list(dim_key), "left_anti")
    orphans = strays.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))
    age = freshness(profile, "latest", as_of).where(F.col("latest").isNotNull())
    rate = half_up(percent(F.sum("n_bad"), F.sum("n_rows")), 1)
    noisy = profile.groupBy(*bad_by).agg(rate.alias("bad_pct")).where(F.col("bad_pct") > max_bad_pct)
    subject = F.concat_ws(" @ ", *[F.col(c).cast("string") for c in bad_by])
    checks = [
        gate_check(unique_violations(fact, "", key), "duplicate_keys", "FAIL", F.col("violations"), 0),
        gate_check(wrong, "out_of_range", "FAIL", F.col("violations"), 0),
        gate_check(orphans, "orphans", "FAIL", F.col("violations"), 0),
        gate_check(age, "age_days", "WARN", F.col("age_days"), max_age_days),
        gate_check(noisy, "bad_pct", "WARN", F.col("bad_pct"), max_bad_pct, subject),
        gate_check(last_rejection(audit), "rejected_pct", "WARN", F.col("rejected_pct"), max_rejected_pct),
    ]
    gate = checks[0]
    for check in checks[1:]:
        gate = gate.unionByName(check)
    return gate


def last_rejection(audit: DataFrame) -> DataFrame:
    """Rejected share of the latest load in percent; NULL when no load is on record."""
    last = audit.agg(
        F.max_by(F.struct("rows_source", "rows_rejected"), "finished_at").alias("last")
    )
    share = percent(F.col("last.rows_rejected"), F.col("last.rows_source"))
    empty = F.col("last.rows_source") == 0
    return last.select(F.when(empty, F.lit(0.0)).otherwise(share).alias("rejected_pct"))


def gate_passed(gate: DataFrame) -> bool:
    """The gate fails only on FAIL rows; warnings let it pass."""
    return gate.where((F.col("tier") == "FAIL") & ~F.col("ok")).isEmpty()
