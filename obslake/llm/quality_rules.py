"""Quality rules as a ledger of bits.

Every rule is evaluated once; the ledger keeps the measurements and one bit per failed
rule. Policies are masks over those bits, so that a new policy, or the effect of leaving
a rule out, needs no second look at the texts. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.words import SPACE, text_or_empty, together, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_echoes", "n_repeat_words",
)


@dataclass(frozen=True)
class Rule:
    """A failed rule sets its bit; ``fails`` is SQL over the measurements."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", 3, "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 20 * n_words"),
    Rule("echoes", 6, "100 * n_echoes > 30 * n_words"),
)
BASE = ("few_words", "repeated_words")
POLICIES: Mapping[str, Sequence[str]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    return sum(1 << rule.bit for rule in rules if rule.name in names)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements of each whole text.

    Words are runs without ASCII white space; ``n_repeat_words`` counts words inside
    five-word windows found at least twice in the text, ``n_echoes`` words equal to the one
    before. Null text counts as empty, all
    measurements 0. Columns named like the measurements are replaced.
    """
    own = [c for c in df.columns if c not in MEASURES]
    body = F.col("_text")
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
    )
    spoken = F.filter(F.split(body, "\n", -1), lambda line: F.translate(line, SPACE, "") != "")
    read = (
        df.select(together(own), text_or_empty(text).alias("_text"))
        .select(
            "_own",
            F.transform(words_of(body), lambda w: F.xxhash64(w)).alias("_words"),
            F.length(F.translate(body, SPACE, "")).cast("bigint").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            spoken.alias("_spoken"),
        )
        .select(
            "_own",
            F.size("_words").cast("bigint").alias("n_words"),
            "word_chars",
            "n_symbols",
            F.size("_spoken").cast("bigint").alias("n_lines"),
            (F.size("_spoken") - F.size(F.array_distinct("_spoken"))).cast("bigint").alias("n_dup_lines"),
            F.size(F.filter("_words", lambda w, i: w.eqNullSafe(F.get("_words", i - 1)))).cast("bigint").alias("n_echoes"),
            F.when(F.size("_words") >= WINDOW, windows).alias("_windows"),
        )
    )
    # Only texts with a repeated window are sorted: equal windows become neighbours.
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = read.withColumn(
        "_sorted", F.when(F.size("_windows") > F.size(F.array_distinct("_windows")), placed)
    )
    neighbour = lambda x, at: F.get("_sorted", at)["h"].eqNullSafe(x["h"])
    repeated = F.filter("_sorted", lambda x, j: neighbour(x, j - 1) | neighbour(x, j + 1))
    found = found.withColumn("_starts", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.transform(
        "_starts",
        lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", j + 1) - p, F.lit(WINDOW))),
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("bigint")).select(
        *[F.col("_own")[c].alias(c) for c in own], *MEASURES
    )


def ledger(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with measurements and ``failed_bits``, one bit per failed rule."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    whole = reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0))
    return measured(df, text).withColumn("failed_bits", whole.cast("bigint"))


def passes(policy: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules))) == 0


def apply_policy(
    kept_ledger: DataFrame, version: str, policies: Mapping[str, Sequence[str]] = POLICIES
) -> DataFrame:
    """The ledger with ``policy`` and ``kept`` under that version."""
    return kept_ledger.withColumns({"policy": F.lit(version), "kept": passes(policies[version])})


def ablations(
    kept_ledger: DataFrame,
    version: str,
    policies: Mapping[str, Sequence[str]] = POLICIES,
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Per rule of a policy: documents failing it, and documents kept if it were left out.

    The ledger is first counted per combination of bits, so the rest is bounded by the
    number of combinations.
    """
    names = policies[version]
    counts = kept_ledger.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("_n"))
    own = [r for r in rules if r.name in names]
    if not own:
        return kept_ledger.sparkSession.createDataFrame([], "rule string, n_failed long, n_rescued long")
    each = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("bit")) for r in own])
    )
    under = F.col("failed_bits").bitwiseAND(F.lit(mask(names, rules)))
    return (
        counts.select("_n", under.alias("_under"), each.alias("_r"))
        .groupBy(F.col("_r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("_under").bitwiseAND(F.col("_r.bit")) != 0, F.col("_n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("_under") == F.col("_r.bit"), F.col("_n")).otherwise(0)).alias("n_rescued"),
        )
    )
