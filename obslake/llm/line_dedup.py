"""Line deduplication: lines that many documents share stay in one document only.

Normalised lines are exploded with their positions and hashed; documents are counted
per hash; positions of lines over the threshold are gathered per document, and the
document is put together again from the positions that stay. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.words import hash_pair, line_key, text_or_empty, together


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _row_hash() -> Column:
    return F.xxhash64("_text")


def repeated_line_positions(df: DataFrame, doc_id: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """Per row (id, hash of the text) the positions of the lines to drop."""
    rows = df.select(F.col(doc_id).alias("_id"), text_or_empty(text).alias("_text"))
    lines = (
        rows.select("_id", _row_hash().alias("_row"), F.posexplode(_lines(F.col("_text"))).alias("_at", "_line"))
        .select("_id", "_row", "_at", line_key(F.col("_line")).alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select("_id", "_row", "_at", *[c.alias(n) for n, c in hash_pair("_k", F.col("_key")).items()])
    )
    shared = (
        lines.groupBy("_k1", "_k2", "_id")
        .agg(F.lit(1).alias("_one"))
        .groupBy("_k1", "_k2")
        .agg(F.count("_one").alias("_docs"), F.max("_id").alias("_last"))
        .where(F.col("_docs") >= min_docs)
        .select("_k1", "_k2", "_last")
    )
    return (
        lines.join(shared, ["_k1", "_k2"])
        .where(~F.col("_id").eqNullSafe(F.col("_last")))
        .groupBy("_id", "_row")
        .agg(F.collect_list("_at").alias("_drop"))
    )


def drop_repeated_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """All columns of ``df`` with the shared lines gone, plus two counts.

    A line's key is the line stripped of white space at both ends with A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all lines except in the document with the largest id.

    Null or empty text is one empty line and becomes an empty text. Rows that share an id
    are one document and keep or lose the same lines; a null id is one document below all
    others. Existing columns named like the counts are replaced. An empty table gives an
    empty result.
    """
    drops = repeated_line_positions(df, doc_id, text, min_chars, min_docs)
    out = [c for c in df.columns if c not in (n_lines, n_dropped)]
    rows = df.select(
        together(out), F.col(doc_id).alias("_id"), text_or_empty(text).alias("_text")
    ).withColumn("_row", _row_hash())
    match = F.col("_d._id").eqNullSafe(F.col("_x._id")) & (F.col("_d._row") == F.col("_x._row"))
    joined = rows.alias("_d").join(drops.alias("_x"), match, "left").select(
        "_own",
        _lines(F.col("_text")).alias("_lines"),
        F.array_distinct(F.coalesce("_drop", F.array().cast("array<int>"))).alias("_drop"),
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_drop")
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    whole = F.array_join("_lines", "\n")
    body = F.when(F.size("_drop") == 0, whole).otherwise(kept)
    return joined.select(
        *[(body if c == text else F.col("_own")[c]).alias(c) for c in out],
        F.size("_lines").cast("bigint").alias(n_lines),
        F.size("_drop").cast("bigint").alias(n_dropped),
    )
