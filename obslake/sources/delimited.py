"""Delimited text: explicit schemas, header contracts, files with a preamble."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.session import stored


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text, in the given order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All-text CSV in which a blank stays an empty string."""
    return read_csv(spark, path, text_schema(columns)).na.fill("")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    comment: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """Typed CSV with a header line. The header of every file must agree with the schema.

    ``line_breaks`` reads quoted line breaks inside values; a file then is one split.

    Column pruning is off in the parser: a pruned read, a count for one, would only
    compare the columns it needs and let a wrong header pass.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    reader = reader.option("columnPruning", False).option("mode", "FAILFAST")
    reader = reader.option("dateFormat", "yyyy-MM-dd").option("recursiveFileLookup", True)
    if comment:
        reader = reader.option("comment", comment)
    if line_breaks:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def read_below_preamble(
    spark: SparkSession,
    path: str | list[str],
    header: Sequence[str],
    comment: str | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """Verbatim text rows below a preamble of unknown length; blank becomes NULL.

    A preamble whose lines all start with ``comment`` is left to the CSV reader.
    Otherwise the rows start after the first line that equals the header. Its place is
    found once for every file and written down; files stay splittable, and no line
    passes through Python. A file without the header is an error.

    ``line_breaks`` reads quoted line breaks inside values; they come back as newlines. On
    the first way a file is then one split, on the second it is not.
    """
    schema = text_schema(header)
    if comment:
        return read_csv(spark, path, schema, comment, line_breaks)
    lines = _lines(spark, path)
    headers = stored(_header_places(lines, header), "headers")
    refused = F.raise_error(F.concat(F.lit(f"no header line {list(header)} in "), F.col("file")))
    place = F.when(F.col("_header").isNull(), refused.cast(headers.schema["_header"].dataType))
    below = lines.join(headers, "file").where(F.struct("block", "at") > place.otherwise(F.col("_header")))
    records = _whole_records(below) if line_breaks else below.select("value")
    options = {"mode": "FAILFAST"} | ({"escape": '"'} if line_breaks else {})
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema)
    return records.where(F.trim("value") != "").select(F.from_csv("value", ddl, options).alias("_row")).select("_row.*")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, the start of their split, and a number that grows along a split."""
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _header_places(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """(file, _header): where the first line that equals the header lies, NULL without one."""
    fields = [f"_{i}" for i in range(len(header) + 1)]
    line = F.from_csv(F.ltrim(F.col("value"), F.lit("\ufeff")), ", ".join(f"{f} STRING" for f in fields))
    found = reduce(and_, [line[f].eqNullSafe(F.lit(name)) for f, name in zip(fields, [*header, None])])
    # Few lines hold the first name: only these are parsed.
    likely = F.col("value").contains(header[0]) & found
    return lines.groupBy("file").agg(F.min(F.when(likely, F.struct("block", "at"))).alias("_header"))


def _whole_records(lines: DataFrame) -> DataFrame:
    """Lines joined to records wherever a quoted value goes on in the next line.

    A record is open behind a line when the number of quotes up to there is odd. Per split
    the lines with an odd number are counted; their running sum over the splits of a file
    tells whether a split begins inside a record, and which split that record began in.
    Lines are then judged split by split, and only those of records with line breaks are
    brought together. A record, however long, is one value; so is what follows a quote that
    is never closed.
    """
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    odd = lines.withColumn("_odd", F.pmod(quotes, F.lit(2)))
    splits = stored(odd.groupBy("file", "block").agg(F.sum("_odd").alias("_odd_lines")), "quote-parity")
    if not splits.agg(F.sum("_odd_lines")).first()[0]:
        return lines.select("value")
    by_file = Window.partitionBy("file").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    began = F.when((F.col("_odd_lines") > 0) | (F.col("_open") == 0), F.col("block"))
    splits = splits.withColumn("_open", F.coalesce(F.sum("_odd_lines").over(earlier), F.lit(0)) % 2)
    splits = stored(splits.withColumn("_carried", F.last(began, ignorenulls=True).over(earlier)), "open-records")

    in_split = Window.partitionBy("file", "block").orderBy("at")
    before = in_split.rowsBetween(Window.unboundedPreceding, -1)
    opened = (F.col("_open") + F.coalesce(F.sum("_odd").over(before), F.lit(0))) % 2 == 1
    judged = odd.join(splits, ["file", "block"]).withColumn("_inside", opened)
    start = F.when(~F.col("_inside"), F.col("at"))
    judged = judged.withColumns(
        {
            "_start": F.last(start, ignorenulls=True).over(in_split),
            "_last_start": F.max(start).over(Window.partitionBy("file", "block")),
            "_on": F.col("_inside").cast("int") != F.col("_odd"),
        }
    )
    single = judged.where(~F.col("_inside") & ~F.col("_on")).select("value")
    # The record still open at the end of a split has no number there: the next split knows it too.
    left_open = ((F.col("_open") + F.col("_odd_lines")) % 2 == 1) & (F.col("_start") == F.col("_last_start"))
    pieces = judged.where(F.col("_inside") | F.col("_on")).select(
        "file", "block", "at", "value",
        F.when(F.col("_start").isNull(), F.col("_carried")).otherwise(F.col("block")).alias("_from"),
        F.when(F.col("_start").isNotNull() & ~left_open, F.col("_start")).alias("_number"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    whole = pieces.groupBy("file", "_from", "_number").agg(in_order.alias("_pieces"))
    return single.unionByName(whole.select(F.array_join(F.col("_pieces.value"), "\n").alias("value")))


def header_lines(spark: SparkSession, path: str | list[str], comment: str | None = None) -> DataFrame:
    """(file, header): the first line of every file that is not blank or a comment."""
    content = F.trim("value") != ""
    if comment:
        content = content & ~F.col("value").startswith(comment)
    opening = _lines(spark, path).where((F.col("block") == 0) & content)
    return opening.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def check_header(
    spark: SparkSession, path: str | list[str], expected: Sequence[str], comment: str | None = None
) -> None:
    """Refuse files whose header is not exactly the expected columns in order."""
    wanted = ",".join(expected)
    seen = F.regexp_replace(F.trim(F.regexp_replace("header", "^﻿", "")), '"', "")
    wrong = header_lines(spark, path, comment).where(seen != wanted).limit(1).collect()
    if wrong:
        raise ValueError(
            f"header of {wrong[0]['file']} does not match\nexpected: {wanted}\ngot: {wrong[0]['header']}"
        )


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Refuse input that lacks any required column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def find_column(df: DataFrame, candidates: Sequence[str], kind: str) -> str:
    """The first candidate name that exists."""
    for name in candidates:
        if name in df.columns:
            return name
    raise KeyError(f"no {kind} column among {list(candidates)} in {df.columns}")


def rename_first(
    df: DataFrame, required: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Select columns by candidate names; an absent optional one becomes NULL."""
    chosen = [F.col(find_column(df, names, new)).alias(new) for new, names in required.items()]
    for new, names in optional.items():
        present = [n for n in names if n in df.columns]
        chosen.append((F.col(present[0]) if present else F.lit(None).cast("double")).alias(new))
    return df.select(*chosen)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_sources(
    spark: SparkSession, sources: Mapping[str, str], headers: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Several files under the same contract: table name -> verbatim rows."""
    return {
        table: lower_columns(read_below_preamble(spark, path, headers[table]))
        for table, path in sources.items()
    }
