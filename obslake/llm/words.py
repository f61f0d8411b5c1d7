"""Column expressions that several text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def words_of(text: Column) -> Column:
    """The words in order; no empty strings."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased, other characters as they are."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def hash_pair(prefix: str, *columns: Column) -> dict[str, Column]:
    """A 128-bit hash as two long columns."""
    return {
        f"{prefix}1": F.xxhash64(*columns),
        f"{prefix}2": F.xxhash64(F.lit(0x5EED), *columns),
    }


def fold(column: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(column.cast("string").cast("binary")) % folds


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks."""
    return "`" + name.replace("`", "``") + "`"


def widened(df: DataFrame, own: list[str], run: Callable, added: StructType) -> DataFrame:
    """Columns ``own`` as they are and those that ``run`` adds to each batch of them.

    ``run`` sees columns by position, so that any name may be among them.
    """
    plain = df.select(*[F.col(quoted(c)).alias(f"_{i}") for i, c in enumerate(own)])
    shape = StructType([*plain.schema.fields, *added.fields])
    return plain.mapInArrow(run, shape).toDF(*own, *added.names)


def together(columns: list[str], name: str = "_own") -> Column:
    """The caller's columns as one, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in columns]).alias(name)
