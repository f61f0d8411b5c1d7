"""Text cleaning, lenient parsing and unit conversion as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# English month names in calendar order.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# What a plain decimal number looks like once commas are gone.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
REPEATED_DOTS = r"\.{2,}"


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    """Unicode compatibility normalisation, which Spark has no built-in for.

    Value by value: Arrow's kernel of that name leaves letters and accents apart.
    """
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def strip_marks(text: Column) -> Column:
    """Drop zero-width spaces and asterisks, turn odd blanks into one space, trim."""
    kept = F.translate(text, "\x1c\x1d\x1e\x1f​*", "    ")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def clean_text(text: Column) -> Column:
    """Normalise, then strip marks. ASCII values need no NFKC and go to it as NULL."""
    beyond_ascii = F.when(text.rlike(r"[^\x00-\x7F]"), text)
    return strip_marks(F.coalesce(nfkc(beyond_ascii), text))


def has_repeated_dots(text: Column) -> Column:
    """True where a number carries a run of dots; a missing text counts as clean."""
    return F.coalesce(text.rlike(REPEATED_DOTS), F.lit(False))


def to_number(text: Column) -> Column:
    """Parse ``1,023.5`` or ``393..07``; blank or unreadable text becomes NULL."""
    bare = F.trim(F.replace(text.cast("string"), F.lit(","), F.lit("")))
    single = F.regexp_replace(bare, REPEATED_DOTS, ".")
    digits = F.regexp_replace(single, r"(?<=[0-9])_(?=[0-9])", "")
    return F.when(digits.rlike(PLAIN_NUMBER), digits.try_cast("double"))


def month_start(label: Column) -> Column:
    """First day of the month named at the start of ``March 2007 ...``, else NULL."""
    pattern = r"^([A-Za-z]+)\s+([0-9]{4})"
    name = F.lower(F.regexp_extract(label, pattern, 1))
    year = F.regexp_extract(label, pattern, 2).try_cast("int")
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTH_NAMES, 1) for x in (m, i)])
    return F.make_date(year, F.try_element_at(numbers, name), F.lit(1))


def kilograms_to_tonnes(value: Column, unit: Column) -> Column:
    """Divide by 1000 where the unit says kg."""
    return F.when(F.lower(unit) == "kg", value / 1000).otherwise(value)


def blank_to_null(text: Column) -> Column:
    """Empty text is a missing value."""
    return F.nullif(text, F.lit(""))


def is_true_text(flag: Column) -> Column:
    """Case-insensitive text boolean; a missing flag is false."""
    return F.coalesce(F.lower(flag.cast("string")) == "true", F.lit(False))


def display_label(identifier: Column, common_name: Column) -> Column:
    """``common (identifier)`` where a common name is known, else the identifier."""
    labelled = F.concat(common_name, F.lit(" ("), identifier, F.lit(")"))
    return F.when(common_name.isNotNull(), labelled).otherwise(identifier)
