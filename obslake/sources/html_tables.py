"""HTML tables out of a corpus of pages.

The tokeniser is the one step Spark has no expression for; it runs per page inside
``mapInArrow``, with a full parser only for pages that are not plain markup. Everything after it, from header wording to records, is built-in.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a season table announces its season and allowance.
SEASON_HEADER = (
    r"(?i)Quota\s*Year\s*(\d{4}/\d{2}).*?TAC\s*([\d,]+\.?\d*)\s*tonnes"
)

# Zero-width space and asterisk carry no meaning in these tables.
DROPPED = {0x200B: None, ord("*"): None}

ROWS_TYPE = T.ArrayType(T.ArrayType(T.StringType()))
ROWS_ARROW = pa.list_(pa.list_(pa.string()))
PAGES_PER_BATCH = 256


# What stands between "<" and ">" of plain markup: a tag, a comment or a doctype.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[A-Za-z0-9_.:#%-]+(?=[ \t\n]|$(?!\n)))"""
_MARKUP = re.compile(
    rf"(/?)([A-Za-z][A-Za-z0-9]*+)(?:[ \t\n]+[A-Za-z][A-Za-z0-9_:.-]*+(?:={_VALUE})?)*+[ \t\n]*+(/?)"
    r"|!(?:(?i:doctype)\b.*|--[^-]++--)",
    re.DOTALL,
)
_TABLE_TAGS = {
    "td": "cell", "th": "cell", "tr": "row", "table": "table", "thead": "section", "tbody": "section", "tfoot": "section",
}
_HIDDEN_TAGS = ("script", "style")
# What these hold is no markup, in some or all parsers.
_TEXT_TAGS = ("title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext")


@lru_cache(maxsize=4096)
def _effect(markup: str) -> str | None:
    """What plain markup does to a table, "" for nothing, None if it is not plain."""
    found = _MARKUP.fullmatch(markup)
    if not found:
        return None
    closing, tag, empty = found.groups()
    tag = (tag or "").lower()
    if tag in _TEXT_TAGS or tag in _HIDDEN_TAGS and (closing and markup[1:].lower() != tag or empty):
        return None
    if tag in _HIDDEN_TAGS:
        return f"/{tag}" if closing else tag
    kind = _TABLE_TAGS.get(tag, "")
    if kind == "section":
        return "/row" if closing or empty else ""
    return f"/{kind}" if closing and kind else f"{kind}/" if empty and kind else kind


def clean_cell(text: str) -> str:
    """Normalise, drop zero-width spaces and asterisks, collapse blanks."""
    if text.isascii():
        return " ".join(text.replace("*", "").split())
    return " ".join(unicodedata.normalize("NFKC", text).translate(DROPPED).split())


class _TableReader(HTMLParser):
    """Collects tables as rows of cell texts.

    A row belongs to every table it is nested in, a cell to every open row, and text
    to every open cell. Cells and rows left open end where the next one starts.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list[str]]]] = []
        self._open: list[tuple[str, list]] = []  # table, tr and cell, outermost first
        self._hidden = 0

    def _close_within_table(self, kinds: tuple[str, ...]) -> None:
        inner = max((i for i, (k, _) in enumerate(self._open) if k == "table"), default=-1)
        hits = [i for i, (k, _) in enumerate(self._open) if i > inner and k in kinds]
        if hits:
            del self._open[hits[0] :]

    def _ancestors(self, kind: str) -> list[list]:
        return [item for k, item in self._open if k == kind]

    def handle_starttag(self, tag: str, attrs: object) -> None:
        if tag in ("script", "style"):
            self._hidden += 1
        elif tag == "table":
            table: list = []
            self.tables.append(table)
            self._open.append(("table", table))
        elif tag == "tr" and self._ancestors("table"):
            self._close_within_table(("tr", "cell"))
            row: list = []
            for table in self._ancestors("table"):
                table.append(row)
            self._open.append(("tr", row))
        elif tag in ("td", "th") and self._ancestors("table"):
            self._close_within_table(("cell",))
            cell: list[str] = []
            for row in self._ancestors("tr"):
                row.append(cell)
            self._open.append(("cell", cell))

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self._hidden = max(0, self._hidden - 1)
        elif tag in ("td", "th"):
            self._close_within_table(("cell",))
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            self._close_within_table(("tr", "cell"))
        elif tag == "table":
            tables = [i for i, (k, _) in enumerate(self._open) if k == "table"]
            if tables:
                del self._open[tables[-1] :]

    def handle_data(self, data: str) -> None:
        if not self._hidden:
            for cell in self._ancestors("cell"):
                cell.append(data)


def _plain_tables(html: str) -> list[list[list[str]]] | None:
    """Cell texts of a page of plain markup without nested tables, None for any other page.

    The same as ``_TableReader`` gives, whose parser takes several times as long.
    """
    tables: list[list[list[str]]] = []
    table = row = hidden = None
    inside = False  # an open cell of an open row
    for piece in html.split("<")[1:]:
        markup, end, text = piece.partition(">")
        effect = _effect(markup)
        if effect is None or not end:
            return None
        if hidden is not None:
            if effect != f"/{hidden}":
                return None
            hidden = None
        elif effect in ("/script", "/style"):
            return None
        elif effect == "cell":
            inside = row is not None
            if inside:
                row.append(unescape(text) if "&" in text else text)
            continue
        elif effect == "/cell":
            inside = False
        elif effect == "row":
            inside, row = False, None
            if table is not None:
                table.append(row := [])
        elif effect == "/row":
            inside, row = False, None
        elif effect == "table" or effect == "table/":
            if table is not None:
                return None
            tables.append(new := [])
            inside, row, table = False, None, new if effect == "table" else None
        elif effect == "/table":
            inside, row, table = False, None, None
        elif effect == "cell/":
            inside = False
            if row is not None:
                row.append("")
        elif effect == "row/":
            inside, row = False, None
            if table is not None:
                table.append([])
        elif effect:
            hidden = effect
            continue
        if inside and text:
            row[-1] += unescape(text) if "&" in text else text
    return tables if hidden is None else None


def page_tables(html: str) -> list[list[list[str]]]:
    """Tables of one page; rows whose cells are all blank are left out."""
    found = _plain_tables(html)
    if found is None:
        reader = _TableReader()
        reader.feed(html)
        reader.close()
        found = [[["".join(cell) for cell in row] for row in table] for table in reader.tables]
    tables = []
    for raw in found:
        rows = [[clean_cell(cell) for cell in row] for row in raw]
        rows = [row for row in rows if any(row)]
        if rows:
            tables.append(rows)
    return tables


def html_tables(pages: DataFrame, key: Sequence[str], html: str) -> DataFrame:
    """One row per table: the page key, the table's number on the page, its rows.

    Pages without a table never leave the JVM.
    """
    keyed = pages.select(*key, F.col(html).alias("_html")).where(
        F.col("_html").rlike("(?i)<table")
    )
    schema = T.StructType(
        [keyed.schema[k] for k in key]
        + [T.StructField("table_no", T.IntegerType()), T.StructField("rows", ROWS_TYPE)]
    )

    def tables(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(start, PAGES_PER_BATCH)
                page_at, numbers, rows = [], [], []
                for at, text in enumerate(part.column("_html").to_pylist()):
                    for number, table in enumerate(page_tables(text)):
                        page_at.append(at)
                        numbers.append(number)
                        rows.append(table)
                keys = part.select(list(key)).take(pa.array(page_at, pa.int64()))
                found = [pa.array(numbers, pa.int32()), pa.array(rows, ROWS_ARROW)]
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, *found], [*key, "table_no", "rows"]
                )

    return keyed.mapInArrow(tables, schema)


def season_records(tables: DataFrame, key: Sequence[str]) -> DataFrame:
    """Raw text records of season tables, one per body row; other tables give none.

    The header cell names season and allowance, the second header cell the unit, and
    the header's width the layout: four columns or more carry a remainder column, in
    three the percentage takes its place.
    """
    header = F.col("rows")[0]
    wide = F.size(header) >= 4
    unit_text = F.lower(F.coalesce(F.get(header, F.lit(1)), F.lit("")))
    described = tables.select(
        *key,
        "table_no",
        F.regexp_extract(header[0], SEASON_HEADER, 1).alias("quota_year"),
        F.replace(F.regexp_extract(header[0], SEASON_HEADER, 2), F.lit(","), F.lit("")).alias(
            "tac_tonnes_raw"
        ),
        F.when(unit_text.contains("kg"), "kg").otherwise("tonnes").alias("catch_unit_raw"),
        wide.alias("_wide"),
        F.posexplode(F.expr("slice(rows, 2, greatest(size(rows) - 1, 0))")).alias("row_no", "_cells"),
    ).where((F.col("quota_year") != "") & (F.size("_cells") >= 2))
    label = F.col("_cells")[0]
    return described.select(
        *key,
        "table_no",
        "row_no",
        "quota_year",
        "tac_tonnes_raw",
        label.alias("row_label"),
        F.upper(label).contains("TOTAL").alias("is_total_row"),
        _cell(1).alias("catch_raw"),
        "catch_unit_raw",
        F.when(F.col("_wide"), _cell(2)).otherwise("").alias("uncaught_raw"),
        F.when(F.col("_wide"), _cell(3)).otherwise(_cell(2)).alias("pct_tac_taken_raw"),
    )


def _cell(position: int) -> Column:
    return F.coalesce(F.get("_cells", F.lit(position)), F.lit(""))
