"""Season tables in the layouts found in the wild, through to the star schema."""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import dataclass
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obslake.operators import quality
from obslake.plans import season_catch as plan
from obslake.session import new_path
from obslake.sources import html_tables as html_source
from obslake.sources import tables
from obslake.sources.html_tables import page_tables
from tests.conftest import rows

ZW = "\u200b"


@dataclass(frozen=True)
class Season:
    """One season's table: its layout, its allowance, and the catch of some months."""

    year: int
    allowance: int
    layout: str  # wide, kg or narrow
    caught: dict[int, Decimal | None]  # by month number; None: not reported yet
    doubled: int | None = None  # the month whose remainder has a doubled dot

    @property
    def name(self) -> str:
        return f"{self.year}/{(self.year + 1) % 100:02d}"

    def date(self, month: int) -> dt.date:
        return dt.date(self.year + (month < 3), month, 1)

    def so_far(self, month: int) -> Decimal:
        months = list(self.caught)
        return sum(self.caught[m] or 0 for m in months[: months.index(month) + 1])

    def left(self, month: int) -> Decimal:
        return self.allowance - self.so_far(month)

    @property
    def total(self) -> Decimal:
        return sum(c for c in self.caught.values() if c is not None) + 100 + self.year % 7


def figures(start: str, step: str, months: list[int]) -> dict[int, Decimal]:
    return {m: Decimal(start) + i * Decimal(step) for i, m in enumerate(months)}


SEASONS = [
    Season(2031, 900, "wide", figures("40.5", "21.75", [3, 6]) | {9: None}),
    Season(2028, 880, "wide", figures("55.5", "15.75", [4, 10]), doubled=10),
    Season(2019, 1200, "kg", figures("90.125", "60.375", [3, 1])),
    Season(2015, 1400, "narrow", figures("120.5", "9.75", [3, 2])),
]
BY_YEAR = {s.year: s for s in SEASONS}


def share(amount: Decimal, season: Season) -> Decimal:
    return round(100 * amount / season.allowance, 2)


def html_table(header: list[str], *body: list[str]) -> str:
    def tr(cells, tag):
        return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>\n"

    return "<table>" + tr(header, "th") + "".join(tr(r, "td") for r in body) + "</table>"


def season_table(season: Season) -> str:
    """The table as a page would show it, zero-width spaces and asterisks included."""
    def month_name(month: int) -> str:
        return season.date(month).strftime("%B %Y")

    if season.layout == "narrow":
        header = [f"{ZW}**Quota Year {season.name}**{ZW} TAC {season.allowance}.0 t{ZW}onnes", "**Brought in** (tonnes)", "**Share**"]
        body = [[month_name(m), str(c), str(share(c, season))] for m, c in season.caught.items()]
        return html_table(header, *body, ["**TOTAL**", f"<b>{season.total}</b>", f"<b>{share(season.total, season)}</b>"])
    if season.layout == "kg":
        header = [f"{ZW}**Quota year {season.name} TAC {season.allowance:,}.00 tonnes**", "**Brought in (kg)**", "**Left**", "**Share**"]
        body = [
            [month_name(m), f"{ZW}{ZW}{c * 1000:,.2f}", f"{season.left(m) * 1000:,.2f}", str(share(c, season))]
            for m, c in season.caught.items()
        ]
        return html_table(header, *body, ["**TOTAL**", f"<b>{season.total * 1000:,.2f}</b>", "", f"<b>{share(season.total, season)}</b>"])
    header = [f"Quota year {season.name} TAC {season.allowance}.00 tonnes{ZW}", "Brought in (tonnes)", "Left (tonnes)", f"{ZW}Share"]
    body = []
    for m, c in season.caught.items():
        left = "" if c is None else str(season.left(m))
        left = left.replace(".", "..") if m == season.doubled else left
        body.append([f"{ZW}{month_name(m)}", "" if c is None else str(c), left, "" if c is None else str(share(c, season))])
    return html_table(header, *body, [f"{ZW}TOTAL", f"<b>{season.total}</b>", "<b>1.5</b>", f"<b>{share(season.total, season)}</b>"])


PAGE = (
    "<html><body><!-- <table> in a comment -->"
    + "".join(map(season_table, SEASONS))
    + "<table><tr><td>Opening hours</td></tr></table></body></html>"
)
N_MONTHS = sum(len(s.caught) for s in SEASONS)
N_REPORTED = sum(c is not None for s in SEASONS for c in s.caught.values())


@pytest.fixture(scope="module")
def raw(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, "v", "<p>no table</p>")], "page_id long, url string, html string")
    return plan.raw_records(pages, dt.datetime(2031, 10, 1)).cache()


@pytest.fixture(scope="module")
def clean(raw):
    return plan.clean_months(raw)[0].cache()


@pytest.fixture(scope="module")
def star(clean, raw):
    return plan.star_schema(clean, plan.published_totals(raw))


def test_page_structure():
    tables = page_tables(PAGE)
    assert len(tables) == 5
    assert tables[3][0][0] == "Quota Year 2015/16 TAC 1400.0 tonnes"


def test_nested_and_unclosed_tables():
    html = "<table><tr><td>a<table><tr><td>b<td>c</table>d<tr><td>e<script>x<td></script></table><td>f"
    assert page_tables(html) == [
        [["abcd", "b", "c"], ["b", "c"], ["e"]],
        [["b", "c"]],
    ]


def test_records(raw):
    assert raw.count() == N_MONTHS + len(SEASONS)
    assert raw.where("is_total_row").count() == len(SEASONS)
    assert rows(raw.select("quota_year", "catch_unit_raw").distinct()) == sorted(
        (s.name, "kg" if s.layout == "kg" else "tonnes") for s in SEASONS
    )
    old = raw.where("quota_year = '2015/16' and row_label like 'March%'").first()
    assert (old["uncaught_raw"], old["pct_tac_taken_raw"]) == ("", str(share(BY_YEAR[2015].caught[3], BY_YEAR[2015])))


def test_clean_months(clean):
    by = {(r["quota_year"], r["month_date"]): r for r in clean.collect()}
    assert set(by) == {(s.name, s.date(m)) for s in SEASONS for m in s.caught}
    for season in SEASONS:
        for month, caught in season.caught.items():
            row = by[season.name, season.date(month)]
            assert row["tac_tonnes"] == season.allowance
            assert row["catch_tonnes"] == (caught if caught is None else pytest.approx(float(caught)))
            known = caught is not None and season.layout != "narrow"
            assert row["uncaught_tonnes"] == (pytest.approx(float(season.left(month))) if known else None)
            assert row["uncaught_had_typo"] == (month == season.doubled)
            assert row["flag_not_yet_reported"] == (caught is None)
            assert row["any_flag"] == (month == season.doubled)
    assert rows(plan.run_summary(clean)) == [(N_MONTHS, len(SEASONS), 1, N_MONTHS - N_REPORTED)]


def missing(season: Season) -> float:
    """What the published total has beyond the months shown."""
    return float(season.total - sum(c for c in season.caught.values() if c is not None))


def test_reconciliation_of_a_subset_fails(clean, raw):
    report = plan.reconciliation(clean, plan.published_totals(raw))
    assert rows(report.select("quota_year", "diff_tonnes", "reconciles")) == sorted(
        (s.name, pytest.approx(missing(s)), False) for s in SEASONS
    )


def test_unparsed_labels_are_reported(spark, raw):
    odd = raw.withColumn("row_label", F.when(F.col("row_label") == "March 2031", "Spring").otherwise(F.col("row_label")))
    good, rejects = plan.clean_months(odd)
    assert good.count() == N_MONTHS - 1
    assert rows(rejects) == [("2031/32", "Spring")]


def test_star_schema(star):
    assert star["dim_season"].count() == len(SEASONS)
    assert dict(star["fact_catch"].dtypes)["catch_tonnes"] == "decimal(10,4)"
    assert plan.constraints(star).where("violations > 0").isEmpty()
    doubled = dict(star, dim_season=star["dim_season"].union(star["dim_season"].selectExpr("quota_year", "1.0")))
    broken = plan.constraints(doubled)
    assert rows(broken.where("violations > 0")) == [("one allowance per season", 4)]
    with pytest.raises(ValueError, match="one allowance"):
        quality.enforce(star["fact_catch"], broken)


def test_load(spark, star):
    folder = new_path(spark, "catch")
    for _ in range(2):
        paths = plan.load(star, folder)
    back = {name: tables.read_table(spark, path) for name, path in paths.items()}
    assert {name: df.count() for name, df in back.items()} == {"dim_season": 4, "fact_catch": N_MONTHS, "qa_totals": 4}
    exported = tables.export_queries(plan.export_tables(back["fact_catch"], back["dim_season"]), folder)
    assert spark.read.option("header", True).csv(exported["season_progress"]).count() == N_REPORTED
    broken = dict(star, fact_catch=star["fact_catch"].union(star["fact_catch"]))
    with pytest.raises(ValueError, match="one row per season and month"):
        plan.load(broken, folder)


def test_views(star):
    fact, dim = star["fact_catch"], star["dim_season"]
    season = BY_YEAR[2031]
    progress = plan.season_progress(fact, dim).where(f"quota_year = '{season.name}'").orderBy("month_date").collect()
    assert [r["cumulative_catch_tonnes"] for r in progress] == [season.so_far(m) for m in (3, 6)]
    assert [float(r["cumulative_pct_tac"]) for r in progress] == [pytest.approx(float(share(season.so_far(m), season)), abs=0.051) for m in (3, 6)]
    change = plan.month_over_month(fact).orderBy("month_date").collect()
    in_order = [c for _, c in sorted((s.date(m), c) for s in SEASONS for m, c in s.caught.items() if c is not None)]
    assert len(change) == N_REPORTED and change[0]["change_tonnes"] is None
    assert [float(r["change_tonnes"]) for r in change[1:]] == [
        pytest.approx(float(b - a), abs=0.006) for a, b in zip(in_order, in_order[1:])
    ]
    assert plan.flagged_rows(fact).count() == 1
    assert plan.unreconciled(fact, star["qa_totals"]).count() == len(SEASONS)


def test_all_blank_season_reconciles_differently(spark):
    """Reported as zero at cleaning time, left out of the exceptions in the database."""
    clean = spark.createDataFrame([("s", None)], "quota_year string, catch_tonnes double")
    totals = spark.createDataFrame([("s", 5.0), ("none", 1.0)], "quota_year string, catch_tonnes_published double")
    assert rows(plan.reconciliation(clean, totals)) == [
        ("none", 1.0, None, None, False), ("s", 5.0, 0.0, 5.0, False),
    ]
    assert plan.unreconciled(clean, totals).isEmpty()


MARKUP = [
    "<table>", "<TABLE class=x>", "</table>", "<tr>", "</tr>", "<td>", "<TD a='b > c'>", "</td>", "<th/>", "<td a=1/>", "</th >",
    "<tbody>", "</tbody>", "<thead/>", "<b>", "<br/>", "<a href='?x&amp;y'>", "text", " a &amp; b", "&lt", "*", "​", "½",
    "<!-- c -->", "<!---->", "<!doctype html>", "<script>if (a > b)</script>", "<script>a<b</script>", "</script>", "<style/>",
    "<title>t</title>", "1 < 2", "<td", "<td-x>", "</ td>", "<?php ?>", "<tr/>", "<table/>",
]


def test_plain_markup_reads_as_the_parser_reads_it():
    """Pages of plain markup are split at their tags, with the same cells as the parser finds."""
    rng, plain = random.Random(3), 0
    for _ in range(30000):
        html = "".join(rng.choices(MARKUP[: rng.choice((24, 28, len(MARKUP)))], k=rng.randint(0, 20)))
        found = html_source._plain_tables(html)
        if found is not None:
            plain += 1
            reader = html_source._TableReader()
            reader.feed(html)
            reader.close()
            assert found == [[["".join(cell) for cell in row] for row in table] for table in reader.tables], html
    assert plain > 3000


def test_season_pages_need_no_parser(monkeypatch):
    """The parser takes several times as long; a page of plain tables is read without it."""
    monkeypatch.setattr(html_source, "_TableReader", None)
    html = "<!doctype html><p class='x'>a<table><tr><th>Quota<th>Total</tr><tr><td>1 &amp; 2</td><td><b>3*</b></td></tr></table>"
    assert page_tables(html) == [[["Quota", "Total"], ["1 & 2", "3"]]]
