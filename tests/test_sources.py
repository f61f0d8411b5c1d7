"""Contracts of delimited input, grids, tables and the streaming append."""

from __future__ import annotations

import csv
import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from obslake.operators import keys, quality
from obslake.operators.cleaning import select_renamed, shallow, typed, with_constants
from obslake.session import new_path, spread
from obslake.sources import delimited, tables
from obslake.sources.grids import flatten_grid
from obslake.streaming.append import append_new_rows
from tests.conftest import rows, same

HEADER = ["FID", "name", "value"]
GLOSSARY = ["Some export", "value, the measured value", "", "FID,name", '"FID" is a row id']
DATA = ["1,ann,1.5", '2,"b, c",', "3,,2.5", "FID,name,value"]


def text_file(folder, name, lines):
    path = folder / name
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_preamble_is_skipped_by_content(spark, tmp_path):
    text_file(tmp_path, "a.csv", [*GLOSSARY, ",".join(HEADER), *DATA])
    text_file(tmp_path, "b.csv", [*GLOSSARY, *GLOSSARY, ",".join(HEADER), "9,z,0"])
    got = rows(delimited.read_below_preamble(spark, str(tmp_path), HEADER))
    # A data line that looks like the header is still data.
    assert got == [
        ("1", "ann", "1.5"), ("2", "b, c", None), ("3", None, "2.5"), ("9", "z", "0"), ("FID", "name", "value"),
    ]


def test_preamble_of_a_file_in_many_splits(spark, tmp_path):
    lines = [f"{i},n{i},{i}.5" for i in range(20000)]
    path = text_file(tmp_path, "a.csv", [*GLOSSARY, ",".join(HEADER), *lines])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = delimited.read_below_preamble(spark, path, HEADER)
        assert df.rdd.getNumPartitions() > 5
        assert df.agg(F.count("FID"), F.sum(F.col("FID").cast("long"))).first() == (20000, 199990000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("split", [300, 5000, 1 << 27])
def test_quoted_line_breaks_below_a_preamble(spark, tmp_path, split):
    """Records over many lines and over many splits; quotes in the preamble do not count."""
    rng = random.Random(split)
    values = ["x", 'say "no"', "a, b", "one\ntwo", '\n\n"\n', "l\n" * 400, "", " padded "]
    wanted = [(str(i), rng.choice(values), str(i / 2)) for i in range(400)]
    for name, part in (("a", wanted[:250]), ("b", wanted[250:]), ("c", [("900", "no breaks", "1")])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            file.write('An "export\n' + "\n".join([*GLOSSARY, ",".join(HEADER)]) + "\n")
            csv.writer(file, lineterminator="\n").writerows(part)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = rows(delimited.read_below_preamble(spark, str(tmp_path), HEADER, line_breaks=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(got) == sorted([(a, b or None, c) for a, b, c in wanted] + [("900", "no breaks", "1")])


def test_lines_below_a_preamble_stay_in_the_jvm(spark, tmp_path):
    path = text_file(tmp_path, "a.csv", [*GLOSSARY, ",".join(HEADER), *DATA])
    for breaks in (False, True):
        plan = delimited.read_below_preamble(spark, path, HEADER, line_breaks=breaks)._jdf.queryExecution().toString()
        assert "Arrow" not in plan and "Python" not in plan


def test_file_without_header_is_refused(spark, tmp_path):
    text_file(tmp_path, "a.csv", [*GLOSSARY, ",".join(HEADER), "1,a,2"])
    text_file(tmp_path, "b.csv", ["FID,value,name", "1,2,a"])
    with pytest.raises(PySparkException, match="no header line"):
        delimited.read_below_preamble(spark, str(tmp_path), HEADER).count()


def test_row_of_wrong_width_is_refused(spark, tmp_path):
    path = text_file(tmp_path, "a.csv", [",".join(HEADER), "1,a,2,surplus"])
    with pytest.raises(Exception, match="Malformed"):
        delimited.read_below_preamble(spark, path, HEADER).collect()


def test_commented_preamble_and_header_contract(spark, tmp_path):
    good = text_file(tmp_path, "a.csv", ["# one", "# two", ",".join(HEADER), "1,a,2"])
    assert rows(delimited.read_below_preamble(spark, good, HEADER, "#")) == [("1", "a", "2")]
    bad = text_file(tmp_path, "b.csv", ["# one", "name,FID,value", "a,1,2"])
    with pytest.raises(ValueError, match="does not match"):
        delimited.check_header(spark, str(tmp_path), HEADER, "#")
    delimited.check_header(spark, good, HEADER, "#")
    for action in (lambda df: df.count(), lambda df: df.select("FID").collect(), lambda df: df.collect()):
        with pytest.raises(Exception, match="CSV header"):
            action(delimited.read_below_preamble(spark, bad, HEADER, "#"))
    found = {r["header"] for r in delimited.header_lines(spark, str(tmp_path), "#").collect()}
    assert found == {"FID,name,value", "name,FID,value"}


def test_text_and_typed_csv(spark, tmp_path):
    path = text_file(tmp_path, "a.csv", ["k,d,v", "x,2024-01-02,", ",,1.5"])
    assert rows(delimited.read_text_csv(spark, path, ["k", "d", "v"])) == [("", "", "1.5"), ("x", "2024-01-02", "")]
    schema = "k string, d date, v double"
    parsed = spark.createDataFrame([], schema).schema
    assert rows(delimited.read_csv(spark, path, parsed)) == [
        ("x", dt.date(2024, 1, 2), None), (None, None, 1.5),
    ]


def test_column_contracts(spark):
    df = spark.createDataFrame([(1, 2.0)], "TIME int, temperature double")
    with pytest.raises(ValueError, match="DEPTH"):
        delimited.require_columns(df, ["TIME", "DEPTH"])
    named = delimited.rename_first(df, {"t": ["time", "TIME"]}, {"d": ["DEPTH"], "v": ["temperature"]})
    assert rows(named) == [(1, None, 2.0)]
    assert delimited.lower_columns(df).columns == ["time", "temperature"]
    assert with_constants(select_renamed(df, {"TIME": "t"}), {"src": "x"}).columns == ["t", "src"]


def test_sources_are_read_alike(spark, tmp_path):
    paths = {n: text_file(tmp_path, f"{n}.csv", [*GLOSSARY, ",".join(HEADER), f"1,{n},2"]) for n in ("p", "q")}
    read = delimited.read_sources(spark, paths, {"p": HEADER, "q": HEADER})
    assert {n: rows(df) for n, df in read.items()} == {"p": [("1", "p", "2")], "q": [("1", "q", "2")]}
    assert read["p"].columns == ["fid", "name", "value"]


def test_strict_casts(spark):
    df = spark.createDataFrame([("", "2024-01-02T03:04:05Z"), ("7", "")], "n string, t string")
    got = typed(df, {"n": ("n", "smallint"), "t": ("t", "timestamp")})
    assert rows(got) == [(7, None), (None, dt.datetime(2024, 1, 2, 3, 4, 5))]
    with pytest.raises(PySparkException):
        typed(df.selectExpr("'x' as n"), {"n": ("n", "int")}).collect()


def test_grid(spark):
    df = spark.createDataFrame(
        [("g", [1, 2], [10.0, 20.0], [[1.0, None], [float("nan"), 4.0]])],
        "g string, time array<int>, depth array<double>, temp array<array<double>>",
    )
    flat = flatten_grid(df, {"t": "time", "d": "depth"}, "temp", "temp_c", ["g"])
    assert rows(flat) == [("g", 1, 10.0, 1.0), ("g", 2, 20.0, 4.0)]


def test_surface_counts_unknown_depths(spark):
    df = spark.createDataFrame([(None,), (10.0,), (10.1,)], "d double")
    assert df.where(shallow("d", 10)).count() == 2
    assert df.where("d is null").where(shallow("d", 10)).count() == 1


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "n")], "k string, v int, w string")
    assert rows(keys.keep_first(df, ["k"])) == [("a", 1, "y"), ("b", None, "n")]
    assert rows(keys.keep_first(df, ["k"], [-F.col("v")])) == [("a", 2, "x"), ("b", None, "n")]
    assert rows(keys.keep_first(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_keep_first_with_one_key_holding_a_third(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") * 17 % 1000).alias("v")
    )
    got = keys.keep_first(df, ["k"])
    assert got.count() == 20001 and got.where("k = -1").first()["v"] == 0


def test_keep_first_against_a_window(spark):
    """Null keys, null and equal first columns, strings that differ late, NaN."""
    rng = random.Random(8)
    value = lambda: rng.choice([None, 1.0, 2.0, float("nan"), -0.0])
    text = lambda: rng.choice([None, "", "abcdefgh", "abcdefgi", "b"])
    data = [(rng.choice([None, *range(40)]), rng.choice(["x", None]), text(), value(), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, g string, w string, v double, i int")
    for prefer, ranking in (([], ["w", "v", "i"]), ([-F.col("i")], [F.col("i").desc()])):
        window = Window.partitionBy("k", "g").orderBy(*ranking)
        wanted = df.withColumn("n", F.row_number().over(window)).where("n = 1").drop("n")
        assert same(keys.keep_first(df, ["k", "g"], prefer).fillna(-7.0), wanted.fillna(-7.0))


def test_keep_first_sorts_only_rows_that_tie(spark):
    df = spark.range(5000).select((F.col("id") % 4900).alias("k"), F.col("id").alias("v"), F.lit("w").alias("w"))
    plan = keys.keep_first(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "Sort [k" not in plan.split("Union")[1].split("BroadcastHashJoin")[0]
    alone = plan.split("Union")[1].split("SortAggregate")[0]
    assert "Exchange hash" not in alone and "BroadcastHashJoin" in alone


def test_keep_first_sends_rows_once_when_many_keys_are_shared(spark):
    df = spark.createDataFrame(
        [(None, "b", 1.0), (None, "b", None), (1, None, 2.0), (1, "a", 9.0), (1, "a", float("nan")), (2, "c", 3.0), (2, "c", 3.0),
         (3, "z", float("nan")), (4, "y", 1.0), (4, "y", 0.5), (4, "x", 7.0)] + [(5, "h", float(i % 9)) for i in range(500)],
        "k long, v string, w double",
    )
    for prefer in ([], [-F.length("v"), F.upper("v")]):
        assert str(rows(keys.keep_first(df, ["k"], prefer, few=0))) == str(rows(keys.keep_first(df, ["k"], prefer)))
    plan = keys.keep_first(df, ["k"], few=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "Join" not in plan
    below = plan[plan.index("Exchange hash") :]
    assert "WindowGroupLimit [k" in below  # copies of a key collapse before they are sent


def test_buckets_are_read_where_they_lie(spark):
    path, key = new_path(spark, "bucketed"), ["k", "g"]
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (2, "b", "a"), (None, "b", "n")], "k long, g string, v string")
    second = spark.createDataFrame([(2, "b", "z"), (3, "d", "w"), (3, "d", "e")], first.schema)
    for df in (first, second, second):
        tables.insert_if_absent(df, path, key, buckets=3)
    assert rows(tables.read_table(spark, path)) == [(1, "a", "x"), (2, "b", "a"), (3, "d", "e"), (None, "b", "n")]
    plan = tables.absent_from_buckets(second, path, key, 3)._jdf.queryExecution().executedPlan().toString()
    nodes = [line.lstrip(" :+-") for line in plan.splitlines()]
    scans = [i for i, node in enumerate(nodes) if "SelectedBucketsCount: 3 out of 3" in node]
    assert scans
    for at in scans:  # from the scan up to the join there is no exchange
        while not nodes[at - 1].startswith(("SortMergeJoin", "Exchange")):
            at -= 1
            assert not nodes[at].startswith("Exchange")
            if nodes[at].startswith("Sort "):
                break


def test_number_rows_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("c"))
    numbered = keys.number_rows(df, ["k"], "n")
    assert numbered.where("n <> k + 1").isEmpty() and numbered.count() == 1000


def test_insert_if_absent(spark):
    path = new_path(spark, "t")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    for _ in range(2):
        tables.insert_if_absent(first, path, ["k"])
    tables.insert_if_absent(spark.createDataFrame([(2, "z"), (3, "d"), (3, "e")], "k int, v string"), path, ["k"])
    assert rows(tables.read_table(spark, path)) == [(1, "a"), (2, "b"), (3, "d")]


def test_load_once_and_rebuild(spark):
    path = new_path(spark, "t")
    assert tables.load_once(spark.range(0), path)
    assert tables.load_once(spark.range(3), path)
    assert not tables.load_once(spark.range(5), path)
    assert tables.read_table(spark, path).count() == 3
    tables.replace_table(spark.range(5), path)
    tables.append_table(spark.range(1), path)
    assert tables.read_table(spark, path).count() == 6


def test_exports_are_sorted_text(spark):
    folder = new_path(spark, "export")
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    paths = tables.export_queries({"one": df, "two": df.orderBy("k")}, folder)
    assert spark.read.option("header", True).csv(paths["one"]).count() == 2
    tables.write_csv(df, f"{folder}/sorted", ["k"])
    lines = spark.read.text(f"{folder}/sorted").where("value <> 'k,v'").collect()
    assert [r[0] for r in lines] == ["a,1", "b,2"]


def test_audit_numbers_follow_on(spark):
    def audit(log):
        now = dt.datetime(2024, 1, 1)
        return tables.load_audit(
            spark.range(10), spark.range(7), log, pipeline="sql", source_file="f", started_at=now,
            finished_at=now, notes="n",
        )

    first = audit(None)
    second = audit(first)
    assert first.select("load_id", "rows_source", "rows_loaded", "rows_rejected").first() == (1, 10, 7, 3)
    assert second.first()["load_id"] == 2
    assert quality.last_rejection(second).first()[0] == 30.0


def test_streamed_files_are_inserted_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), new_path(spark, "t")
    schema = "k int, v string"

    def run(batch):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append_new_rows(stream, target, ["k"], str(tmp_path / "checkpoint")).awaitTermination()
        return rows(tables.read_table(spark, target))

    assert run([(1, "a"), (1, "b")]) == [(1, "a")]
    assert run([(1, "z"), (2, "c")]) == [(1, "a"), (2, "c")]


def test_constraint_rules_follow_sql(spark):
    df = spark.createDataFrame([(1, None), (1, -1), (2, 5), (None, 3)], "k int, v int")
    dim = spark.createDataFrame([(1,)], "k int")
    report = quality.constraint_report(
        df, {"not negative": F.col("v") >= 0, "present": F.col("k").isNotNull()},
        unique={"unique": ["k"]}, references={"known": (dim, ["k"])},
    )
    # A NULL passes a CHECK and a foreign key.
    assert dict(rows(report)) == {"not negative": 1, "present": 1, "unique": 1, "known": 1}
    with pytest.raises(ValueError, match="not negative: 1"):
        quality.enforce(df, report)
    assert quality.enforce(df, report.where("violations = 0")) is df


def test_orphans_of_a_hot_key(spark):
    fact = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).alias("k"))
    dim = spark.createDataFrame([(0,), (2,), (3,)], "k long")
    expected = fact.where("k in (1, 4)").groupBy("k").count()
    assert same(quality.orphan_keys(fact, dim, ["k"]).withColumnRenamed("n_rows", "count"), expected)


def test_spread_gives_every_core_work(spark):
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 4
    wide = spark.range(0, 10, 1, 16)
    assert spread(wide) is wide
