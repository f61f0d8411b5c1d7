"""Dimensions, key resolution, idempotent loads, audit, CSV and table round trips."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.catalog.registry import Tables, query, r
from obslake.operators import keys
from obslake.operators.cleaning import plausible, select_renamed, typed, with_constants
from obslake.session import new_path, stored
from obslake.sources import delimited, tables
from obslake.sources.grids import flatten_grid

SEASON_CUT = "1998-01-01"


def event_dimension(t: Tables) -> DataFrame:
    spans = keys.derive_dimension(
        t.events, ["user_id", "event_type"], "ts", "first_ts", "last_ts"
    )
    return stored(keys.number_rows(spans, ["user_id", "event_type"], "pair_id"), "pairs")


DIM_SQL = """
dim AS (
  SELECT ROW_NUMBER() OVER (ORDER BY user_id, event_type) AS pair_id, *
  FROM (SELECT user_id, event_type, MIN(ts) AS first_ts, MAX(ts) AS last_ts
        FROM events GROUP BY user_id, event_type)
)"""


@query(f"WITH {DIM_SQL} SELECT * FROM dim")
def q_dim_derive(t: Tables) -> DataFrame:
    """One row per user and event type with first and last moment and a dense id."""
    return event_dimension(t)


@query(
    f"""WITH {DIM_SQL}
SELECT e.event_id, d.pair_id, e.ts, e.value
FROM events e LEFT JOIN dim d ON d.user_id = e.user_id AND d.event_type = e.event_type"""
)
def q_key_resolve(t: Tables) -> DataFrame:
    """Events with the surrogate of their user and type."""
    resolved = keys.resolve_key(t.events, event_dimension(t), ["user_id", "event_type"], "pair_id")
    return keys.require_resolved(resolved, "pair_id").select("event_id", "pair_id", "ts", "value")


@query(
    """SELECT COUNT(*) FILTER (WHERE p.p_partkey IS NULL) AS unmatched_rows
FROM lineitem l LEFT JOIN (SELECT p_partkey FROM part WHERE p_size BETWEEN 1 AND 40) p
  ON p.p_partkey = l.l_partkey"""
)
def q_unresolved(t: Tables) -> DataFrame:
    """Lines whose part is missing from the dimension of plausible parts."""
    dim = t.part.where(plausible({"p_size": (1, 40)})).select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("size_id")
    )
    return keys.unresolved(keys.resolve_key(t.lineitem, dim, ["l_partkey"], "size_id"), "size_id")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def dedupe_sql(where: str = "TRUE") -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {", ".join(LINE_COLUMNS)}) AS rn
  FROM lineitem WHERE {where}) WHERE rn = 1)"""


@query(f"SELECT * FROM {dedupe_sql()}")
def q_dedupe(t: Tables) -> DataFrame:
    """One line per order and line number, the smallest by the remaining columns."""
    return keys.keep_first(t.lineitem, LINE_KEY)


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def q_distinct_pairs(t: Tables) -> DataFrame:
    """Distinct combinations as a small dimension."""
    return keys.distinct_pairs(t.lineitem, ["l_returnflag", "l_linestatus"])


EARLY = f"l_shipdate < TIMESTAMP '{SEASON_CUT}'"


@query(
    f"""WITH early AS (SELECT * FROM {dedupe_sql(EARLY)}), late AS (SELECT * FROM {dedupe_sql()})
SELECT * FROM early
UNION ALL
SELECT * FROM late WHERE NOT EXISTS (
  SELECT 1 FROM early e WHERE e.l_orderkey = late.l_orderkey AND e.l_linenumber = late.l_linenumber)"""
)
def q_insert_if_absent(t: Tables) -> DataFrame:
    """A table in buckets loaded with early lines, then with all lines, twice."""
    path, buckets = new_path(t.spark, "lines"), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    tables.insert_if_absent(t.lineitem.where(F.col("l_shipdate") < SEASON_CUT), path, LINE_KEY, buckets)
    for _ in range(2):
        tables.insert_if_absent(t.lineitem, path, LINE_KEY, buckets)
    return tables.read_table(t.spark, path)


@query(f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SEASON_CUT}'")
def q_skip_if_loaded(t: Tables) -> DataFrame:
    """A second load into a table that already has rows leaves it as it is."""
    path = new_path(t.spark, "orders")
    tables.load_once(t.orders.where(F.col("o_orderdate") < SEASON_CUT), path)
    tables.load_once(t.orders, path)
    return tables.read_table(t.spark, path)


STARTED, FINISHED = datetime(2024, 2, 1, 3, 0, 0), datetime(2024, 2, 1, 3, 5, 0)


def audited_load(t: Tables) -> DataFrame:
    """Two loads on record: line items, then orders, each cleaned and deduplicated."""
    log = new_path(t.spark, "audit")
    for name, frame, key, bounds in (
        ("lineitem", t.lineitem, LINE_KEY, {"l_quantity": (2.0, 50.0)}),
        ("orders", t.orders, ["o_orderkey"], {"o_totalprice": (5000.0, 450000.0)}),
    ):
        staged, clean = new_path(t.spark, "staged"), new_path(t.spark, "clean")
        tables.replace_table(frame, staged)
        source = tables.read_table(t.spark, staged)
        tables.replace_table(keys.keep_first(source.where(plausible(bounds)), key), clean)
        audit = tables.load_audit(
            source,
            tables.read_table(t.spark, clean),
            tables.existing_log(t.spark, log),
            pipeline="sql",
            source_file=name,
            started_at=STARTED,
            finished_at=FINISHED.replace(hour=4) if name == "orders" else FINISHED,
            notes="full run",
        )
        tables.append_table(audit, log)
    return tables.read_table(t.spark, log)


def counted_loads(t: Tables) -> DataFrame:
    """The trail of the same two loads, from counts of keys alone: nothing is staged or written twice."""
    log = new_path(t.spark, "audit")
    for name, frame, key, bounds, hour in (
        ("lineitem", t.lineitem, LINE_KEY, {"l_quantity": (2.0, 50.0)}, 3),
        ("orders", t.orders, ["o_orderkey"], {"o_totalprice": (5000.0, 450000.0)}, 4),
    ):
        loaded = frame.where(plausible(bounds)).select(*key).distinct()
        audit = tables.load_audit(
            frame, loaded, tables.existing_log(t.spark, log), pipeline="sql", source_file=name,
            started_at=STARTED, finished_at=FINISHED.replace(hour=hour), notes="counted",
        )
        tables.append_table(audit, log)
    return tables.read_table(t.spark, log)


@query(
    f"""WITH early AS (SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order
                   FROM orders WHERE o_orderdate < TIMESTAMP '{SEASON_CUT}' GROUP BY o_custkey),
late AS (SELECT o_custkey, MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order FROM orders
         WHERE o_custkey NOT IN (SELECT o_custkey FROM early) GROUP BY o_custkey)
SELECT ROW_NUMBER() OVER (ORDER BY o_custkey) AS buyer_id, * FROM early
UNION ALL
SELECT (SELECT COUNT(*) FROM early) + ROW_NUMBER() OVER (ORDER BY o_custkey), * FROM late"""
)
def q_incremental_ids(t: Tables) -> DataFrame:
    """Customers with an order as a dimension loaded twice: ids of the first load stay, new ones go on."""
    path = new_path(t.spark, "buyers")
    for orders in (t.orders.where(F.col("o_orderdate") < SEASON_CUT), t.orders):
        found = keys.derive_dimension(orders, ["o_custkey"], "o_orderdate", "first_order", "last_order")
        tables.extend_dimension(found, path, ["o_custkey"], "buyer_id")
    return tables.read_table(t.spark, path)


AUDIT_SQL = f"""
loads AS (
  SELECT CAST(1 AS BIGINT) AS load_id, 'lineitem' AS source_file, TIMESTAMP '2024-02-01 03:05:00' AS finished_at,
         (SELECT COUNT(*) FROM lineitem) AS rows_source,
         (SELECT COUNT(*) FROM {dedupe_sql("l_quantity BETWEEN 2 AND 50")}) AS rows_loaded
  UNION ALL
  SELECT 2, 'orders', TIMESTAMP '2024-02-01 04:05:00', (SELECT COUNT(*) FROM orders),
         (SELECT COUNT(DISTINCT o_orderkey) FROM orders WHERE o_totalprice BETWEEN 5000 AND 450000)
)"""


@query(
    f"""WITH {AUDIT_SQL}
SELECT load_id, 'sql' AS pipeline, source_file, rows_source, rows_loaded,
       rows_source - rows_loaded AS rows_rejected, CAST(finished_at AS VARCHAR) AS finished_at,
       'full run' AS notes FROM loads"""
)
def q_load_audit(t: Tables) -> DataFrame:
    """The audit trail of two loads."""
    trail = audited_load(t).withColumn("finished_at", F.col("finished_at").cast("string"))
    return trail.drop("started_at")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS shipped, l_shipdate AS shipped_at,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS flag, 'lineitem' AS source_table
FROM lineitem"""
)
def q_typed_staging(t: Tables) -> DataFrame:
    """Lines staged as verbatim text, then renamed, typed and tagged with their source."""
    blanked = t.lineitem.withColumn("l_returnflag", F.replace("l_returnflag", F.lit("N"), F.lit("")))
    names = ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]
    text = blanked.select(*[F.col(c).cast("string").alias(f"{c}_raw") for c in names])
    path = new_path(t.spark, "staged")
    tables.replace_table(text, path)
    rows = typed(
        tables.read_table(t.spark, path),
        {
            "order": ("l_orderkey_raw", "bigint"),
            "line": ("l_linenumber_raw", "int"),
            "l_quantity": ("l_quantity_raw", "double"),
            "shipped": ("l_shipdate_raw", "date"),
            "shipped_at": ("l_shipdate_raw", "timestamp_ntz"),
            "flag": ("l_returnflag_raw", "string"),
        },
    )
    kept = {"order": "l_orderkey", "line": "l_linenumber"}
    renamed = select_renamed(rows, kept | {c: c for c in rows.columns if c not in kept})
    return with_constants(renamed, {"source_table": "lineitem"})


def exported_lines(df: DataFrame, path: str, key: str, preamble: list[str]) -> None:
    """CSV text files, each with a preamble and a header on top of its share of the rows."""
    spark = df.sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = "\n".join([*preamble, ",".join(df.columns)])
    heads = spark.range(files).select(
        F.col("id").cast("int").alias("file"), F.lit(0).alias("at"), F.lit(top).alias("value")
    )
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    quoted = lambda x: F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))
    fields = [F.when(text(c).rlike('["\n,]'), quoted(text(c))).otherwise(text(c)) for c in df.columns]
    body = df.select(
        F.pmod(F.xxhash64(key), F.lit(files)).cast("int").alias("file"),
        F.lit(1).alias("at"),
        F.concat_ws(",", *fields).alias("value"),
    )
    placed = heads.unionByName(body).repartition("file").sortWithinPartitions("file", "at")
    placed.select("file", "value").write.partitionBy("file").text(path)


CUSTOMER_FIELDS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
GLOSSARY = ["Customer export, version 2", "c_acctbal,account balance in dollars", "", "c_custkey,key"]


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || chr(10) || chr(10) || 'of "' || c_mktsegment || '", again' || chr(10)
       ELSE c_name END AS c_name, c_nationkey, c_acctbal, NULLIF(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer"""
)
def q_preamble_csv(t: Tables) -> DataFrame:
    """Customers, a third with line breaks and quotes in their name, written below a glossary.

    They are found again by the header's content.
    """
    path = new_path(t.spark, "glossary")
    blank = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment"))
    long_name = F.concat("c_name", F.lit('\n\nof "'), "c_mktsegment", F.lit('", again\n'))
    name = F.when(F.col("c_custkey") % 3 == 0, long_name).otherwise(F.col("c_name"))
    written = t.customer.select("c_custkey", name.alias("c_name"), "c_nationkey", "c_acctbal", blank.alias("c_mktsegment"))
    exported_lines(written, path, "c_custkey", GLOSSARY)
    rows = delimited.read_below_preamble(t.spark, path, CUSTOMER_FIELDS, line_breaks=True)
    types = dict(t.customer.dtypes)
    return typed(rows, {c: (c, types[c]) for c in CUSTOMER_FIELDS})


@query("SELECT c_custkey, c_nationkey FROM customer")
def q_header_contract(t: Tables) -> DataFrame:
    """Commented preamble: the header is checked, required columns exist, aliases resolve."""
    path = new_path(t.spark, "commented")
    exported_lines(t.customer, path, "c_custkey", [f"# {line}" for line in GLOSSARY])
    rows = delimited.read_below_preamble(t.spark, path, CUSTOMER_FIELDS, comment="#")
    kept = delimited.require_columns(rows, ["c_custkey", "c_nationkey"])
    found = delimited.rename_first(
        delimited.lower_columns(kept),
        {"c_custkey": ["custkey", "c_custkey"], "c_nationkey": ["c_nationkey", "nation"]},
        {},
    )
    return found.select(F.col("c_custkey").cast("bigint"), F.col("c_nationkey").cast("int"))


@query(
    f"""SELECT s_suppkey, s_name, s_nationkey, {r("s_acctbal", 2)} AS s_acctbal, NULL::DOUBLE AS depth_m
FROM supplier"""
)
def q_csv_roundtrip(t: Tables) -> DataFrame:
    """Suppliers exported as sorted CSV and read back, typed and as text."""
    folder = new_path(t.spark, "export")
    paths = tables.export_queries({"supplier": t.supplier.orderBy("s_suppkey")}, folder)
    tables.write_csv(t.supplier, f"{folder}/sorted", ["s_nationkey", "s_suppkey"])
    typed_rows = delimited.read_csv(t.spark, paths["supplier"], t.supplier.schema)
    text = delimited.read_text_csv(t.spark, f"{folder}/sorted", t.supplier.columns)
    back = text.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name")
    both = typed_rows.drop("s_name").join(back, "s_suppkey")
    optional = {"depth_m": ["DEPTH", "depth"]}
    found = delimited.rename_first(both, {c: [c] for c in t.supplier.columns}, optional)
    return found.withColumn("s_acctbal", F.round("s_acctbal", 2))


@query("SELECT doc_id, text FROM documents WHERE text <> ''")
def q_line_breaks_csv(t: Tables) -> DataFrame:
    """Whole documents, line breaks and quotes included, through CSV and back."""
    path = new_path(t.spark, "texts")
    rows = t.documents.select("doc_id", "text").where("text <> ''")
    tables.write_csv(rows, path, line_breaks=True)
    return delimited.read_csv(t.spark, path, rows.schema, line_breaks=True)


@query(
    """SELECT c_custkey, c_nationkey, CASE c_custkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS origin
FROM customer"""
)
def q_three_sources(t: Tables) -> DataFrame:
    """Customers dealt to three sources that are read under one contract."""
    folder = new_path(t.spark, "sources")
    names = ["a", "b", "c"]
    for i, name in enumerate(names):
        exported_lines(t.customer.where(F.col("c_custkey") % 3 == i), f"{folder}/{name}", "c_custkey", GLOSSARY)
    read = delimited.read_sources(
        t.spark, {n: f"{folder}/{n}" for n in names}, {n: CUSTOMER_FIELDS for n in names}
    )
    typed_rows = [
        typed(read[n], {"c_custkey": ("c_custkey", "bigint"), "c_nationkey": ("c_nationkey", "int")}).withColumn(
            "origin", F.lit(n)
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, typed_rows)


@query(
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS season FROM orders
UNION ALL
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) FROM orders WHERE o_orderstatus = 'P'"""
)
def q_append(t: Tables) -> DataFrame:
    """A season-partitioned table rebuilt with all orders, then appended to."""
    path = new_path(t.spark, "seasons")
    rows = t.orders.select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season"), "o_orderstatus"
    )
    tables.replace_table(rows.where("o_orderstatus = 'F'"), path, ["season"])
    tables.replace_table(rows, path, ["season"])
    tables.append_table(rows.where("o_orderstatus = 'P'"), path, ["season"])
    return tables.read_table(t.spark, path).select("o_orderkey", "o_totalprice", "season")


@query("SELECT vec_id, label, CAST(UNNEST(generate_series(1, len(embedding))) AS INT) AS at, UNNEST(embedding) AS value FROM embeddings")
def q_grid_flatten(t: Tables) -> DataFrame:
    """Vectors with their positions as labels, flattened to long rows."""
    labelled = t.embeddings.withColumn("axis", F.sequence(F.lit(1), F.size("embedding")))
    return flatten_grid(labelled, {"at": "axis"}, "embedding", "value", ["vec_id", "label"])
