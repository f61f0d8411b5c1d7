"""Reading and writing tables: rebuild, append, load once, insert if absent, audit."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.operators.keys import absent_rows, keep_first, number_rows


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Drop and create."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


# The columns of the load log.
LOG_SCHEMA = (
    "load_id bigint, pipeline string, source_file string, rows_source bigint, "
    "rows_loaded bigint, started_at timestamp, finished_at timestamp, notes string, "
    "rows_rejected bigint"
)


def existing_rows(df: DataFrame, path: str) -> DataFrame | None:
    """The table at ``path`` read with the schema of ``df``, None if there is none."""
    return _existing(df.sparkSession, df.schema, path)


def existing_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The load log at ``path``, None before the first load."""
    return _existing(spark, LOG_SCHEMA, path)


def _existing(spark: SparkSession, schema: T.StructType | str, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_once(df: DataFrame, path: str) -> bool:
    """Load only into an empty or missing table; True if rows were written."""
    present = existing_rows(df, path)
    if present is not None and not present.isEmpty():
        return False
    append_table(df, path)
    return True


def insert_if_absent(df: DataFrame, path: str, key: Sequence[str], buckets: int | None = None) -> None:
    """Append the rows whose key the table lacks. Running it again adds nothing.

    ``buckets`` keeps the table in so many hash buckets by key, each read where it lies:
    an insert then shuffles the new rows alone, never the table. Use the same key and
    number for every insert. Readers may see a part of an append while it is written, and
    two writers at once on the same table are not guarded against.
    """
    if buckets:
        absent_from_buckets(df, path, key, buckets).write.insertInto(bucketed_table(df, path, key, buckets))
        return
    present = existing_rows(df, path)
    append_table(keep_first(df, key) if present is None else absent_rows(df, present, key), path)


def extend_dimension(new: DataFrame, path: str, key: Sequence[str], id_column: str) -> DataFrame:
    """Add the keys a dimension table lacks, with ids that go on where its ids end; read it back.

    ``new`` has one row per key. Members already on record keep their id and their row.
    """
    id_first = new.select(F.lit(0).cast("bigint").alias(id_column), "*")
    known = existing_rows(id_first, path)
    if known is None:
        added = number_rows(new, key, id_column)
    else:
        added = number_rows(absent_rows(new, known, key), key, id_column)
        highest = F.coalesce(known.agg(F.max(id_column)).scalar(), F.lit(0))
        added = added.withColumn(id_column, F.col(id_column) + highest)
    append_table(added, path)
    return read_table(new.sparkSession, path)


def bucketed_table(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> str:
    """The name of the table of ``path`` in the session's catalogue, entered on first use.

    Its columns are those of ``df``; files that already lie there belong to it.
    """
    spark = df.sparkSession
    name = f"obslake_{hashlib.sha256(f'{path} {buckets} {[*key]}'.encode()).hexdigest()[:24]}"
    if not spark.catalog.tableExists(name):
        quoted = lambda c: "`" + c.replace("`", "``") + "`"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        by = ", ".join(map(quoted, key))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return name


def absent_from_buckets(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows of ``df``, one per key, whose key the bucketed table lacks, dealt like its buckets."""
    present = df.sparkSession.table(bucketed_table(df, path, key, buckets)).select(*key)
    new = keep_first(df, key).repartition(buckets, *key)
    return new.join(present.hint("merge"), list(key), "left_anti").select(*df.columns)


def write_csv(df: DataFrame, path: str, sort: Sequence[str] = (), line_breaks: bool = False) -> None:
    """CSV with a header; ``sort`` orders rows across the part files.

    ``line_breaks`` doubles quotes inside values, for ``read_csv`` with the same setting.
    """
    writer = (df.orderBy(*sort) if sort else df).write.mode("overwrite").option("header", True)
    (writer.option("escape", '"') if line_breaks else writer).csv(path)


def export_queries(queries: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Each named query as a CSV folder of its own; returns name -> path."""
    paths = {name: f"{folder}/{name}" for name in queries}
    for name, df in queries.items():
        write_csv(df, paths[name])
    return paths


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append to a relational table in batches of 2,000 rows."""
    df.write.option("batchsize", 2000).jdbc(url, table, mode="append", properties=dict(properties))


def load_audit(
    source: DataFrame,
    loaded: DataFrame,
    log: DataFrame | None,
    *,
    pipeline: str,
    source_file: str,
    started_at: datetime,
    finished_at: datetime,
    notes: str,
) -> DataFrame:
    """One audit row: rows in, loaded and rejected (filtered out or duplicate).

    Counts are taken from the stored tables, where they come from file footers; task
    counters would count a re-run task twice after an executor is lost.
    """
    spark = source.sparkSession
    newest = F.lit(0) if log is None else F.coalesce(log.agg(F.max("load_id")).scalar(), F.lit(0))
    n_source = source.agg(F.count(F.lit(1))).scalar()
    n_loaded = loaded.agg(F.count(F.lit(1))).scalar()
    moments = {"started_at": started_at, "finished_at": finished_at}
    row = spark.range(1).select(
        (newest + 1).cast("bigint").alias("load_id"),
        F.lit(pipeline).alias("pipeline"),
        F.lit(source_file).alias("source_file"),
        n_source.alias("rows_source"),
        n_loaded.alias("rows_loaded"),
        *[
            F.lit(m.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias(name)
            for name, m in moments.items()
        ],
        F.lit(notes).alias("notes"),
    )
    rejected = F.col("rows_source") - F.col("rows_loaded")
    return row.withColumn("rows_rejected", rejected)
