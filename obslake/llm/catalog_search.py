"""The queries over embeddings: search and whitening."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.catalog.registry import Tables
from obslake.llm import nearest, polytope, whitening
from obslake.llm.registry import query


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings
               WHERE embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
    FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5
    """
)
def op9_top_k(t: Tables):
    return nearest.top_k(t.embeddings, F.col("vec_id") % 50 == 0)


@query()
def op12_nearest(t: Tables):
    return polytope.nearest(t.embeddings, F.col("vec_id") % 50 == 0)


@query()
def op13_whitening(t: Tables):
    rows = whitening.whiten(t.embeddings)
    each = F.posexplode("whitened").alias("_at", "_value")
    return rows.select("vec_id", "n", "deviation", "explained", "identity_error", each).select(
        "vec_id", (F.col("_at") + 1).alias("component"), "n", "deviation", F.col("_value").alias("whitened"),
        F.col("explained")[F.col("_at")].alias("explained"), "identity_error",
    )
