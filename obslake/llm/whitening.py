"""Whitening of embeddings through MLlib's distributed block matrices.

Components become integers, so that copies are recognised exactly. Each distinct vector,
centred, is a row of a ``BlockMatrix``; its transpose times itself is the scatter, whose
eigenvectors (one small matrix, as wide as a vector) give the whitening matrix; the block
matrix times that projects all rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.nearest import quantised, usable
from obslake.operators.keys import number_rows
from obslake.session import stored

BLOCK_ROWS, BLOCK_COLUMNS = 1024, 1024
BLOCKS_SUMMED = 16  # row blocks whose products one task adds up
LONGS = 2**63


def _filled(vector: Column, width: int) -> Column:
    return F.concat(vector, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector)))


def _block_matrix(rows: DataFrame, width: int, block_rows: int, block_columns: int) -> BlockMatrix:
    """The ``centred`` arrays as rows of a block matrix, numbered by ``index`` from 0."""
    vectors = rows.select("index", array_to_vector("centred").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), 0, width)
    return indexed.toBlockMatrix(block_rows, block_columns)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself; many tasks share the sum over the row blocks.

    Without the splits all row blocks would meet in the one task of the result block.
    """
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_SUMMED))
    left = matrix.transpose()
    product = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, by: np.ndarray, context: SparkContext) -> DataFrame:
    """index, projected: the rows times ``by``, which is as high as a vector is wide."""
    high = matrix.colsPerBlock
    blocks = [
        ((at // high, 0), Matrices.dense(*part.shape, part.ravel(order="F")))
        for at in range(0, len(by), high)
        for part in [by[at : at + high]]
    ]
    right = BlockMatrix(context.parallelize(blocks, 1), high, by.shape[1], *by.shape)
    rows = matrix.multiply(right).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("projected"))


def _squared_distance(x: Column, sums: list[int], n: int) -> Column:
    """Exact sum of (n * x - sum)^2; null beyond 64 bits."""
    fits = lambda v: F.lit(v if abs(v) < LONGS else None).cast("bigint")
    away = F.zip_with(x, F.array(*map(fits, sums)), lambda a, s: F.try_subtract(F.try_multiply(a, fits(n)), s))
    return F.aggregate(away, F.lit(0).cast("bigint"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whiten(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = 4,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    block_columns: int = BLOCK_COLUMNS,
) -> DataFrame:
    """Per row its whitened coordinates: vec_id, n, deviation, whitened, explained, identity_error.

    Components become floor(scale * x). Means and covariance (divisor n) are those of the
    n distinct vectors; copies follow their vector. ``whitened`` holds the row's
    coordinates on the leading eigenvectors over the root of their eigenvalues,
    ``explained`` the eigenvalues' shares of the trace, ``deviation`` the exact sum over
    the dimensions of (n * x - sum)^2 (null beyond 64 bits), ``identity_error`` how far
    the covariance of the whitened coordinates is from the identity, at most. The sign
    of a component is such that its largest entry is positive.

    Rows with a null vector, or a null or non-finite component, are left out; null and
    repeated ids are handed through, each row on its own. Shorter vectors count as
    filled up with zeros. Directions without variance (all vectors alike, or fewer of
    them than dimensions) have no whitened coordinate: ``whitened`` is shorter there,
    empty if there is none. Other columns do not matter. An empty table gives an empty
    result. The scatter and its eigenvectors, width times width, are on the driver.
    """
    rows = df.select(F.col(vec_id).alias("_id"), F.col(vector).alias("_x")).where(usable(F.col("_x")))
    rows = stored(rows.select("_id", quantised(F.col("_x"), scale).alias("_x")), "whole-vectors")
    width = rows.agg(F.max(F.size("_x"))).first()[0]
    shape = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if width is None:
        return df.select(F.col(vec_id)).limit(0).join(df.sparkSession.createDataFrame([], shape))
    rows = rows.withColumn("_x", _filled(F.col("_x"), width))
    fit = stored(number_rows(rows.select("_x", F.xxhash64("_x").alias("_h")).distinct(), ["_h", "_x"], "index"), "fit")
    fit = fit.select((F.col("index") - 1).alias("index"), "_x")
    n = fit.count()
    # As many rows as a vector has dimensions.
    totals = fit.select(F.posexplode("_x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(19,0)")))
    by_dimension = dict(map(tuple, totals.collect()))
    sums = [int(by_dimension[at]) for at in range(width)]

    means = F.array(*[F.lit(s / n) for s in sums]).cast("array<double>")
    centred = fit.select("index", F.zip_with("_x", means, lambda x, mean: x.cast("double") - mean).alias("centred"))
    kept, scales, explained = 0, np.zeros(0), []
    if width:
        matrix = _block_matrix(centred, width, block_rows, min(width, block_columns))
        matrix.persist(StorageLevel.MEMORY_AND_DISK)  # four jobs read the blocks
        values, vectors = np.linalg.eigh(_scatter(matrix) / n)
        values, vectors = values[::-1], vectors[:, ::-1]
        trace = values.clip(0).sum()
        kept = int((values[:components] > trace * width * np.finfo(float).eps).sum())
        vectors = vectors[:, :kept] * np.sign(vectors[np.abs(vectors[:, :kept]).argmax(axis=0), range(kept)])
        scales, explained = np.sqrt(values[:kept]), (values[:kept] / trace).tolist() if kept else []
    if kept:
        whitened = stored(_projected(matrix, vectors / scales, df.sparkSession.sparkContext), "whitened")
    else:
        whitened = fit.select("index", F.array().cast("array<double>").alias("projected"))
    if width:
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    pairs = [(i, j) for i in range(kept) for j in range(i + 1)]
    w = lambda i: F.col("projected")[i]
    found = whitened.agg(*[F.covar_pop(w(i), w(j)) for i, j in pairs], F.count(F.lit(1))).first()
    error = max((abs(c - (i == j)) for (i, j), c in zip(pairs, found)), default=0.0)

    described = fit.join(whitened, "index").select(
        "_x",
        F.lit(n).cast("bigint").alias("n"),
        _squared_distance(F.col("_x"), sums, n).alias("deviation"),
        F.col("projected").alias("whitened"),
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
    # A vector that many rows share is on the side whose large partitions Spark may split.
    names = [f.split()[0] for f in shape.split(", ")]
    return rows.join(described, "_x").select(F.col("_id").alias(vec_id), *names)
