"""Embedding whitening with distributed block matrices of Spark's MLlib.

Vectors become integers, whose sums are exact.  The centred rows are indexed and cut into
the blocks of a BlockMatrix; its transpose times itself is the scatter matrix, summed in
parts over the rows; the eigenvectors of that small matrix are found on the driver; the
blocks times the whitening matrix are the projected rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import stored
from scoreloom.plans.sizing import small_table

SCALE = 1024
SHIFT = 100_000
ROWS = 1024
BLOCK_BYTES = 32 << 20
# The block numbers of a product are gathered on the driver; blocks grow before they get so many.
BLOCKS = 1 << 16


@dataclass
class Whitening:
    """What a fit list gives: its size, sums for each dimension, and whitening components."""

    n: int
    sums: list[int]
    components: np.ndarray  # a column for each, over the root of its eigenvalue
    explained: list[float]


def whole_numbers(embedding: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift for each entry, as an array of longs."""
    return F.transform(
        embedding, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift).cast("long")
    )


def usable(embeddings: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is not null and has finite entries only."""
    bad = F.exists(
        F.col(f"`{vector}`"),
        lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")),
    )
    return embeddings.filter(F.col(f"`{vector}`").isNotNull() & ~F.coalesce(bad, F.lit(False)))


def index_rows(df: DataFrame, name: str) -> DataFrame:
    """``df``, written, with the global row number as ``name``."""
    placed = stored(df.withColumn("_place", F.monotonically_increasing_id()), "indexed")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    # One row for each task that wrote.
    offsets = small_table(counts.select("_part", before.alias("_before")), 1 << 20)
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.col("_before") + place)
        .drop("_part", "_before", "_place")
    )


def _block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The blocks of the matrix that has the arrays ``x`` of doubles as rows ``index``."""
    vectors = rows.select("index", array_to_vector("x").alias("vector"))
    given = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    tall = max(ROWS, min(-(-n // BLOCKS), BLOCK_BYTES // (8 * width)))
    return IndexedRowMatrix(given, n, width).toBlockMatrix(tall, width).persist(
        StorageLevel.MEMORY_AND_DISK
    )


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product with the summed dimension in ``splits`` parts, so that no task sums all rows.

    PySpark's ``multiply`` leaves this argument of the JVM's method out.
    """
    one, other = (m._java_matrix_wrapper._java_model for m in (left, right))
    return BlockMatrix(one.multiply(other, splits), left.rowsPerBlock, right.colsPerBlock)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """Sums of the products of columns: width x width numbers, for the driver."""
    splits = max(1, min(matrix.numRowBlocks, matrix.blocks.getNumPartitions()))
    return _product(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def fit(centred: BlockMatrix, n: int, sums: list[int], most: int) -> Whitening:
    """Components of the covariance of the centred rows, the largest eigenvalue first.

    A component without variance whitens to zeros.
    """
    covariance = _scatter(centred) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    # Below this, an eigenvalue is the rounding of the larger ones.
    some = values > max(trace, 0.0) * len(values) * np.finfo(float).eps
    scales = np.where(some, 1 / np.sqrt(np.where(some, values, 1.0)), 0.0)
    explained = np.where(some, values, 0.0) / (trace or 1.0)
    return Whitening(n, sums, (vectors * scales)[:, :most], explained[:most].tolist())


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest entry of the covariance of the arrays ``y`` less the identity, in either sign.

    Components without variance are left out.
    """
    own = [F.get("y", F.lit(i)) for i in range(components)]
    first = whitened.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(own))).first()
    centred = [c - F.lit(float(first[i])) for i, c in enumerate(own)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]).alias(f"v{i}_{j}") for i, j in pairs)).first()
    errors = [
        abs(value - (i == j))
        for (i, j), value in zip(pairs, found, strict=True)
        if value or i != j
    ]
    return float(max(errors, default=0.0))


def whiten(
    embeddings: DataFrame,
    vector: str = "embedding",
    components: int = 8,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """The usable rows with index, deviation, whitened (array), explained (array), identity_error, n.

    Entries become whole numbers first (``whole_numbers``); all usable rows are fitted.  The
    covariance has divisor n, and rows are centred before anything is multiplied.  deviation is
    the exact sum over dimensions of (n x - S)^2, a long; null if it does not fit, and in any
    case exact as deviation_exact, a decimal of 38 digits.

    Rows with a null vector or with null, NaN or infinite entries are dropped.  The dimension is
    the most frequent length of a vector (the larger of equals); usable rows of another length,
    empty ones too, cannot be projected and are dropped.  Repeated rows count as often as they
    stand and get equal results.  If all rows are equal, whitened and explained are 0.  An empty
    table gives no rows.  Columns named like the added ones are replaced, all others kept.  The
    dimension is to be one whose square the driver can hold.
    """
    spark = embeddings.sparkSession
    added = ("index", "deviation", "deviation_exact", "whitened", "explained", "identity_error", "n")
    names = [c for c in embeddings.columns if c not in added]
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")
    x = whole_numbers(F.col(f"`{vector}`"), scale, shift).alias("x")
    found = usable(embeddings, vector).select(row, x).filter(F.size("x") > 0)
    lengths = found.groupBy(F.size("x").alias("width")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    width, n = (common["width"], common["count"]) if common else (1, 0)
    indexed = stored(index_rows(found.filter(F.size("x") == width), "index"), "whole_numbers")
    per_dimension = indexed.select(F.posexplode("x").alias("at", "value"))
    # As many rows as dimensions.
    sums = [
        r["total"]
        for r in per_dimension.groupBy("at").agg(F.sum("value").alias("total")).orderBy("at").collect()
    ]
    moved = F.zip_with("x", F.array(*map(F.lit, sums or [0])), lambda v, s: v * F.lit(n) - s)
    centred = indexed.select("index", F.transform(moved, lambda v: v / F.lit(float(n or 1))).alias("x"))
    projected, error, explained = _projected(spark, centred, n, sums, width, components)
    square = F.aggregate(
        moved,
        F.lit(0).cast("decimal(38,0)"),
        lambda a, v: (a + v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)"),
    )
    return indexed.withColumn("deviation_exact", square).join(projected, "index").select(
        "row.*",
        "index",
        F.col("deviation_exact").try_cast("long").alias("deviation"),
        "deviation_exact",
        F.col("y").alias("whitened"),
        F.array(*map(F.lit, explained)).cast("array<double>").alias("explained"),
        F.lit(error).alias("identity_error"),
        F.lit(n).cast("long").alias("n"),
    )


def _projected(
    spark: SparkSession, centred: DataFrame, n: int, sums: list[int], width: int, components: int
) -> tuple[DataFrame, float, list[float]]:
    """(index, y) of all rows, the error of their covariance, and what the components explain."""
    if not n:
        return spark.createDataFrame([], "index long, y array<double>"), 0.0, []
    matrix = _block_matrix(centred, n, width)
    model = fit(matrix, n, sums, components)
    kept = model.components.shape[1]
    local = DenseMatrix(width, kept, model.components.T.ravel())
    factor = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), width, kept)
    product = matrix.multiply(factor).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    projected = stored(rows.select("index", vector_to_array("vector").alias("y")), "whitened")
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return projected, identity_error(projected, kept), model.explained
