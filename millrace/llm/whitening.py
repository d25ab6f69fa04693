"""Embedding whitening with MLlib's BlockMatrix.

Rows are numbered without gaps and cut into distributed blocks of centred rows X. X'X, the
scatter, is a product of block matrices whose long middle dimension is split over tasks, so
no task sees more than its blocks. Its eigenvectors, a matrix of the vectors' length, are
found on the driver; X times the whitening matrix, again of blocks, projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, ship
from millrace.session import stored_rows


@dataclass(frozen=True)
class Whitening:
    """``components``: how many are returned. ``scale`` and ``shift``: a component c becomes
    the integer floor(scale * c) + shift. ``block_bytes``: size of a block of rows, of which
    the driver keeps two numbers each. ``least_share``: eigenvalues up to this share of the
    greatest are rounding, and their directions no components."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    block_bytes: int = 2 << 20
    least_share: float = 1e-12


def finite(vector: str) -> Column:
    """Neither null nor empty, and all components present and finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def integer_vectors(vectors: DataFrame, key: str, vector: str, how: Whitening) -> DataFrame:
    """(id, x): the vectors that are kept, as whole numbers."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.transform("v", lambda c: F.floor(c * F.lit(float(how.scale))).cast("long") + F.lit(how.shift).cast("long"))
    return rows.where(finite("v")).select("id", whole.alias("x"))


def usual_length(rows: DataFrame) -> int:
    """The length that most vectors have, the greater one of a tie; 0 for no rows."""
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def dimension_sums(rows: DataFrame, d: int) -> list[int]:
    """Exact sums of each dimension: numpy within a task, one row a task and dimension after."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [0] * d
        for batch in batches:
            if len(batch):
                x = np.stack(batch["x"].to_numpy())
                if np.abs(x).max() > (1 << 62) // len(x):
                    raise OverflowError("components too large to be summed exactly")
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        yield pd.DataFrame({"at": range(d), "s": [str(t) for t in total]})

    parts = rows.select("x").mapInPandas(run, "at int, s string")
    sums = parts.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("long").alias("s")).orderBy("at")
    return [r["s"] for r in sums.collect()]


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``at``: 0, 1, 2 ... without gaps, and store the rows.

    A row's place in its input partition is written with it; the rows of the partitions
    before are added from one row for each partition.
    """
    placed = stored_rows(rows.withColumn("mark", F.monotonically_increasing_id()))
    part, place = F.shiftright("mark", 33), F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.select("*", part.alias("part"), place.alias("place")).drop("mark")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("part").agg(F.count("*").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin")
    )
    # As many rows as the input has partitions, each of two numbers.
    return placed.join(F.broadcast(starts), "part").withColumn("at", F.col("begin") + F.col("place")).drop(
        "part", "place", "begin"
    )


def block_matrix(rows: DataFrame, n: int, d: int, values: Column, how: Whitening) -> BlockMatrix:
    """The rows (``at``, values) as distributed blocks, made without Python workers."""
    indexed = rows.select(F.col("at").alias("index"), array_to_vector(values).alias("vector"))
    height = max(64, how.block_bytes // (8 * d))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(indexed, "vector"), n, d)
    return matrix.toBlockMatrix(min(height, max(n, 1)), d)


def product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a times b, with the middle dimension cut over ``splits`` tasks.

    Python's ``multiply`` does not take the number of splits and would send all blocks of a
    product with few blocks to one task; the method of the matrix itself does.
    """
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def local_blocks(spark, values: np.ndarray, height: int) -> BlockMatrix:
    """A small local matrix as one column of blocks."""
    parts = [
        ((i // height, 0), Matrices.dense(len(p), p.shape[1], p.ravel(order="F").tolist()))
        for i in range(0, len(values), height)
        for p in [values[i : i + height]]
    ]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), height, values.shape[1], *values.shape)


def _identity_error(projected: DataFrame, k: int, n: int) -> float:
    """Greatest entry of the covariance of the projected rows minus the identity."""
    get = lambda i: F.element_at("y", i + 1)
    mean = projected.agg(*[F.avg(get(i)).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = projected.agg(
        *[F.sum((get(i) - mean[i]) * (get(j) - mean[j])).alias(f"s{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(s / n - (i == j)) for (i, j), s in zip(pairs, sums, strict=True))


SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, how: Whitening = Whitening(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error; a row for each
    remaining vector and component.

    Left out are vectors that are null, empty or hold a null or non-finite component, and
    those of another length than most (the longer one of a tie), which have no place in the
    space that is whitened. Rows that share an id, or have none, each count. Directions
    without spread are no components, so equal vectors, one vector or an empty table give
    no rows. Whole numbers are exact; what does not fit a long is an error.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = integer_vectors(vectors, key, vector, how)
    d = usual_length(rows)
    none = spark.createDataFrame([], SCHEMA)
    if not d:
        return none
    rows = numbered(rows.where(F.size("x") == d))
    n = rows.count()
    with arrow_rows(spark, 2_000):
        sums = dimension_sums(rows, d)
    # d numbers, whatever the number of rows.
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    count = F.lit(n).cast("long")
    apart = F.zip_with("x", total, lambda x, s: count * x - s)
    centre = F.transform(apart, lambda v: v.cast("double") / float(n))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda s, v: s + v * v)
    centred = block_matrix(rows, n, d, centre, how)
    splits = max(1, min(centred.numRowBlocks, spark.sparkContext.defaultParallelism * 4))
    scatter = product(centred.transpose(), centred, splits).toLocalMatrix().toArray()
    values, axes = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, axes = values[::-1], axes[:, ::-1]
    k = int((values[: how.components] > max(values[0], 0.0) * how.least_share).sum())
    if not k:
        return none
    turn = local_blocks(spark, axes[:, :k] / np.sqrt(values[:k]), d)
    projected = product(centred, turn, 1).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    projected = stored_rows(frame.select(F.col("index").alias("at"), vector_to_array("vector").alias("y")))
    error, trace = _identity_error(projected, k, n), float(values.sum())
    shares = F.array(*[F.lit(float(v) / trace) for v in values[:k]])
    return (
        rows.select("id", "at", deviation.alias("deviation"))
        .join(projected, "at")
        .select("id", "deviation", F.posexplode("y").alias("i", "whitened"))
        .select(
            F.col("id").alias("vec_id"),
            (F.col("i") + 1).alias("component"),
            count.alias("n"),
            "deviation",
            "whitened",
            F.get(shares, F.col("i")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
