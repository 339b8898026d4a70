"""Centroid clustering with a pivot table (LAESA).

The distances of every vector to a few fixed pivots are stored once. In each round the distances of the centroids to the
pivots are worked out, 40 times 8 of them; by the triangle inequality the largest difference to a vector's row of the table
is at most its distance to the centroid. Every vector gets the exact integer distance to the centroid with the smallest
bound, then to those whose bound does not exceed it. Centroids travel with the tasks, sums per cluster come back: both are
bounded by the number of centroids, and a cluster with most of the vectors is one row of sums per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from chronofold.llm.common import bounded_batches, materialized

DIMS, CENTROIDS, ROUNDS, PIVOTS, SCALE, SEED = 64, 40, 5, 8, 256, 2
# Components below this keep squared distances, and sums of them in one row, inside 64 bits.
LARGEST = 1 << 27
# Rounding of a square root and a difference, relative to the numbers: a bound is lowered by more than that.
SLACK = 1e-12


def whole_vectors(df: DataFrame, vector: str, id_col: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (longs) of the rows whose vector has `dims` finite components: floor(scale * x).

    A component too large for exact 64-bit distances fails the job, since leaving it out would change the clusters.
    """
    wide = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) < LARGEST / scale)
    too_large = F.raise_error(F.lit(f"a component is not below {LARGEST // scale}")).cast("array<bigint>")
    kept = df.where((F.size(vector) == dims) & finite)
    return kept.select(F.col(id_col).alias("vec_id"), F.when(fits, wide).otherwise(too_large).alias("vector"))


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.square(left - right).sum(axis=-1)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """`vectors` with their distances to the pivots."""
    schema = StructType([*vectors.schema.fields, StructField("to_pivots", ArrayType(DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            own = matrix(batch.column(1), pivots.shape[1])
            far = np.sqrt(np.stack([squared(own, p) for p in pivots], axis=1).astype(np.float64))
            offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(pivots))
            lists = pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*batch.columns, lists], arrow)], schema=arrow)

    return bounded_batches(vectors).mapInArrow(run, schema)


def nearest(own: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance to it, exact distances worked out). Ties: the smaller number."""
    far = np.sqrt(np.stack([squared(centroids, p) for p in pivots], axis=1).astype(np.float64))
    bound = np.zeros((len(own), len(centroids)))
    for p in range(len(pivots)):
        there, here = to_pivots[:, p, None], far[None, :, p]
        np.maximum(bound, np.abs(there - here) - SLACK * (there + here), out=bound)
    first = bound.argmin(axis=1)
    rows = np.arange(len(own))
    best = squared(own, centroids[first])
    open_ = np.square(bound) * (1 - SLACK) <= best[:, None]
    open_[rows, first] = False
    places, others = np.nonzero(open_)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[rows, first] = best
    exact[places, others] = squared(own[places], centroids[others])
    chosen = exact.argmin(axis=1)
    return chosen, exact[rows, chosen], len(own) + len(places)


def sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (vectors, their sum), added up in the tasks, then by cluster: at most one row per centroid comes back."""
    dims = centroids.shape[1]
    schema = StructType([StructField("cluster", IntegerType()), StructField("n", LongType()), StructField("total", ArrayType(LongType()))])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for batch in stream:
            own = matrix(batch.column(0), dims)
            chosen, _, _ = nearest(own, matrix(batch.column(1), len(pivots)), centroids, pivots)
            np.add.at(totals, chosen, own)
            counts += np.bincount(chosen, minlength=len(centroids))
        found = np.flatnonzero(counts)
        columns = [pa.array(found.astype(np.int32)), pa.array(counts[found]), pa.array(totals[found].tolist(), arrow.field(2).type)]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    made = bounded_batches(table.select("vector", "to_pivots")).mapInArrow(run, schema)
    per = made.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[d]) for d in range(dims))).alias("total"))
    return {r["cluster"]: (r["n"], list(r["total"])) for r in per.collect()}


def cluster(
    df: DataFrame,
    vector: str = "embedding",
    id_col: str = "vec_id",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(vec_id, cluster, distance) per kept vector, and (cluster, centroid, size, cluster_inertia, inertia) per centroid.

    Vectors with null, not finite or another number of components are left out. The first centroids are the `k` vectors
    with the smallest SHA-256 of `seed:vec_id` (a null id is an empty text; of equal ids the smaller vector first); with
    fewer vectors there are fewer centroids, and an empty table gives two empty results. Each round moves every centroid
    that has vectors to the floor of their mean; ties go to the smaller number. Repeated rows are vectors of their own.
    Other columns are not read. Sums and distances are exact in 64 bits.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, vector, id_col, dims, scale)
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = [r["vector"] for r in vectors.withColumn("order", named).orderBy("order", "vector").limit(k).collect()]
    schema = StructType([StructField("vec_id", df.schema[id_col].dataType), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    summary = "cluster int, centroid array<bigint>, size bigint, cluster_inertia bigint, inertia bigint"
    if not first:
        return spark.createDataFrame([], schema), spark.createDataFrame([], summary)
    centroids = np.array(first, np.int64)
    fixed = centroids[:pivots].copy()
    table = materialized(pivot_table(vectors, fixed), "centroid-table")
    for _ in range(rounds):
        for number, (n, total) in sums(table, centroids, fixed).items():
            centroids[number] = [t // n for t in total]
    last = centroids.copy()
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            chosen, far, _ = nearest(matrix(batch.column(1), dims), matrix(batch.column(2), len(fixed)), last, fixed)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), pa.array(chosen.astype(np.int32)), pa.array(far)], schema=arrow)

    placed = materialized(bounded_batches(table.select("vec_id", "vector", "to_pivots")).mapInArrow(run, schema), "centroid-clusters")
    found = {r["cluster"]: (r["n"], r["far"]) for r in placed.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("distance").alias("far")).collect()}
    inertia = sum(far for _, far in found.values())
    rows = [(c, last[c].tolist(), *found.get(c, (0, 0)), inertia) for c in range(len(last))]
    return placed, spark.createDataFrame(rows, summary)
