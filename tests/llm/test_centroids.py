"""Clustering against brute force in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from chronofold.llm import centroids
from chronofold.llm.queries import ORACLE_SQL, op11_clusters
from tests.oracle import connect, differences

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def brute(rows, k, rounds):
    """{position: (cluster, distance)} and the centroids."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))[::-1] for _, v in kept]

    for _ in range(rounds):
        placed = assign()
        for n in range(len(middle)):
            own = [v for (_, v), (c, _) in zip(kept, placed) if c == n]
            if own:
                middle[n] = [sum(x) // len(own) for x in zip(*own)]
    return sorted((i if i is not None else -1, *p) for (i, _), p in zip(kept, assign())), middle


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, spread) + 3 * (i % 4))) for _ in range(dims)]) for i in range(n)]


def test_equals_brute_force_and_ties(spark):
    rows = vectors(120, 4, 1)
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(5)] + [(None, [1.0, 2.0, 3.0, 4.0]), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA).repartition(3)
    placed, found = centroids.cluster(df, k=9, rounds=3, pivots=2, dims=4)
    expected, middle = brute(rows, 9, 3)
    got = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"]) for r in placed.collect())
    assert got == expected
    by_number = {r["cluster"]: r for r in found.collect()}
    assert [by_number[n]["centroid"] for n in range(9)] == middle
    for n, r in by_number.items():
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == n) and r["size"] == sum(c == n for _, c, _ in expected)
        assert r["inertia"] == sum(d for *_, d in expected)


def test_query_equals_sql(spark, sf_dir):
    assert differences(op11_clusters(spark, sf_dir), connect(sf_dir), ORACLE_SQL["op11_clusters"]) is None


def test_rows_that_are_no_vectors_are_left_out(spark):
    good = [1.0, 2.0]
    odd = [None, [], [1.0], [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [1.0, 2.0, 3.0]]
    df = spark.createDataFrame([(i, v, None, 1) for i, v in enumerate([*odd, good, good])], SCHEMA)
    placed, found = centroids.cluster(df, k=5, dims=2)
    assert sorted((r["vec_id"], r["distance"]) for r in placed.collect()) == [(7, 0), (8, 0)]
    assert found.count() == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    placed, found = centroids.cluster(none)
    assert placed.count() == found.count() == 0


def test_components_beyond_exact_distances_fail(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0], "x", 1)], SCHEMA)
    with pytest.raises(PySparkException, match="component"):
        centroids.cluster(df, dims=2)


def test_bounds_prune_without_losing_the_nearest():
    rng = np.random.default_rng(4)
    middle = rng.integers(-2000, 2000, (40, 64))
    own = middle[rng.integers(0, 40, 500)] + rng.integers(-100, 100, (500, 64))
    far = np.sqrt(np.stack([centroids.squared(own, p) for p in middle[:8]], axis=1).astype(float))
    chosen, best, worked = centroids.nearest(own, far, middle, middle[:8])
    exact = np.stack([centroids.squared(own, c) for c in middle], axis=1)
    assert (chosen == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert worked < 500 * 40 / 3
