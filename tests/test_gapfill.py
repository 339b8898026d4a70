import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import chronofold as cf

BLOCKS = [65_536, 1, 2, 7]


def _frame(spark, rows, kind="timestamp_ntz"):
    df = spark.createDataFrame(rows, "k string, t string, v double")
    return df.withColumn("t", F.col("t").cast(kind))


TWO = [("a", "2026-06-01 01:00:00", 10.0), ("a", "2026-06-01 03:00:00", 30.0)]
FIVE_HOURS = {"start": "2026-06-01", "finish": "2026-06-01T05:00:00"}


@pytest.mark.parametrize("blocks", BLOCKS)
@pytest.mark.parametrize(
    ("fill", "expected"),
    [
        ({}, [None, 10, None, 30, None]),
        ({"locf": ["v"]}, [None, 10, 10, 30, 30]),
        ({"interpolate": ["v"]}, [None, 10, 20, 30, None]),
    ],
)
def test_hand_made_series(spark, blocks, fill, expected):
    out = cf.gapfill(_frame(spark, TWO), "1 hour", "t", {"v": "max(v)"}, **FIVE_HOURS, **fill, block_buckets=blocks)
    assert [r.v for r in out.orderBy("bucket").collect()] == expected


@pytest.mark.parametrize("blocks", BLOCKS)
def test_every_key_covers_the_whole_range(spark, blocks):
    rows = [("a", "2026-06-01 01:00:00", 1.0), ("b", "2026-06-01 03:00:00", 2.0)]
    out = cf.gapfill(_frame(spark, rows), "1 hour", "t", {"n": "count(*)"}, keys=["k"], **FIVE_HOURS, block_buckets=blocks)
    assert out.groupBy("k").count().orderBy("k").collect() == [("a", 5), ("b", 5)]
    assert out.where("n IS NOT NULL").count() == 2


def test_default_range_is_that_of_the_whole_input(spark):
    rows = [("a", "2026-06-01 01:30:00", 1.0), ("b", "2026-06-01 03:59:00", 2.0)]
    out = cf.gapfill(_frame(spark, rows), "1 hour", "t", {"v": "max(v)"}, keys=["k"])
    bounds = out.groupBy("k").agg(F.min("bucket"), F.max("bucket"), F.count("*")).orderBy("k").collect()
    day = datetime(2026, 6, 1)
    assert [tuple(b) for b in bounds] == [(k, day + timedelta(hours=1), day + timedelta(hours=3), 3) for k in "ab"]


@pytest.mark.parametrize("blocks", [65_536, 2])
def test_empty_input(spark, blocks):
    nothing = _frame(spark, TWO).where("false")
    assert cf.gapfill(nothing, "1 hour", "t", {"v": "max(v)"}, block_buckets=blocks).count() == 0
    assert cf.gapfill(nothing, "1 hour", "t", {"v": "max(v)"}, keys=["k"], **FIVE_HOURS, block_buckets=blocks).count() == 0
    series = cf.gapfill(nothing, "1 hour", "t", {"v": "max(v)"}, **FIVE_HOURS, block_buckets=blocks)
    assert [r.v for r in series.collect()] == [None] * 5


def test_types_are_kept(spark):
    df = _frame(spark, TWO, "timestamp").withColumn("i", F.col("v").cast("int"))
    out = cf.gapfill(df, "30 minutes", "t", {"i": "max(i)", "s": "max(k)"}, interpolate=["i"], locf=["s"])
    assert dict(out.dtypes) == {"bucket": "timestamp", "i": "int", "s": "string"}
    assert [(r.i, r.s) for r in out.orderBy("bucket").collect()] == [(10, "a"), (15, "a"), (20, "a"), (25, "a"), (30, "a")]


def test_null_values_in_a_bucket_are_gaps(spark):
    rows = [*TWO, ("a", "2026-06-01 02:00:00", None)]
    out = cf.gapfill(_frame(spark, rows), "1 hour", "t", {"v": "max(v)", "w": "max(v)"}, locf=["v"], interpolate=["w"])
    assert [(r.v, r.w) for r in out.orderBy("bucket").collect()] == [(10, 10), (10, 20), (30, 30)]


def test_calendar_widths_interpolate_over_time(spark):
    rows = [("a", "2024-01-10", 0.0), ("a", "2024-03-10", 60.0)]
    out = cf.gapfill(_frame(spark, rows), "1 month", "t", {"v": "max(v)"}, interpolate=["v"]).orderBy("bucket").collect()
    assert [(r.bucket.month, r.v) for r in out] == [(1, 0.0), (2, 31.0), (3, 60.0)]


def test_integer_time(spark):
    df = spark.createDataFrame([(-7, 1), (12, 2)], "x bigint, v int")
    out = cf.gapfill(df, 5, "x", {"v": "max(v)"}, locf=["v"]).orderBy("bucket").collect()
    assert [(r.bucket, r.v) for r in out] == [(-10, 1), (-5, 1), (0, 1), (5, 1), (10, 2)]


def test_arguments(spark):
    with pytest.raises(ValueError):
        cf.gapfill(_frame(spark, TWO), "1 hour", "t", {"v": "max(v)"}, locf=["w"])
    with pytest.raises(ValueError):
        cf.gapfill(_frame(spark, TWO), "1 hour", "t", {"v": "max(v)"}, locf=["v"], interpolate=["v"])


def _brute_force(rows, keys, buckets):
    """Straight loops over every key and bucket."""
    out = {}
    for key in keys:
        known = {b: max(vs) for b in buckets if (vs := [v for k, t, v in rows if k == key and t == b and v is not None])}
        for b in buckets:
            earlier = [x for x in known if x <= b]
            later = [x for x in known if x >= b]
            carried = known[max(earlier)] if earlier else None
            line = None
            if earlier and later:
                x0, x1 = max(earlier), min(later)
                line = known[x0] if x0 == x1 else known[x0] + (known[x1] - known[x0]) * (b - x0) / (x1 - x0)
            out[key, b] = (carried, None if line is None else round(line, 9))
    return out


@pytest.mark.parametrize("blocks", [65_536, 1, 3, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, blocks):
    draw = random.Random(seed)
    rows = [
        (draw.choice(["a", "b", "c", None]), draw.randrange(0, 60), draw.choice([None, float(draw.randrange(100))]))
        for _ in range(40)
    ]
    # One key holds a dense stretch, so that full, half-empty and empty blocks all occur.
    rows += [("hot", t, float(t)) for t in range(20, 45)]
    buckets = range(min(t for _, t, _ in rows), max(t for _, t, _ in rows) + 1)
    df = spark.createDataFrame(rows, "k string, t bigint, v double")
    aggs = {"carried": "max(v)", "line": "max(v)"}
    out = cf.gapfill(df, 1, "t", aggs, keys=["k"], locf=["carried"], interpolate=["line"], block_buckets=blocks)
    got = {(r.k, r.bucket): (r.carried, None if r.line is None else round(r.line, 9)) for r in out.collect()}
    assert out.count() == len(got)
    assert got == _brute_force(rows, {k for k, _, _ in rows}, buckets)


def test_long_series_scans_the_input_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    aggs = {"high": "max(value)", "n": "count(*)"}
    out = cf.gapfill(events, "1 minute", "ts", aggs, keys=["event_type"], locf=["high"], block_buckets=100)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


def test_runs_in_the_jvm(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = cf.gapfill(events, "1 hour", "ts", {"v": "avg(value)"}, keys=["user_id"], interpolate=["v"])._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
