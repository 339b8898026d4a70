"""Chunks left out by conditions, joins and statistics."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import chronofold as cf
from chronofold import TableError, TableSpec
from tests.test_rollups import same, series


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def chunks_opened(df):
    return {f.split("_chunk=")[1].split("/")[0] for f in df.inputFiles() if "/data/" in f}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pruning") / "raw")
    cf.create_hypertable(series(spark, 1200), path, TableSpec("time", chunk="1 day", dims={"device_id": 4}, segment_by="device_id"))
    return path


@pytest.mark.parametrize(
    ("condition", "days"),
    [
        ("time >= '2026-06-03' AND time < '2026-06-05'", 2),
        ("time BETWEEN '2026-06-03 12:00:00' AND '2026-06-03 13:00:00'", 1),
        ("time < '2026-06-02' OR time >= '2026-06-09'", 2),
        ("time IN (timestamp'2026-06-02 00:10:00', timestamp'2026-06-07 00:00:00')", 2),
        ("(time < '2026-06-02' OR time > '2026-06-08 12:00:00') AND value > 3", 3),
        ("'2026-06-08' <= time", 2),
        ("time = '2026-06-04 00:00:00'", 1),
        ("time > '2030-01-01'", 0),
        ("time < NULL", 0),
        ("value > 500", 9),
        ("time >= '2026-06-08' OR value < 5", 9),
        ("hour(time) = 3 AND time < date'2026-06-03'", 2),
    ],
)
def test_conditions_choose_chunks(spark, raw, condition, days):
    found = cf.scan(spark, raw, where=condition)
    assert same(found, series(spark, 1200).where(condition))
    assert len(chunks_opened(found)) == days if days else not found.inputFiles()
    if days:
        assert "PartitionFilters: [isnotnull(_chunk" in plan(found)


def test_hash_dimensions_by_several_values(spark, raw):
    for condition, values in (("device_id = 'd1'", {"d1"}), ("device_id IN ('d0', 'd2')", {"d0", "d2"}), ("device_id = 'd1' OR device_id = 'd0'", {"d0", "d1"})):
        found = cf.scan(spark, raw, where=condition)
        assert same(found, series(spark, 1200).where(condition))
        buckets = {r[0] for r in spark.range(1).select(F.explode(F.array(*[F.pmod(F.hash(F.lit(v)), F.lit(4)) for v in values]))).collect()}
        assert {int(f.split("_h_device_id=")[1].split("/")[0]) for f in found.inputFiles()} == buckets


def test_random_conditions_lose_no_row(spark, raw):
    rng = random.Random(4)

    def drawn(depth):
        if depth and rng.random() < 0.6:
            return f"({drawn(depth - 1)} {rng.choice(['AND', 'OR'])} {drawn(depth - 1)})"
        at = f"timestamp'2026-06-0{rng.randint(1, 9)} {rng.randint(0, 23):02d}:00:00'"
        return rng.choice(
            [f"time {rng.choice(['<', '<=', '>', '>=', '=', '<=>'])} {at}", f"NOT time < {at}", f"device_id IN ('d{rng.randint(0, 3)}', NULL)", f"value < {rng.randint(0, 1200)}", "device_id IS NOT NULL"]
        )

    for _ in range(12):
        condition = drawn(3)
        assert same(cf.scan(spark, raw, where=condition), series(spark, 1200).where(condition)), condition


def test_skip_columns_by_condition(spark, tmp_path):
    path = str(tmp_path / "skip")
    rows = series(spark, 600).withColumn("n", F.col("value").cast("long"))
    cf.create_hypertable(rows, path, TableSpec("time", chunk="1 day", segment_by="device_id"))
    cf.enable_chunk_skipping(spark, path, "n")
    cf.compress_chunks(spark, path)
    found = cf.scan(spark, path, where="n IN (3, 300) OR n BETWEEN 500 AND 510")
    assert same(found, rows.where("n IN (3, 300) OR n BETWEEN 500 AND 510")) and len(chunks_opened(found)) == 3


def test_joins_prune_by_hash_bucket(spark, raw):
    other = spark.createDataFrame([("d1", 1), ("d2", 2), ("d9", 3)], "device_id string, rank int").where("rank = 1")
    found = cf.scan_joined(spark, raw, other, "device_id")
    assert "dynamicpruning" in plan(found)
    assert found.columns == ["device_id", "time", "value", "rank"]
    assert same(found, series(spark, 1200).join(other, "device_id"))
    half = cf.scan_joined(spark, raw, other.drop("rank"), "device_id", "left_semi")
    assert same(half, series(spark, 1200).where("device_id = 'd1'"))
    with pytest.raises(TableError):
        cf.scan_joined(spark, raw, other, "device_id", "left")


def test_joins_over_layouts_with_other_dimensions(spark, tmp_path):
    path = str(tmp_path / "layouts")
    cf.create_hypertable(series(spark, 300), path, TableSpec("time", chunk="1 day"))
    cf.alter(spark, path, TableSpec("time", chunk="1 day", dims={"device_id": 3}))
    cf.append(series(spark, 300, 300), path)
    other = spark.createDataFrame([("d0",), ("d2",)], "device_id string")
    assert same(cf.scan_joined(spark, path, other, "device_id"), series(spark, 600).where("device_id <> 'd1'"))


def test_latest_opens_the_newest_chunks_only(spark, raw):
    for n in (1, 10, 200, 5000):
        found = cf.latest(spark, raw, n)
        wanted = series(spark, 1200).orderBy(F.col("time").desc()).limit(n)
        assert [r["time"] for r in found.collect()] == [r["time"] for r in wanted.collect()]
    assert len(chunks_opened(cf.latest(spark, raw, 10))) == 1
    assert cf.latest(spark, raw, 0).count() == 0


def test_latest_with_overlapping_chunks(spark, tmp_path):
    path = str(tmp_path / "late")
    cf.create_hypertable(series(spark, 600), path, TableSpec("time", chunk="1 day"))
    cf.append(series(spark, 50, 540), path)
    cf.append(series(spark, 3, 5), path)
    wanted = series(spark, 600).unionByName(series(spark, 50, 540)).unionByName(series(spark, 3, 5))
    for n in (5, 60, 130):
        assert [r[0] for r in cf.latest(spark, path, n).select("time").collect()] == [r[0] for r in wanted.orderBy(F.col("time").desc()).limit(n).select("time").collect()]


def test_counts_read_the_edges_only(spark, raw):
    df = cf.count_in_range(spark, raw, "2026-06-02T05:00:00", "2026-06-07T03:00:00")
    assert chunks_opened(df) == {str(int(datetime(2026, 6, d).timestamp() - datetime(1970, 1, 1).timestamp()) * 10**6) for d in (2, 7)}
    rows = series(spark, 1200)
    for start, end in ((None, None), ("2026-06-03", "2026-06-05"), ("2026-06-02T05:00:00", None), ("2031-01-01", None)):
        wanted = rows
        if start:
            wanted = wanted.where(F.col("time") >= F.lit(start).cast("timestamp"))
        if end:
            wanted = wanted.where(F.col("time") < F.lit(end).cast("timestamp"))
        got = cf.count_in_range(spark, raw, start, end).first()
        assert tuple(got) == tuple(wanted.agg(F.count("*"), F.min("time"), F.max("time")).first())
    assert not chunks_opened(cf.count_in_range(spark, raw))


def test_time_range_as_id_range(spark, tmp_path):
    path = str(tmp_path / "ids")
    cf.with_uuid7(series(spark, 600), "time").repartitionByRange(4, "id").write.parquet(path)
    rows = spark.read.parquet(path)
    found = rows.where(cf.uuid7_between("id", "2026-06-02T00:05:00", "2026-06-03"))
    assert same(found.select("time", "device_id", "value"), series(spark, 600).where("time >= '2026-06-02 00:05:00' AND time < '2026-06-03'").select("time", "device_id", "value"))
    assert "GreaterThanOrEqual(id," in plan(found) and "LessThan(id," in plan(found)
    assert rows.where(cf.uuid7_between("id")).count() == 600
    with pytest.raises(ValueError):
        cf.uuid7_between("id", "1950-01-01")
