from datetime import datetime

import pytest
from pyspark.sql import functions as F

import chronofold as cf
from chronofold import RollupSpec, SpecError, TableError, TableSpec
from chronofold.sources.manifest import Table
from chronofold.streaming.rollup_stream import windowed

READINGS = [("2026-06-01 10:00:00", "a", 10.0), ("2026-06-01 10:20:00", "a", 30.0), ("2026-06-01 10:40:00", "b", 50.0)]


def readings(spark, rows):
    df = spark.createDataFrame(rows, "time string, device_id string, value double")
    return df.withColumn("time", F.col("time").cast("timestamp"))


def series(spark, n, first=0):
    """One reading every ten minutes from 2026-06-01 for one of three devices; values are whole numbers."""
    return spark.range(first, first + n).select(
        F.timestamp_add("MINUTE", F.col("id") * 10, F.lit("2026-06-01").cast("timestamp")).alias("time"),
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("device_id"),
        F.col("id").cast("double").alias("value"),
    )


def hourly(source, **changes):
    settings = {"width": "1 hour", "aggs": {"total": "sum(value)", "n": "count(*)"}, "keys": ["device_id"], "chunk": "1 day"}
    return RollupSpec(source=source, time="time", **{**settings, **changes})


def expected(rows, where="true"):
    return cf.bucket_by(rows.where(where), "1 hour", "time", {"total": "sum(value)", "n": "count(*)"}, keys=["device_id"])


def same(left, right):
    return cf.checksum(left) == cf.checksum(right.select(left.columns))


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    cf.create_hypertable(series(spark, 600), path, TableSpec("time", chunk="1 day"))
    return path


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "hourly")


def test_three_readings(spark, tmp_path, path):
    raw = str(tmp_path / "raw")
    cf.create_hypertable(readings(spark, READINGS), raw, TableSpec("time", chunk="1 day", dims={"device_id": 4}))
    cf.create_rollup(spark, path, hourly(raw, aggs={"average": "avg(value)"}))
    assert cf.read_rollup(spark, path).count() == 0
    cf.refresh(spark, path)
    got = [(r.device_id, r.average) for r in cf.read_rollup(spark, path).orderBy("device_id").collect()]
    assert got == [("a", 20.0), ("b", 50.0)]


def test_create_with_data(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))


def test_window_refresh_takes_whole_buckets_only(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw))
    cf.refresh(spark, path, "2026-06-01T05:30:00", "2026-06-02T07:59:00")
    inside = "time >= '2026-06-01 06:00:00' AND time < '2026-06-02 07:00:00'"
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), inside))
    cf.refresh(spark, path, "2026-06-02T07:10:00", "2026-06-02T07:50:00")
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), inside))
    # A second, overlapping window keeps the other buckets of the chunks it touches.
    cf.refresh(spark, path, "2026-06-02T03:00:00", "2026-06-02T12:00:00")
    inside = "time >= '2026-06-01 06:00:00' AND time < '2026-06-02 12:00:00'"
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), inside))


def test_window_refresh_reads_and_replaces_only_its_chunks(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    before = set(cf.scan(spark, path).inputFiles())
    cf.refresh(spark, path, "2026-06-03", "2026-06-04")
    after = set(cf.scan(spark, path).inputFiles())
    assert len(before & after) == len(before) - 1
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))


def test_refresh_sees_late_rows_and_can_be_repeated(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    late = series(spark, 20, 100).withColumn("value", F.lit(1000.0))
    cf.append(late, raw)
    for _ in range(2):
        cf.refresh(spark, path, "2026-06-01", "2026-06-03")
        assert same(cf.read_rollup(spark, path), expected(series(spark, 600).unionByName(late)))


def test_policy_run(spark, raw, path):
    spec = hourly(raw, start_offset="2 days", end_offset="1 hour")
    cf.create_rollup(spark, path, spec)
    cf.run_refresh_policy(spark, path, now=datetime(2026, 6, 3, 12, 15))
    inside = "time >= '2026-06-01 13:00:00' AND time < '2026-06-03 11:00:00'"
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), inside))
    other = path + "-none"
    cf.create_rollup(spark, other, hourly(raw))
    with pytest.raises(TableError):
        cf.run_refresh_policy(spark, other)


def test_integer_time_rollup(spark, tmp_path, path):
    raw = str(tmp_path / "raw")
    ticks = spark.range(1000).select((F.col("id") - 300).alias("tick"), F.col("id").cast("double").alias("value"))
    cf.create_hypertable(ticks, raw, TableSpec("tick", chunk=100))
    spec = RollupSpec(raw, "tick", 10, {"total": "sum(value)"}, start_offset=200, end_offset=5)
    cf.create_rollup(spark, path, spec)
    cf.run_refresh_policy(spark, path, now=600)
    got = cf.read_rollup(spark, path).agg(F.min("bucket"), F.max("bucket"), F.count("*")).first()
    assert tuple(got) == (400, 580, 19)


def test_realtime_read(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, materialized_only=False))
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))
    cf.refresh(spark, path, None, "2026-06-02T09:00:00")
    cf.append(series(spark, 100, 600), raw)
    assert same(cf.read_rollup(spark, path), expected(series(spark, 700)))
    stored = cf.read_rollup(spark, path, realtime=False)
    assert same(stored, expected(series(spark, 700), "time < '2026-06-02 09:00:00'"))
    ranged = cf.read_rollup(spark, path, start="2026-06-02T08:00:00", end="2026-06-02T11:00:00")
    assert same(ranged, expected(series(spark, 700), "time >= '2026-06-02 08:00:00' AND time < '2026-06-02 11:00:00'"))
    raw_part = cf.read_rollup(spark, path, start="2026-06-05")
    # One day of raw rows, from the first load and from the append.
    assert len({f for f in raw_part.inputFiles() if "/raw/" in f}) == 2


def test_stacked_rollups(spark, raw, path):
    daily = path + "-daily"
    cf.create_rollup(spark, path, hourly(raw, aggs={"average": "avg(value)"}))
    cf.create_rollup(spark, daily, RollupSpec(path, "bucket", "1 day", {"average": "avg(average)"}, bucket="day"))
    assert cf.refresh_tree(spark, [daily, path]) == [path, daily]
    by_hour = cf.bucket_by(series(spark, 600), "1 hour", "time", {"average": "avg(value)"}, keys=["device_id"])
    by_day = cf.bucket_by(by_hour, "1 day", "bucket", {"average": F.round(F.avg("average"), 9)}, bucket="day")
    assert same(cf.read_rollup(spark, daily).withColumn("average", F.round("average", 9)), by_day)
    with pytest.raises(SpecError):
        cf.create_rollup(spark, path + "-x", RollupSpec(path, "average", "1 day", {"n": "count(*)"}))


def test_dropped_raw_rows_keep_their_buckets(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, width="36:00:00"), with_data=True)
    complete = cf.read_rollup(spark, path).collect()
    cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 3))
    cf.refresh(spark, path)
    assert sorted(cf.read_rollup(spark, path).collect()) == sorted(complete)
    # New rows behind the dropped range are still picked up.
    cf.append(series(spark, 100, 600), raw)
    cf.refresh(spark, path)
    assert cf.read_rollup(spark, path).agg(F.sum("n")).first()[0] == 700


def test_a_rollup_created_after_retention_has_all_live_rows(spark, raw, path):
    cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 3))
    cf.create_rollup(spark, path, hourly(raw, width="36:00:00"), with_data=True)
    live = cf.scan(spark, raw).count()
    assert cf.read_rollup(spark, path).agg(F.sum("n")).first()[0] == live


def test_rollup_retention_and_compression(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, segment_by="device_id", compress_after="1 day", drop_after="3 days"), with_data=True)
    cf.compress_chunks(spark, path, now=datetime(2026, 6, 4))
    assert cf.layout(spark, path).where("compressed").count() == 2
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))
    cf.refresh(spark, path, "2026-06-02", "2026-06-03")
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))
    cf.drop_chunks(spark, path, now=datetime(2026, 6, 5))
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), "time >= '2026-06-02'"))


def test_redefine_rebuilds_dependents(spark, raw, path):
    daily = path + "-daily"
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    cf.create_rollup(spark, daily, RollupSpec(path, "bucket", "1 day", {"total": "sum(total)"}, bucket="day"), with_data=True)
    files = cf.scan(spark, path).inputFiles()
    assert cf.redefine(spark, path, hourly(raw, start_offset="3 days", end_offset="1 hour"), [daily]) is False
    assert cf.scan(spark, path).inputFiles() == files
    changed = hourly(raw, where="device_id <> 'd0'", width="2 hours", aggs={"total": "sum(value)", "high": "max(value)"})
    assert cf.redefine(spark, path, changed, [daily]) is True
    kept = series(spark, 600).where("device_id <> 'd0'")
    aggs = {"total": "sum(value)", "high": "max(value)"}
    assert same(cf.read_rollup(spark, path), cf.bucket_by(kept, "2 hours", "time", aggs, keys=["device_id"]))
    assert same(cf.read_rollup(spark, daily), cf.bucket_by(kept, "1 day", "time", {"total": "sum(value)"}, bucket="day"))


def test_drop_order(spark, raw, path):
    daily = path + "-daily"
    cf.create_rollup(spark, path, hourly(raw))
    cf.create_rollup(spark, daily, RollupSpec(path, "bucket", "1 day", {"n": "sum(n)"}, bucket="day"))
    assert cf.drop_rollups(spark, [path, daily]) == [daily, path]
    for gone in (path, daily):
        with pytest.raises(TableError):
            cf.read_rollup(spark, gone)
    assert cf.scan(spark, raw).count() == 600


def test_a_rollup_is_not_a_plain_table(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw))
    with pytest.raises(TableError):
        cf.append(cf.read_rollup(spark, path), path)
    with pytest.raises(TableError):
        cf.rebuild(spark, path, TableSpec("bucket"))
    with pytest.raises(TableError):
        cf.refresh(spark, raw)


# --- streaming ------------------------------------------------------------------------------------------------------


def _files(spark, frames, folder):
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(folder)


def _incoming(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_keeps_a_rollup(spark, tmp_path, path):
    raw, folder, checkpoint = (str(tmp_path / name) for name in ("raw", "in", "ck"))
    cf.create_hypertable(series(spark, 0), raw, TableSpec("time", chunk="1 day"))
    cf.create_rollup(spark, path, hourly(raw, start_offset="3 days", end_offset="1 hour"))
    _files(spark, [series(spark, 200), series(spark, 200, 200)], folder)
    stream = _incoming(spark, folder, series(spark, 1).schema)
    cf.stream_rollup(stream, path, checkpoint).awaitTermination()
    # The last row is at 18:30 on the third day, so windows up to 17:00 are closed.
    assert same(cf.read_rollup(spark, path), expected(series(spark, 400), "time < '2026-06-03 17:00:00'"))
    # The query goes on from its checkpoint; rows later than the watermark are left to the next refresh.
    late = series(spark, 3, 10).withColumn("value", F.lit(500.0))
    _files(spark, [late, series(spark, 200, 400)], folder)
    cf.stream_rollup(stream, path, checkpoint).awaitTermination()
    closed = "time < '2026-06-05 02:00:00'"
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600), closed))
    cf.append(series(spark, 600).unionByName(late), raw)
    cf.refresh(spark, path, None, "2026-06-02")
    assert same(cf.read_rollup(spark, path), expected(series(spark, 600).unionByName(late), closed))


def test_a_replayed_batch_changes_nothing(spark, raw, path):
    from chronofold.rollups.rollup import upsert_buckets

    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    batch = expected(series(spark, 600), "time >= '2026-06-02' AND time < '2026-06-03'")
    for _ in range(2):
        upsert_buckets(spark, path, batch)
        assert same(cf.read_rollup(spark, path), expected(series(spark, 600)))


def test_streamed_weeks_start_on_monday(spark, tmp_path):
    folder = str(tmp_path / "in")
    _files(spark, [series(spark, 3000)], folder)
    spec = RollupSpec("/nowhere", "time", "7 days", {"n": "count(*)"}, start_offset="30 days", end_offset="0 days")
    query = (
        windowed(_incoming(spark, folder, series(spark, 1).schema), spec)
        .writeStream.format("memory")
        .queryName("weeks")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = sorted((r.bucket, r.n) for r in spark.table("weeks").collect())
    wanted = sorted(tuple(r) for r in cf.bucket_by(series(spark, 3000), "7 days", "time", {"n": "count(*)"}).collect())
    assert got == wanted[:-1]


def test_calendar_widths_are_not_streamed(spark, tmp_path):
    folder = str(tmp_path / "in")
    _files(spark, [series(spark, 3)], folder)
    spec = RollupSpec("/nowhere", "time", "1 month", {"n": "count(*)"})
    with pytest.raises(SpecError):
        windowed(_incoming(spark, folder, series(spark, 1).schema), spec)


def test_high_water_follows_the_highest_bucket(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw))
    assert Table.at(spark, path).state.high_water is None
    cf.refresh(spark, path, None, "2026-06-01T05:00:00")
    high = Table.at(spark, path).state.high_water
    cf.refresh(spark, path, None, "2026-06-01T03:00:00")
    assert Table.at(spark, path).state.high_water == high
