"""Incremental refresh, parts of buckets, reads over holes, streamed deltas and the tree of rollups."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import chronofold as cf
from chronofold import RollupSpec, SpecError, TableError, TableSpec
from chronofold.rollups import coverage
from chronofold.rollups.rollup import add_batch, fold
from chronofold.rollups.states import mergeable
from chronofold.sources.manifest import Table
from tests.test_rollups import _files, _incoming, hourly, same, series

AGGS = {
    "total": "sum(value)",
    "n": "count(*)",
    "low": "min(value)",
    "high": "max(value)",
    "average": "avg(value)",
    "first": "min_by(value, time)",
    "last": "max_by(value, time)",
}


def rolled(rows, width="1 hour"):
    return cf.bucket_by(rows, width, "time", AGGS, keys=["device_id"])


def later(rows, minutes):
    """Rows at times that no other rows have, so that the first and the last of a bucket are no ties."""
    return rows.withColumn("time", F.timestamp_add("MINUTE", F.lit(minutes), F.col("time")))


def data_files(spark, path):
    return {f.split("/data/")[1] for f in cf.scan(spark, path).inputFiles()}


@pytest.fixture
def raw(spark, tmp_path):
    path = str(tmp_path / "raw")
    cf.create_hypertable(series(spark, 600), path, TableSpec("time", chunk="1 day"))
    return path


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "hourly")


# --- coverage -------------------------------------------------------------------------------------------------------


def test_coverage_against_single_points():
    rng = random.Random(1)
    for _ in range(200):
        covered, versions = (), {}
        for version in range(1, 8):
            a, b = sorted(rng.sample(range(41), 2))
            covered = coverage.with_stretch(covered, a, b, version)
            versions.update(dict.fromkeys(range(a, b), version))
        assert {p: v for a, b, v in covered for p in range(a, b)} == versions
        assert all(x[1] <= y[0] and (x[1] < y[0] or x[2] != y[2]) for x, y in zip(covered, covered[1:]))
        changes = [(c, c + rng.randint(1, 5), rng.randint(1, 8)) for c in rng.sample(range(40), 4)]
        low, high = sorted(rng.sample(range(41), 2))
        wanted = {p for p in range(low, high) if p not in versions or any(c <= p < d and v > versions[p] for c, d, v in changes)}
        assert {p for a, b in coverage.stale(covered, low, high, changes) for p in range(a, b)} == wanted
        some = coverage.union((c, d) for c, d, _ in changes)
        assert {p for a, b in coverage.intersection(some, [(low, high)]) for p in range(a, b)} == {
            p for p in range(low, high) if any(c <= p < d for c, d, _ in changes)
        }


def test_long_histories_stay_bounded_and_safe():
    covered = ()
    for k in range(1000):
        covered = coverage.with_stretch(covered, k, k + 1, k + 1)
    assert len(covered) <= coverage.LIMIT
    assert all(v <= a + 1 for a, b, v in covered) and covered[0][0] == 0 and covered[-1][1] == 1000
    many = [(3 * k, 3 * k + 1) for k in range(200)]
    few = coverage.fewer(many, 10)
    assert len(few) == 10 and all(any(a <= c and d <= b for a, b in few) for c, d in many)


# --- which aggregates merge -------------------------------------------------------------------------------------------


def test_only_plain_aggregates_have_states(spark):
    rows = series(spark, 1)
    good = {"a": "sum(value + 1)", "b": "COUNT(value)", "c": "max_by(concat(device_id, ','), time)", "d": "avg(if(value > 1, value, 0))", "e": "count(*)"}
    assert mergeable(good, rows).keys() == good.keys()
    assert mergeable(good, rows)["c"].args == ("concat(device_id, ',')", " time")
    for text in ("sum(value) + 1", "sum(value) / sum(value)", "count(DISTINCT device_id)", "percentile(value, 0.5)", "sum(value) FILTER (WHERE value > 1)", "avg(time)", "count(nothing)"):
        assert mergeable({"x": text}, rows) is None


# --- incremental refresh ------------------------------------------------------------------------------------------------


def test_an_unchanged_source_writes_nothing(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    before, version = data_files(spark, path), Table.at(spark, path).state.version
    cf.refresh(spark, path, incremental=True)
    cf.refresh(spark, path, "2026-06-02", "2026-06-04", incremental=True)
    cf.reorder(spark, raw, ["device_id"])  # rewrites every file, changes no row
    cf.refresh(spark, path, incremental=True)
    assert data_files(spark, path) == before and Table.at(spark, path).state.version == version


def test_only_chunks_with_late_rows_are_computed_again(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, aggs=AGGS), with_data=True)
    before = data_files(spark, path)
    late = later(series(spark, 20, 160).withColumn("value", F.col("value") * 3), 4)  # inside 2026-06-02
    cf.append(late, raw)
    cf.refresh(spark, path, incremental=True)
    after = data_files(spark, path)
    assert len(before - after) == 1 and len(after - before) >= 1
    assert same(cf.read_rollup(spark, path), rolled(series(spark, 600).unionByName(late)))


def test_late_rows_outside_the_window_wait_for_theirs(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, aggs=AGGS), with_data=True)
    one, two = later(series(spark, 3, 10), 1), later(series(spark, 3, 400), 2)
    cf.append(one, raw)
    cf.append(two, raw)
    cf.refresh(spark, path, "2026-06-03", None, incremental=True)
    assert same(cf.read_rollup(spark, path), rolled(series(spark, 600).unionByName(two)))
    cf.refresh(spark, path, incremental=True)
    assert same(cf.read_rollup(spark, path), rolled(series(spark, 600).unionByName(two).unionByName(one)))


def test_random_histories_equal_a_rollup_of_all_rows(spark, tmp_path):
    """Appends, refreshes of random windows, rewrites and retention in any order; at the end nothing is lost or doubled."""
    rng = random.Random(5)
    for trial in range(1):
        raw, path = str(tmp_path / f"raw{trial}"), str(tmp_path / f"wide{trial}")
        rows = series(spark, 300)
        cf.create_hypertable(rows, raw, TableSpec("time", chunk="1 day", segment_by="device_id", merge_up_to="4 days"))
        cf.create_rollup(spark, path, hourly(raw, width="30 hours", chunk="10 days", aggs=AGGS), with_data=True)
        for step in range(8):
            action = rng.choice(["append", "append", "window", "compress", "drop"])
            if action == "append":
                more = later(series(spark, rng.randint(5, 60), rng.randint(0, 900)).withColumn("value", F.col("value") + step / 8), step + 1)
                cf.append(more, raw)
                rows = rows.unionByName(more)
            elif action == "window":
                start = datetime(2026, 6, 1) + timedelta(hours=rng.randint(0, 100))
                cf.refresh(spark, path, start, start + timedelta(hours=rng.randint(20, 80)), incremental=rng.random() < 0.7)
            elif action == "compress":
                cf.compress_chunks(spark, raw, now=datetime(2026, 6, 1) + timedelta(days=rng.randint(1, 9)))
            else:
                # What goes has to be taken in before, as a schedule would have it.
                cf.refresh(spark, path, incremental=True)
                cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 2) + timedelta(days=rng.randint(0, 4)))
        cf.refresh(spark, path, incremental=True)
        assert same(cf.read_rollup(spark, path), rolled(rows, "30 hours"))
        cf.refresh(spark, path)
        assert same(cf.read_rollup(spark, path), rolled(rows, "30 hours"))


def test_stacked_rollups_refresh_incrementally(spark, raw, path):
    daily = path + "-daily"
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    cf.create_rollup(spark, daily, RollupSpec(path, "bucket", "1 day", {"total": "sum(total)", "n": "sum(n)"}, bucket="day", chunk="1 day"), with_data=True)
    before = data_files(spark, daily)
    late = series(spark, 6, 160)
    cf.append(late, raw)
    assert cf.refresh_tree(spark, [path], incremental=True, cascade=True) == [path, daily]
    assert len(before - data_files(spark, daily)) == 1
    wanted = cf.bucket_by(series(spark, 600).unionByName(late), "1 day", "time", {"total": "sum(value)", "n": "count(*)"}, bucket="day")
    assert same(cf.read_rollup(spark, daily), wanted)


# --- buckets cut by retention -----------------------------------------------------------------------------------------


def test_rows_are_added_to_a_bucket_that_retention_cuts(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, width="5 days", aggs=AGGS, chunk="30 days"), with_data=True)
    cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 4))
    more = later(series(spark, 500, 200).withColumn("value", F.col("value") - 1000), 5)  # in dropped and in live days
    cf.append(more, raw)
    for incremental in (True, False):
        cf.refresh(spark, path, incremental=incremental)
        assert same(cf.read_rollup(spark, path), rolled(series(spark, 600).unionByName(more), "5 days"))
    # The late rows of dropped days go with the next retention, their sums stay.
    cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 4))
    cf.refresh(spark, path)
    assert same(cf.read_rollup(spark, path), rolled(series(spark, 600).unionByName(more), "5 days"))


def test_aggregates_that_do_not_merge_raise_and_name_the_bucket(spark, raw, path):
    spec = hourly(raw, width="5 days", aggs={"middle": "percentile(value, 0.5)"}, chunk="30 days")
    cf.create_rollup(spark, path, spec, with_data=True)
    complete = sorted(cf.read_rollup(spark, path).collect())
    cf.drop_chunks(spark, raw, older_than="1 day", now=datetime(2026, 6, 4))
    cf.refresh(spark, path)
    assert sorted(cf.read_rollup(spark, path).collect()) == complete
    start = complete[0]["bucket"]
    cf.append(series(spark, 10, 500), raw)
    with pytest.raises(TableError, match=str(start)[:10]):
        cf.refresh(spark, path)


# --- reads over holes ---------------------------------------------------------------------------------------------------


def test_reads_over_holes(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, aggs=AGGS))
    everything = series(spark, 600)
    assert same(cf.read_rollup(spark, path, holes=True), rolled(everything))
    cf.refresh(spark, path, "2026-06-02", "2026-06-02T12:00:00")
    cf.refresh(spark, path, "2026-06-04", "2026-06-04T05:00:00")
    late = later(series(spark, 10, 160), 3)
    cf.append(late, raw)
    found = cf.read_rollup(spark, path, holes=True)
    assert same(found, rolled(everything.unionByName(late)))
    # What is materialized and has not changed comes from the rollup alone.
    one = cf.read_rollup(spark, path, start="2026-06-04T01:00:00", end="2026-06-04T04:00:00", holes=True)
    assert not [f for f in one.inputFiles() if "/raw/" in f]
    ranged = "time >= '2026-06-02 10:00:00' AND time < '2026-06-04 02:00:00'"
    some = cf.read_rollup(spark, path, start="2026-06-02T10:00:00", end="2026-06-04T02:00:00", holes=True)
    assert same(some, rolled(everything.unionByName(late).where(ranged)))


# --- streamed deltas ----------------------------------------------------------------------------------------------------


def test_deltas_are_added_and_folded(spark, tmp_path, path):
    raw, folder, checkpoint = (str(tmp_path / name) for name in ("raw", "in", "ck"))
    cf.create_hypertable(series(spark, 0), raw, TableSpec("time", chunk="1 day"))
    cf.create_rollup(spark, path, hourly(raw, aggs=AGGS, compress_after="1 day"))
    late = later(series(spark, 30, 50).withColumn("value", F.lit(500.0)), 6)
    frames = [series(spark, 200), series(spark, 200, 200).unionByName(late), series(spark, 200, 400)]
    seen = set()
    for k, frame in enumerate(frames):
        _files(spark, [frame], folder)
        cf.stream_rollup(_incoming(spark, folder, series(spark, 1).schema), path, checkpoint, deltas=True).awaitTermination()
        now = {f.split("/data/")[1] for f in cf.read_rollup(spark, path).inputFiles()}
        assert seen <= now  # no file of an earlier batch was written again
        seen = now
    everything = series(spark, 600).unionByName(late)
    assert same(cf.read_rollup(spark, path), rolled(everything))
    ranged = cf.read_rollup(spark, path, start="2026-06-01T08:00:00", end="2026-06-02")
    assert same(ranged, rolled(everything.where("time >= '2026-06-01 08:00:00' AND time < '2026-06-02'")))
    assert cf.scan(spark, path).count() > rolled(everything).count()
    cf.compress_chunks(spark, path, now=datetime(2026, 7, 1))
    assert not Table.at(spark, path).state.split
    assert same(cf.scan(spark, path), rolled(everything))


def test_a_replayed_delta_replaces_itself(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, aggs=AGGS))
    first, second = series(spark, 100), later(series(spark, 100, 50), 7)
    add_batch(spark, path, first, "s", 0)
    add_batch(spark, path, second, "s", 1)
    add_batch(spark, path, second, "s", 1)
    assert same(cf.read_rollup(spark, path), rolled(first.unionByName(second)))
    fold(spark, path)
    add_batch(spark, path, second, "s", 1)
    assert same(cf.read_rollup(spark, path), rolled(first.unionByName(second)))
    # A refresh takes the source for the truth.
    cf.refresh(spark, path)
    assert same(cf.read_rollup(spark, path), rolled(series(spark, 600)))


def test_deltas_need_states(spark, raw, path):
    cf.create_rollup(spark, path, hourly(raw, aggs={"middle": "percentile(value, 0.5)"}))
    with pytest.raises(SpecError):
        add_batch(spark, path, series(spark, 5), "s", 0)


# --- the tree of rollups ------------------------------------------------------------------------------------------------


def test_redefine_and_drop_follow_the_tree(spark, raw, path):
    daily, weekly, other = (f"{path}-{name}" for name in ("daily", "weekly", "other"))
    cf.create_rollup(spark, path, hourly(raw), with_data=True)
    cf.create_rollup(spark, daily, RollupSpec(path, "bucket", "1 day", {"n": "sum(n)"}, bucket="day"), with_data=True)
    cf.create_rollup(spark, weekly, RollupSpec(daily, "day", "7 days", {"n": "sum(n)"}, bucket="week"), with_data=True)
    cf.create_rollup(spark, other, hourly(raw), with_data=True)
    assert cf.dependents_of(spark, path) == [daily, weekly]
    assert sorted(cf.dependents_of(spark, raw)) == sorted([path, daily, weekly, other])
    assert cf.redefine(spark, path, hourly(raw, where="device_id <> 'd0'"))
    kept = series(spark, 600).where("device_id <> 'd0'")
    assert same(cf.read_rollup(spark, weekly), cf.bucket_by(kept, "7 days", "time", {"n": "count(*)"}, bucket="week"))
    with pytest.raises(SpecError):
        cf.redefine(spark, path, hourly(raw, bucket="hour"))
    with pytest.raises(TableError, match="weekly"):
        cf.drop_rollups(spark, [path, daily])
    assert cf.read_rollup(spark, weekly).count() > 0
    assert cf.drop_rollups(spark, [path], cascade=True) == [weekly, daily, path]
    assert cf.dependents_of(spark, raw) == [other]
