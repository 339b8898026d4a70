"""Chunked tables: layout, pruning and every maintenance job, on whole driver tables and small hand-made ones."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import chronofold as cf
from chronofold import RebuildRefused, TableError, TableSpec
from chronofold.sources.hypertable import with_chunk_columns, write_generation
from chronofold.sources.manifest import Table

NOW = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def hours(spark, n, first=0):
    """n rows, one per hour from 2026-06-01, with a source and a value."""
    ids = spark.range(first, first + n)
    return ids.select(
        F.timestamp_add("HOUR", "id", F.lit("2026-06-01").cast("timestamp")).alias("time"),
        F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"),
        F.concat(F.lit("d"), (F.col("id") % 4).cast("string")).alias("device"),
        F.col("id").cast("double").alias("value"),
    )


def files_of(df):
    return df.select(F.input_file_name().alias("f")).distinct().count()


def same_rows(left, right):
    return cf.checksum(left) == cf.checksum(right)


def chunk_count(spark, path, **flags):
    report = cf.layout(spark, path)
    for name, value in flags.items():
        report = report.where(F.col(name) == value)
    return report.count()


def test_convert_keeps_every_row(spark, table_path):
    plain = hours(spark, 100)
    cf.convert(plain, table_path, TableSpec("time", chunk="1 day"))
    assert same_rows(cf.scan(spark, table_path), plain)
    assert chunk_count(spark, table_path) == 5
    report = cf.layout(spark, table_path).orderBy("chunk_start").first()
    assert (report.rows, report.files, report.compressed) == (24, 1, False)
    assert (report.chunk_start, report.chunk_end) == (datetime(2026, 6, 1), datetime(2026, 6, 2))
    assert (report.min_time, report.max_time) == (datetime(2026, 6, 1), datetime(2026, 6, 1, 23))
    assert report.bytes > 0


def test_a_populated_table_is_refused_without_migration(spark, table_path):
    spec = TableSpec("time", chunk="1 day", migrate_data=False)
    with pytest.raises(TableError):
        cf.convert(hours(spark, 10), table_path, spec)
    cf.convert(hours(spark, 0), table_path, spec)
    assert cf.scan(spark, table_path).count() == 0
    cf.append(hours(spark, 10), table_path)
    assert cf.scan(spark, table_path).count() == 10


def test_a_row_without_a_time_fails(spark, table_path):
    df = hours(spark, 3).withColumn("time", F.when(F.col("value") != 1, F.col("time")))
    with pytest.raises(Exception, match="needs a time in every row"):
        cf.create_hypertable(df, table_path, TableSpec("time"))
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    assert cf.scan(spark, table_path).count() == 3


def test_a_folder_holds_one_table(spark, table_path):
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    with pytest.raises(TableError):
        cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    with pytest.raises(TableError):
        cf.scan(spark, table_path + "-other")


def test_append_checks_columns(spark, table_path):
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    with pytest.raises(TableError):
        cf.append(hours(spark, 3).drop("source"), table_path)
    cf.append(hours(spark, 3, 3).select("value", "time", "device", "source"), table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 6))


def test_two_writers_do_not_both_publish(spark, table_path):
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    table = Table.at(spark, table_path)
    cf.append(hours(spark, 3, 3), table_path)
    with pytest.raises(TableError, match="another writer"):
        table.publish()
    with pytest.raises(TableError, match="another writer"):
        table.write_chunks(table.chunks())
    assert same_rows(cf.scan(spark, table_path), hours(spark, 6))


def test_overlapping_writers_do_not_touch_each_others_files(spark, table_path):
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    first, second = Table.at(spark, table_path), Table.at(spark, table_path)
    written = []
    for table, rows in ((first, hours(spark, 3, 3)), (second, hours(spark, 5, 20))):
        chunks = write_generation(table, with_chunk_columns(rows, table.state), table.state.layout)
        written.append(table.write_chunks(table.chunks().unionByName(chunks)))
    assert [rows.agg(F.sum("rows")).first()[0] for rows in written] == [6, 8]
    keys = [f"0/{row['gen']}" for row in written[0].select("gen").distinct().collect()]
    first.publish(new_chunks=True, folders={key: (1, 1) for key in keys})
    with pytest.raises(TableError, match="another writer"):
        second.publish(new_chunks=True)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 6))
    cf.append(hours(spark, 1, 6), table_path)
    cf.append(hours(spark, 1, 7), table_path)
    with pytest.raises(TableError, match="another writer"):
        second.publish(new_chunks=True)  # its version is deleted by now
    cf.purge(spark, table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 8))
    assert spark.read.parquet(table_path + "/data/L0").count() == 8


def test_folders_without_a_run_stay_readable(spark, table_path):
    cf.create_hypertable(hours(spark, 30), table_path, TableSpec("time", chunk="1 day"))
    table = Table.at(spark, table_path)
    for name, plain in ((table.generation(0, 1), "data/L0/_gen=1"), (table.chunks_folder(1), "manifest/chunks-00000001")):
        source = spark.read.parquet(f"{table_path}/{name}")
        parts = [c for c in ("_chunk", "_until") if c in source.columns]
        source.write.mode("append").partitionBy(*parts).parquet(f"{table_path}/{plain}")
        table.folder.delete(name)
    state = json.loads(table.folder.read_text("manifest/state-00000001.json"))
    del state["runs"]
    table.folder.delete("manifest/state-00000001.json")
    table.folder.publish_text("manifest/state-00000001.json", json.dumps(state))
    cf.append(hours(spark, 10, 30), table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 40))
    assert cf.scan(spark, table_path, end="2030-01-01").count() == 40
    cf.purge(spark, table_path)
    cf.reorder(spark, table_path, ["value"])
    assert same_rows(cf.scan(spark, table_path), hours(spark, 40))


def test_ranges_of_columns_without_minima_filter_rows(spark, table_path):
    cf.create_hypertable(hours(spark, 6), table_path, TableSpec("time"))
    found = cf.scan(spark, table_path, ranges={"device": ("a", "m"), "value": (1.5, 4.5)})
    assert same_rows(found, hours(spark, 6).where("device >= 'a' AND device < 'm' AND value >= 1.5 AND value < 4.5"))


def test_time_range_opens_only_its_chunks(spark, events, table_path):
    cf.create_hypertable(events, table_path, TableSpec("ts", chunk="1 day"))
    found = cf.scan(spark, table_path, start="2024-01-05T12:00:00", end="2024-01-08")
    assert same_rows(found, events.where("ts >= '2024-01-05 12:00:00' AND ts < '2024-01-08'"))
    assert files_of(found) == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_chunk" in plan
    assert "GreaterThanOrEqual(ts" in plan
    assert cf.scan(spark, table_path, start="2030-01-01").count() == 0


@pytest.mark.parametrize("user", [1, 7, 11])
def test_hash_dimension_opens_one_bucket(spark, events, table_path, user):
    cf.create_hypertable(events, table_path, TableSpec("ts", chunk="30 days", dims={"user_id": 4, "event_type": 2}))
    assert cf.layout(spark, table_path).select("hash_buckets").distinct().count() == 8
    found = cf.scan(spark, table_path, equals={"user_id": user})
    assert same_rows(found, events.where(F.col("user_id") == user))
    chunks = cf.layout(spark, table_path).select("chunk_start").distinct().count()
    assert files_of(cf.scan(spark, table_path)) == chunks * 8
    assert len(found.inputFiles()) == chunks * 2


def test_projection_reaches_the_files(spark, events, table_path):
    cf.create_hypertable(events, table_path, TableSpec("ts", chunk="7 days"))
    plan = cf.scan(spark, table_path).groupBy("event_type").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan


@pytest.mark.parametrize("width", ["1 month", "1 year", "36:00:00"])
def test_other_chunk_widths(spark, sf_dir, table_path, width):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    cf.create_hypertable(orders, table_path, TableSpec("o_orderdate", chunk=width))
    assert same_rows(cf.scan(spark, table_path), orders)
    expected = cf.bucket_by(orders, width, "o_orderdate", {"n": "count(*)"}).collect()
    report = cf.layout(spark, table_path).select("chunk_start", "rows").collect()
    assert sorted(map(tuple, report)) == sorted(map(tuple, expected))


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_integer_time(spark, table_path, kind):
    df = spark.range(0, 1000).select((F.col("id") - 500).cast(kind).alias("tick"), "id")
    cf.create_hypertable(df, table_path, TableSpec("tick", chunk=100, drop_after=200))
    assert cf.scan(spark, table_path, start=-450, end=-350).count() == 100
    with pytest.raises(TableError):
        cf.drop_chunks(spark, table_path)
    with pytest.raises(TableError):
        cf.drop_chunks(spark, table_path, now=NOW)
    cf.drop_chunks(spark, table_path, now=250)
    # Chunks that end at or before 50: up to [-100, 0).
    assert cf.scan(spark, table_path).agg(F.min("tick"), F.count("*")).first() == (0, 500)


def test_a_time_table_needs_a_time_as_now(spark, table_path):
    cf.create_hypertable(hours(spark, 3), table_path, TableSpec("time"))
    with pytest.raises(TableError):
        cf.drop_chunks(spark, table_path, older_than="1 day", now=5)


def test_date_column_as_time(spark, table_path):
    df = hours(spark, 100).withColumn("day", F.to_date("time"))
    cf.create_hypertable(df, table_path, TableSpec("day", chunk="2 days"))
    assert cf.scan(spark, table_path, start="2026-06-02", end="2026-06-04").count() == 48
    assert same_rows(cf.scan(spark, table_path), df)


def test_a_hot_chunk_and_bucket_is_written_by_many_tasks(spark, table_path):
    """One device on one day holds most rows; the write must split it, and no row may be lost."""
    hot = spark.range(0, 300_000, 1, 8).select(
        F.timestamp_add("SECOND", F.col("id") % 80_000, F.lit("2026-06-01").cast("timestamp")).alias("time"),
        F.lit("d0").alias("device"),
        F.xxhash64("id").alias("noise"),
    )
    cold = hours(spark, 100).select("time", "device", F.xxhash64("value").alias("noise"))
    rows = hot.unionByName(cold)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", dims={"device": 4}, segment_by="device"))
        hottest = cf.layout(spark, table_path).orderBy(F.desc("rows")).first()
        assert hottest.files > 4
        cf.compress_chunks(spark, table_path)
        hottest = cf.layout(spark, table_path).orderBy(F.desc("rows")).first()
        assert hottest.files > 1 and hottest.compressed
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert same_rows(cf.scan(spark, table_path), rows)


# --- columnstore ----------------------------------------------------------------------------------------------------

COLUMNSTORE = TableSpec("time", chunk="1 day", segment_by=["source"], order_by=["time DESC"])


def test_compress_one_then_disable(spark, table_path):
    rows = hours(spark, 100)
    cf.create_hypertable(rows, table_path, COLUMNSTORE)
    cf.compress_chunks(spark, table_path, older_than="1 day", now=datetime(2026, 6, 3))
    assert chunk_count(spark, table_path, compressed=True) == 1
    assert same_rows(cf.scan(spark, table_path), rows)
    before = Table.at(spark, table_path).state.version
    cf.compress_chunks(spark, table_path, older_than="1 day", now=datetime(2026, 6, 3))
    assert Table.at(spark, table_path).state.version == before
    cf.alter(spark, table_path, TableSpec("time", chunk="1 day"))
    assert chunk_count(spark, table_path, compressed=True) == 0
    assert same_rows(cf.scan(spark, table_path), rows)
    with pytest.raises(TableError):
        cf.compress_chunks(spark, table_path)


def test_compressed_files_are_clustered(spark, table_path):
    cf.create_hypertable(hours(spark, 96).orderBy(F.rand(1)), table_path, COLUMNSTORE)
    cf.compress_chunks(spark, table_path)
    for file in cf.scan(spark, table_path).inputFiles():
        got = [(r.source, -r.time.timestamp()) for r in spark.read.parquet(file).coalesce(1).collect()]
        assert got == sorted(got)
        assert file.endswith("zstd.parquet")


def test_disable_without_decompressing(spark, table_path):
    spec = TableSpec(**{**COLUMNSTORE.to_dict(), "auto_decompress": False})
    cf.create_hypertable(hours(spark, 50), table_path, spec)
    cf.compress_chunks(spark, table_path)
    off = TableSpec("time", chunk="1 day", auto_decompress=False)
    with pytest.raises(TableError):
        cf.alter(spark, table_path, off)
    cf.decompress(spark, table_path, auto=True)
    cf.alter(spark, table_path, off)
    assert not cf.describe(spark, table_path).columnstore
    assert cf.scan(spark, table_path).count() == 50


def test_merging_never_exceeds_the_span(spark, table_path):
    rows = hours(spark, 24 * 20)
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", columnstore=True, merge_up_to="3 days"))
    cf.compress_chunks(spark, table_path, older_than="0 days", now=datetime(2026, 6, 9))
    report = cf.layout(spark, table_path).orderBy("chunk_start").collect()
    assert max(r.chunk_end - r.chunk_start for r in report) == timedelta(days=3)
    assert all(a.chunk_end == b.chunk_start for a, b in zip(report, report[1:]))
    assert same_rows(cf.scan(spark, table_path), rows)
    # Days compressed alone join their span once all of it is old enough.
    cf.compress_chunks(spark, table_path, older_than="0 days", now=datetime(2026, 6, 18))
    later = cf.layout(spark, table_path).orderBy("chunk_start").collect()
    assert len(later) < len(report)
    assert max(r.chunk_end - r.chunk_start for r in later) == timedelta(days=3)
    assert same_rows(cf.scan(spark, table_path), rows)
    cf.drop_chunks(spark, table_path, older_than="1 day", now=datetime(2026, 6, 5))
    left = cf.scan(spark, table_path)
    first = cf.layout(spark, table_path).agg(F.min("chunk_start")).first()[0]
    assert same_rows(left, rows.where(F.col("time") >= F.lit(first)))


def test_chunk_widths_of_two_kinds_are_merged_without_loss(spark, table_path):
    cf.create_hypertable(hours(spark, 100), table_path, TableSpec("time", chunk="5 days", columnstore=True, merge_up_to="7 days"))
    cf.alter(spark, table_path, TableSpec("time", chunk="1 day", columnstore=True, merge_up_to="7 days"))
    cf.append(hours(spark, 300, 100), table_path)
    cf.compress_chunks(spark, table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 400))
    assert max(r.chunk_end - r.chunk_start for r in cf.layout(spark, table_path).collect()) <= timedelta(days=7)
    cf.decompress(spark, table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 400))


def test_chunk_skipping(spark, events, table_path):
    spec = TableSpec("ts", chunk="1 day", columnstore=True)
    cf.create_hypertable(events, table_path, spec)
    cf.enable_chunk_skipping(spark, table_path, "event_id")
    wanted = events.where("event_id >= 100 AND event_id < 150")
    every = files_of(cf.scan(spark, table_path))
    assert len(cf.scan(spark, table_path, ranges={"event_id": (100, 150)}).inputFiles()) == every
    cf.compress_chunks(spark, table_path)
    found = cf.scan(spark, table_path, ranges={"event_id": (100, 150)})
    assert len(found.inputFiles()) < 5
    assert same_rows(found, wanted)
    assert cf.scan(spark, table_path, ranges={"event_id": (None, 10)}).count() == events.where("event_id < 10").count()
    cf.disable_chunk_skipping(spark, table_path, "event_id")
    again = cf.scan(spark, table_path, ranges={"event_id": (100, 150)})
    assert len(again.inputFiles()) == every
    assert same_rows(again, wanted)
    for wrong in ("value", "event_type", "missing"):
        with pytest.raises((ValueError, TableError)):
            cf.enable_chunk_skipping(spark, table_path, wrong)


def test_skip_column_of_nulls_hides_no_row(spark, table_path):
    df = hours(spark, 48).withColumn("seq", F.lit(None).cast("bigint"))
    cf.create_hypertable(df, table_path, TableSpec("time", chunk="1 day", columnstore=True, skip_columns=["seq"]))
    cf.compress_chunks(spark, table_path)
    assert cf.scan(spark, table_path, ranges={"seq": (0, 5)}).count() == 0
    assert cf.scan(spark, table_path).count() == 48


# --- retention and reorder ------------------------------------------------------------------------------------------


def test_retention_drops_whole_chunks_only(spark, events, table_path):
    cf.create_hypertable(events, table_path, TableSpec("ts", chunk="1 day", drop_after=(7, "day")))
    cf.drop_chunks(spark, table_path, now=datetime(2024, 1, 31, 12))
    assert same_rows(cf.scan(spark, table_path), events.where("ts >= '2024-01-24'"))
    stored = spark.read.parquet(table_path + "/data/L0").select("event_id", "ts")
    assert stored.count() == cf.scan(spark, table_path).count()
    cf.drop_chunks(spark, table_path, now=datetime(2024, 1, 31, 12))
    assert cf.scan(spark, table_path).count() == stored.count()
    with pytest.raises(ValueError):
        cf.drop_chunks(spark, table_path, older_than="0 days", now=NOW)


def test_reorder_clusters_uncompressed_chunks(spark, table_path):
    rows = hours(spark, 96).orderBy(F.rand(2))
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", reorder_by=["device", "time"]))
    cf.reorder(spark, table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 96))
    for file in cf.scan(spark, table_path).inputFiles():
        got = [(r.device, r.time) for r in spark.read.parquet(file).coalesce(1).collect()]
        assert got == sorted(got)


# --- changes of the whole table -------------------------------------------------------------------------------------


def test_back_to_plain_and_again(spark, table_path):
    rows = hours(spark, 50, 1)
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", dims={"device": 2}))
    plain = table_path + "-plain"
    cf.to_plain(spark, table_path, plain, drop_source=True)
    stored = spark.read.parquet(plain)
    assert stored.columns == rows.columns
    assert stored.agg(F.count("*"), F.sum("value")).first() == (50, 1275.0)
    cf.convert(stored, table_path, TableSpec("time", chunk="1 day"))
    assert cf.scan(spark, table_path).agg(F.count("*"), F.sum("value")).first() == (50, 1275.0)


def test_change_of_the_time_column(spark, table_path):
    rows = hours(spark, 40, 1).withColumn("recorded_at", F.timestamp_add("MINUTE", F.lit(1), F.col("time")))
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day"))
    assert cf.alter(spark, table_path, TableSpec("recorded_at", chunk="1 day")) == ["rebuild"]
    assert same_rows(cf.scan(spark, table_path), rows)
    found = cf.scan(spark, table_path, start="2026-06-01T02:01:00", end="2026-06-01T05:01:00")
    assert sorted(r.value for r in found.collect()) == [2.0, 3.0, 4.0]


@pytest.mark.parametrize("dims", [{}, {"device": 2}])
def test_drop_or_resize_a_dimension(spark, table_path, dims):
    rows = hours(spark, 60, 1)
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", dims={"device": 4}))
    new = TableSpec("time", chunk="1 day", dims=dims)
    with pytest.raises(RebuildRefused):
        cf.alter(spark, table_path, TableSpec(**{**new.to_dict(), "rebuild_data": False}))
    with pytest.raises(RebuildRefused):
        cf.to_plain(spark, table_path, table_path + "-p", rebuild_data=False)
    cf.alter(spark, table_path, new)
    assert cf.scan(spark, table_path).agg(F.count("*"), F.sum("value")).first() == (60, 1830.0)
    assert cf.describe(spark, table_path).dims == dims
    assert same_rows(cf.scan(spark, table_path, equals={"device": "d1"}), rows.where("device = 'd1'"))


def test_add_a_dimension_in_place(spark, table_path):
    cf.create_hypertable(hours(spark, 60, 1), table_path, TableSpec("time", chunk="1 day"))
    files = set(cf.scan(spark, table_path).inputFiles())
    assert cf.alter(spark, table_path, TableSpec("time", chunk="1 day", dims={"device": 4})) == ["set_spec"]
    assert set(cf.scan(spark, table_path).inputFiles()) == files
    cf.append(hours(spark, 60, 61), table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 120, 1))
    found = cf.scan(spark, table_path, equals={"device": "d3"})
    assert same_rows(found, hours(spark, 120, 1).where("device = 'd3'"))
    assert files <= set(found.inputFiles())
    cf.alter(spark, table_path, TableSpec("time", chunk="1 day", dims={"device": 4}, segment_by="source"))
    cf.compress_chunks(spark, table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 120, 1))


def test_chunk_width_applies_to_later_chunks(spark, table_path):
    cf.create_hypertable(hours(spark, 100), table_path, TableSpec("time", chunk="1 day"))
    cf.alter(spark, table_path, TableSpec("time", chunk="7 days"))
    assert cf.describe(spark, table_path).chunk == "7 days"
    assert chunk_count(spark, table_path) == 5
    cf.append(hours(spark, 100, 100), table_path)
    widths = {r.chunk_end - r.chunk_start for r in cf.layout(spark, table_path).collect()}
    assert widths == {timedelta(days=1), timedelta(days=7)}
    assert same_rows(cf.scan(spark, table_path), hours(spark, 200))
    found = cf.scan(spark, table_path, start="2026-06-04", end="2026-06-06")
    assert same_rows(found, hours(spark, 200).where("time >= '2026-06-04' AND time < '2026-06-06'"))


def test_full_round_trip(spark, table_path):
    """Everything on, then everything off; the second change finds nothing to do."""
    full = TableSpec(
        "time",
        chunk="1 day",
        dims={"device": 4},
        segment_by=["device"],
        order_by=["time DESC"],
        compress_after="7 days",
        drop_after="90 days",
        reorder_by=["device", "time"],
    )
    cf.create_hypertable(hours(spark, 48, 1), table_path, full)
    cf.reorder(spark, table_path)
    cf.compress_chunks(spark, table_path, now=datetime(2026, 7, 1))
    bare = TableSpec("time", chunk="1 day")
    assert cf.alter(spark, table_path, bare) == ["rebuild"]
    assert cf.alter(spark, table_path, bare) == []
    assert cf.scan(spark, table_path).agg(F.count("*"), F.sum("value")).first() == (48, 1176.0)


def test_purge_removes_unfinished_work_and_keeps_live_rows(spark, table_path):
    cf.create_hypertable(hours(spark, 48), table_path, TableSpec("time", chunk="1 day"))
    cf.reorder(spark, table_path, ["value"], purge=False)
    first = spark.read.parquet(table_path + "/data/L0/_gen=1").count()
    assert first == 48
    cf.purge(spark, table_path)
    assert spark.read.parquet(table_path + "/data/L0").count() == 48
    # A job that died leaves a generation that no manifest names: readers ignore it, the next job replaces it.
    spark.read.parquet(table_path + "/data/L0/_gen=2").write.partitionBy("_chunk", "_until").parquet(table_path + "/data/L0/_gen=3")
    assert cf.scan(spark, table_path).count() == 48
    cf.append(hours(spark, 10, 48), table_path)
    assert same_rows(cf.scan(spark, table_path), hours(spark, 58))


def test_files_of_a_large_chunk_have_key_ranges_of_their_own(spark, table_path):
    rows = spark.range(20_000).select(
        F.timestamp_add("SECOND", F.col("id"), F.lit("2026-06-01").cast("timestamp")).alias("time"),
        F.concat(F.lit("k"), F.lpad((F.hash("id") % 500).cast("string"), 4, "0")).alias("key"),
    )
    cf.create_hypertable(rows, table_path, TableSpec("time", chunk="1 day", segment_by="key", order_by=["time"]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cf.compress_chunks(spark, table_path)
        cf.append(rows, table_path)
        cf.reorder(spark, table_path, ["key", "time"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = cf.scan(spark, table_path).select("key", "time", F.col("_metadata.file_path").alias("file"))
    key = F.struct("key", "time")
    ranges = stored.groupBy("file").agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    for part in ("c000.zstd", "c000.snappy"):  # compressed, reordered
        mine = sorted((r["low"], r["high"]) for r in ranges if part in r["file"])
        assert len(mine) >= 3 and all(a[1] < b[0] for a, b in zip(mine, mine[1:]))
    assert stored.count() == 40_000
