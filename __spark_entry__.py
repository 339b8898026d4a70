"""

Queries that exercise stored tables write them to a new scratch folder (the cluster's shared checkpoint folder where
``spark.checkpoint.dir`` names one) and return what they read back. All queries run over whole tables.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import chronofold as cf  # noqa: E402
from chronofold import RollupSpec, TableSpec  # noqa: E402
from chronofold.sources.files import scratch_folder  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from chronofold.llm import queries as llm_queries  # noqa: E402
except ImportError:  # the training-data operators are an optional part
    corpus_pipeline = llm_queries = None

NOW = datetime(2024, 1, 31)
EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


# Moves averages and interpolated values off the exact ties (such as 0.5 / 2**8), which engines round differently.
NUDGE = 1.234e-9


def _rounded(df: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    """Double sums depend on the order of rows, so both sides of a comparison are rounded."""
    return df.withColumns({name: F.round(F.col(name) + F.lit(NUDGE), digits) for name in names})


# --- buckets, aggregates, histograms, ids ---------------------------------------------------------------------------


def bucket_hourly_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {
        "average": F.avg("value"),
        "first_value": cf.first_by("value", "ts"),
        "last_value": cf.last_by("value", "ts"),
        "low": F.min("value"),
        "high": F.max("value"),
        "n": F.count("*"),
    }
    return _rounded(cf.bucket_by(_events(spark, sf_dir), (1, "hour"), "ts", aggs), "average")


def bucket_text_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.bucket_by(_events(spark, sf_dir), "15 minutes", "ts", {"n": "count(*)"})


def bucket_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("event_id", cf.time_bucket("5 hours 30 minutes", "ts").alias("bucket"))


def bucket_timestamp_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    instants = _events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    out = cf.bucket_by(instants, "00:00:30.5", "ts", {"n": "count(*)"})
    return out.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


def bucket_week_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return cf.bucket_by(orders, "7 days", "day", {"n": "count(*)"}, bucket="week")


def _bucket_orders(spark: SparkSession, sf_dir: str, width) -> DataFrame:
    aggs = {"total": F.sum("o_totalprice"), "n": F.count("*")}
    return _rounded(cf.bucket_by(_table(spark, sf_dir, "orders"), width, "o_orderdate", aggs), "total", digits=2)


def bucket_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_orders(spark, sf_dir, (1, "month"))


def bucket_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_orders(spark, sf_dir, "3 months")


def bucket_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_orders(spark, sf_dir, (2, "year"))


def bucket_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = _events(spark, sf_dir).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return _rounded(cf.bucket_by(micros, 7_000_000_000, "us", {"n": "count(*)", "total": "sum(value)"}), "total", digits=2)


def bucket_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"average": "avg(value)", "n": "count(*)"}
    return _rounded(cf.bucket_by(_events(spark, sf_dir), "1 hour", "ts", aggs, keys=["event_type"]), "average")


def bucket_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.bucket_by(_events(spark, sf_dir), "7 hours", "ts", {"n": "count(*)"}, origin="2024-01-01T03:00:00")


def bucket_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _events(spark, sf_dir).createOrReplaceTempView("chronofold_events")
    cf.register(spark)
    return spark.sql(
        """
        SELECT time_bucket_ntz(INTERVAL 20 MINUTES, ts) AS bucket,
               time_bucket_month_ntz(INTERVAL 1 MONTH, max(ts)) AS month,
               max(time_bucket_date(INTERVAL 3 DAYS, cast(ts AS DATE))) AS days,
               max(time_bucket_int(1000, event_id)) AS ids,
               min_by(value, ts) AS first_value,
               max_by(value, ts) AS last_value
        FROM chronofold_events GROUP BY 1
        """
    )


def first_last_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return events.groupBy("user_id").agg(
        cf.first_by("event_type", "ts", tie_by="event_id").alias("first_type"),
        cf.last_by("event_type", "ts", tie_by="event_id").alias("last_type"),
        cf.first_by(F.when(F.col("value") > 20, F.col("value")), "ts").alias("first_above"),
    )


def histogram_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return events.groupBy("event_type").agg(cf.histogram("value", 5.0, 155.0, 10).alias("histogram"))


def histogram_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    return cf.histogram_by(events, [cf.time_bucket("6 hours", "ts").alias("bucket")], "value", 0.0, 100.0, 4)


def uuid7_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = cf.with_uuid7(_events(spark, sf_dir), "ts")
    return stamped.select("event_id", cf.uuid7_timestamp("id").cast("timestamp_ntz").alias("ts_ms"))


def uuid7_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = _events(spark, sf_dir).withColumn("id", cf.generate_uuid7())
    age = F.unix_seconds(F.current_timestamp()) - F.unix_seconds(cf.uuid7_timestamp("id"))
    return stamped.select(
        "event_id",
        F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("well_formed"),
        (F.abs(age) <= 1).alias("is_now"),
    )


# --- gap filling ----------------------------------------------------------------------------------------------------


def gapfill_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"average": "avg(value)", "n": "count(*)"}
    return _rounded(cf.gapfill(_events(spark, sf_dir), "6 hours", "ts", aggs, keys=["user_id"]), "average")


def gapfill_locf(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"latest": cf.last_by("value", "ts"), "n": F.count("*")}
    return cf.gapfill(_events(spark, sf_dir), "15 minutes", "ts", aggs, keys=["event_type"], locf=["latest"])


def gapfill_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"average": "avg(value)"}
    filled = cf.gapfill(_events(spark, sf_dir), "15 minutes", "ts", aggs, keys=["event_type"], interpolate=["average"])
    return _rounded(filled, "average")


def gapfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"high": F.max("value"), "low": F.min("value")}
    return _rounded(
        cf.gapfill(
            _events(spark, sf_dir),
            "1 hour",
            "ts",
            aggs,
            keys=["user_id"],
            start="2024-01-09T12:00:00",
            finish="2024-01-12",
            locf=["high"],
            interpolate=["low"],
        ),
        "low",
    )


def gapfill_long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series of more buckets than one block holds, and no key to split it by."""
    aggs = {"high": F.max("value"), "low": F.min("value"), "n": F.count("*")}
    filled = cf.gapfill(_events(spark, sf_dir), "20 seconds", "ts", aggs, locf=["high"], interpolate=["low"])
    return _rounded(filled, "low")


def gapfill_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"n": F.count("*"), "high": F.max("o_totalprice")}
    return cf.gapfill(_table(spark, sf_dir, "orders"), "1 month", "o_orderdate", aggs, keys=["o_custkey"], locf=["high"])


def daily_over_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = cf.bucket_by(_events(spark, sf_dir), "1 hour", "ts", {"average": "avg(value)"}, keys=["event_type"])
    return _rounded(cf.bucket_by(hourly, "1 day", "bucket", {"average": "avg(average)"}, bucket="day"), "average")


# --- chunked tables -------------------------------------------------------------------------------------------------

DAILY = TableSpec("ts", chunk="1 day")
THREE_DAYS = TableSpec("ts", chunk="3 days")
DAILY_BY_USER = TableSpec("ts", chunk=(3, "day"), dims={"user_id": 4})
COMPRESSIBLE = TableSpec(
    "ts",
    chunk="3 days",
    segment_by=["event_type"],
    order_by=["ts DESC"],
    skip_columns=["event_id"],
    compress_after="10 days",
    drop_after="7 days",
)


def _stored(spark: SparkSession, sf_dir: str, spec: TableSpec) -> str:
    path = scratch_folder(spark, "chronofold") + "/events"
    cf.create_hypertable(_events(spark, sf_dir), path, spec)
    return path


def scan_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.scan(spark, _stored(spark, sf_dir, THREE_DAYS), start="2024-01-05T06:00:00", end="2024-01-09")


def scan_hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.scan(spark, _stored(spark, sf_dir, DAILY_BY_USER), start="2024-01-04", equals={"user_id": 7})


def scan_skip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, COMPRESSIBLE)
    cf.compress_chunks(spark, path, now=NOW)
    return cf.scan(spark, path, ranges={"event_id": (1000, 2500)})


def integer_hypertable(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "chronofold") + "/series"
    series = _events(spark, sf_dir).select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    cf.create_hypertable(series, path, TableSpec("us", chunk=2 * 86_400_000_000))
    return cf.scan(spark, path, start=1_704_500_000_000_000, end=1_705_500_000_000_000)


def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    path = scratch_folder(spark, "chronofold") + "/events"
    cf.create_hypertable(events.where("ts < '2024-01-16'"), path, THREE_DAYS)
    cf.append(events.where("ts >= '2024-01-16'"), path)
    return cf.scan(spark, path)


def layout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = cf.layout(spark, _stored(spark, sf_dir, DAILY))
    return report.select("chunk_start", "chunk_end", "rows", "min_time", "max_time", "compressed")


def compressed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, COMPRESSIBLE)
    cf.compress_chunks(spark, path, now=NOW)
    return cf.scan(spark, path)


def merged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, TableSpec("ts", chunk="1 day", segment_by=["event_type"], merge_up_to="7 days"))
    cf.compress_chunks(spark, path, older_than="10 days", now=NOW)
    report = cf.layout(spark, path)
    return report.select("chunk_start", "chunk_end", "rows", "min_time", "max_time", "compressed")


def decompressed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, COMPRESSIBLE)
    cf.compress_chunks(spark, path, now=NOW)
    cf.decompress(spark, path, disable=True)
    return cf.scan(spark, path)


def columnstore_layout_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, COMPRESSIBLE)
    cf.compress_chunks(spark, path, now=NOW)
    cf.alter(spark, path, TableSpec(**{**COMPRESSIBLE.to_dict(), "segment_by": ["user_id"]}))
    cf.compress_chunks(spark, path, older_than="1 day", now=NOW)
    return cf.scan(spark, path)


def reordered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, TableSpec("ts", chunk="3 days", reorder_by=["user_id", "ts"]))
    cf.reorder(spark, path)
    return cf.scan(spark, path)


def order_spec_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    urgency = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    orders = orders.select("o_custkey", "o_orderkey", urgency.alias("urgency"))
    down = Window.partitionBy("o_custkey").orderBy(*cf.order_columns(["urgency DESC", "o_orderkey"]))
    up = Window.partitionBy("o_custkey").orderBy(*cf.order_columns(["urgency", "o_orderkey DESC NULLS LAST"]))
    rank = {"down": F.row_number().over(down), "up": F.row_number().over(up)}
    return orders.select("o_orderkey", *[n.cast("bigint").alias(name) for name, n in rank.items()])


def retention_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, COMPRESSIBLE)
    cf.drop_chunks(spark, path, now=NOW)
    return cf.scan(spark, path)


def retention_integer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "chronofold") + "/series"
    series = _events(spark, sf_dir).select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix_seconds"), "value")
    cf.create_hypertable(series, path, TableSpec("unix_seconds", chunk=3 * 86_400, drop_after=7 * 86_400))
    cf.drop_chunks(spark, path, now=1_706_659_200)
    return cf.scan(spark, path)


def convert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "chronofold") + "/lineitem"
    lineitem = _table(spark, sf_dir, "lineitem")
    cf.convert(lineitem, path, TableSpec("l_shipdate", chunk=(6, "month"), dims={"l_orderkey": 2}))
    return cf.scan(spark, path)


def to_plain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, THREE_DAYS)
    plain = scratch_folder(spark, "chronofold") + "/plain"
    cf.to_plain(spark, path, plain)
    return spark.read.parquet(plain)


def repartition_column_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "chronofold") + "/orders"
    orders = _table(spark, sf_dir, "orders")
    received = F.timestamp_add("DAY", F.pmod("o_orderkey", F.lit(90)), F.col("o_orderdate"))
    cf.create_hypertable(orders.withColumn("received", received), path, TableSpec("o_orderdate", chunk=(1, "year")))
    cf.rebuild(spark, path, TableSpec("received", chunk=(1, "year")))
    return cf.scan(spark, path)


def resize_dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, DAILY_BY_USER)
    cf.alter(spark, path, TableSpec("ts", chunk=(3, "day"), dims={"user_id": 2}))
    return cf.scan(spark, path)


def add_dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    path = scratch_folder(spark, "chronofold") + "/events"
    cf.create_hypertable(events.where("ts < '2024-01-16'"), path, TableSpec("ts", chunk="3 days"))
    cf.alter(spark, path, DAILY_BY_USER)
    cf.append(events.where("ts >= '2024-01-16'"), path)
    return cf.scan(spark, path)


def interval_change_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    path = scratch_folder(spark, "chronofold") + "/events"
    cf.create_hypertable(events.where("ts < '2024-01-16'"), path, DAILY)
    cf.alter(spark, path, TableSpec("ts", chunk="7 days"))
    cf.append(events.where("ts >= '2024-01-16'"), path)
    report = cf.layout(spark, path)
    return report.select("chunk_start", "chunk_end", "rows")


# --- rollups --------------------------------------------------------------------------------------------------------


def _hourly(source: str, **changes) -> RollupSpec:
    settings = {
        "width": "1 hour",
        "keys": ["event_type"],
        "aggs": {"average": "avg(value)", "n": "count(*)", "last_value": "max_by(value, ts)"},
        "chunk": "7 days",
        "start_offset": "20 days",
        "end_offset": "10 days",
    }
    return RollupSpec(source=source, time="ts", **{**settings, **changes})


def _rollup(spark: SparkSession, sf_dir: str, with_data: bool = False, **changes) -> str:
    source = _stored(spark, sf_dir, THREE_DAYS)
    path = source.removesuffix("events") + "hourly"
    cf.create_rollup(spark, path, _hourly(source, **changes), with_data=with_data)
    return path


def rollup_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cf.read_rollup(spark, _rollup(spark, sf_dir, with_data=True)), "average")


def rollup_no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created empty, then refreshed by hand."""
    path = _rollup(spark, sf_dir)
    empty = cf.read_rollup(spark, path)
    cf.refresh(spark, path)
    return _rounded(empty.unionByName(cf.read_rollup(spark, path)), "average")


def rollup_window_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rollup(spark, sf_dir)
    cf.run_refresh_policy(spark, path, now=datetime(2024, 1, 31, 0, 30))
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rollup(spark, sf_dir, materialized_only=False)
    cf.run_refresh_policy(spark, path, now=datetime(2024, 1, 31, 0, 30))
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = _rollup(spark, sf_dir)
    daily = hourly.removesuffix("hourly") + "daily"
    cf.create_rollup(
        spark, daily, RollupSpec(source=hourly, time="bucket", width="1 day", aggs={"average": "avg(average)"}, bucket="day")
    )
    cf.refresh_tree(spark, [daily, hourly])
    return _rounded(cf.read_rollup(spark, daily), "average")


def rollup_redefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rollup(spark, sf_dir, with_data=True)
    source = path.removesuffix("hourly") + "events"
    changed = _hourly(source, width="2 hours", aggs={"total": "sum(value)"}, where="event_type <> 'error'")
    cf.redefine(spark, path, changed)
    return _rounded(cf.read_rollup(spark, path), "total", digits=2)


def rollup_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rollup(spark, sf_dir, with_data=True, chunk="3 days", drop_after="7 days")
    cf.drop_chunks(spark, path, now=NOW)
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_after_source_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets whose raw rows are gone survive a later full refresh."""
    path = _rollup(spark, sf_dir, with_data=True)
    cf.drop_chunks(spark, path.removesuffix("hourly") + "events", older_than="7 days", now=NOW)
    cf.refresh(spark, path)
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _rollup(spark, sf_dir, with_data=True, segment_by=["event_type"], compress_after="10 days")
    cf.compress_chunks(spark, path, now=NOW)
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files of events, one per trigger; the windows still open at the end are not emitted."""
    events = _events(spark, sf_dir)
    folder = scratch_folder(spark, "chronofold")
    source = f"{folder}/incoming"
    for low, high in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        part = events.where((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))
        part.coalesce(1).write.mode("append").parquet(source)
    raw = f"{folder}/events"
    cf.create_hypertable(events.limit(0), raw, DAILY)
    path = f"{folder}/hourly"
    cf.create_rollup(spark, path, _hourly(raw, aggs={"average": "avg(value)", "n": "count(*)"}, end_offset="2 hours"))
    incoming = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    cf.stream_rollup(incoming, path, f"{folder}/checkpoint").awaitTermination()
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events, a rollup of them, then the other half, some of it late: only stale buckets are computed."""
    events = _events(spark, sf_dir)
    path = scratch_folder(spark, "chronofold") + "/hourly"
    source = path.removesuffix("hourly") + "events"
    early = (F.col("ts") < F.lit("2024-01-16")) & (F.col("event_id") % 7 != 3)
    cf.create_hypertable(events.where(early), source, THREE_DAYS)
    cf.create_rollup(spark, path, _hourly(source), with_data=True)
    cf.append(events.where(~early), source)
    cf.refresh(spark, path, incremental=True)
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_straddling_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old chunks are dropped inside a bucket, then rows come for all times: nothing that was taken in is lost."""
    events = _events(spark, sf_dir)
    path = scratch_folder(spark, "chronofold") + "/wide"
    source = path.removesuffix("wide") + "events"
    cf.create_hypertable(events.where("event_id % 3 <> 0"), source, THREE_DAYS)
    aggs = {
        "average": "avg(value)",
        "n": "count(*)",
        "low": "min(value)",
        "high": "max(value)",
        "last_value": "max_by(value, ts)",
        "first_value": "min_by(value, ts)",
    }
    cf.create_rollup(spark, path, _hourly(source, width="10 days", aggs=aggs, chunk="30 days"), with_data=True)
    cf.drop_chunks(spark, source, older_than="7 days", now=NOW)
    cf.append(events.where("event_id % 3 = 0"), source)
    cf.refresh(spark, path, incremental=True)
    cf.drop_chunks(spark, source, older_than="4 days", now=NOW)
    cf.refresh(spark, path)
    return _rounded(cf.read_rollup(spark, path), "average")


def rollup_realtime_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two windows are materialized; what lies before, between and behind them is read from the source."""
    path = _rollup(spark, sf_dir)
    cf.refresh(spark, path, "2024-01-05", "2024-01-09T12:00:00")
    cf.refresh(spark, path, "2024-01-20T06:00:00", "2024-01-23")
    return _rounded(cf.read_rollup(spark, path, holes=True), "average")


def rollup_redefined_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup gets another filter; the daily and the weekly rollup on top of it follow without being named."""
    hourly = _rollup(spark, sf_dir, with_data=True)
    folder = hourly.removesuffix("hourly")
    aggs = {"n": "sum(n)", "high": "max(last_value)"}
    cf.create_rollup(spark, folder + "daily", RollupSpec(hourly, "bucket", "1 day", aggs, bucket="day"), with_data=True)
    weekly = RollupSpec(folder + "daily", "day", "7 days", {"n": "sum(n)", "high": "max(high)"}, bucket="week")
    cf.create_rollup(spark, folder + "weekly", weekly, with_data=True)
    cf.redefine(spark, hourly, _hourly(folder + "events", where="event_type <> 'error'"))
    return cf.read_rollup(spark, folder + "weekly")


def rollup_stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files, the last one with rows for the days of the first: states are added, open buckets and late rows count."""
    events = _events(spark, sf_dir)
    folder = scratch_folder(spark, "chronofold")
    late = F.col("event_id") % 5 == 2
    first, second = F.col("ts") < F.lit("2024-01-11"), F.col("ts") < F.lit("2024-01-21")
    for part in (first & ~late, ~first & second & ~late, ~second | late):
        events.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/incoming")
    cf.create_hypertable(events.limit(0), f"{folder}/events", DAILY)
    path = f"{folder}/hourly"
    cf.create_rollup(spark, path, _hourly(f"{folder}/events", segment_by=["event_type"], compress_after="10 days"))
    incoming = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/incoming")
    cf.stream_rollup(incoming, path, f"{folder}/checkpoint", deltas=True).awaitTermination()
    return _rounded(cf.read_rollup(spark, path), "average")


# --- pruning by conditions, joins and statistics ----------------------------------------------------------------------


def scan_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, DAILY_BY_USER)
    condition = "ts BETWEEN '2024-01-04' AND '2024-01-06' AND user_id IN (7, 11, 23) OR ts >= '2024-01-28' AND value > 50"
    return cf.scan(spark, path, where=condition)


def scan_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the customers of one nation."""
    customers = _table(spark, sf_dir, "customer").where("c_nationkey = 3 AND c_acctbal > 0")
    customers = customers.select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    return cf.scan_joined(spark, _stored(spark, sf_dir, DAILY_BY_USER), customers, "user_id")


def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one time are equally new, so only the times are compared."""
    return cf.latest(spark, _stored(spark, sf_dir, DAILY), 500).select("ts")


def count_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored(spark, sf_dir, THREE_DAYS)
    return cf.count_in_range(spark, path, start="2024-01-04T07:30:00", end="2024-01-22T21:15:00")


def skipping_enabled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skipping by a column that the table did not have it for, with the range of every chunk beside the rows it leaves."""
    path = _stored(spark, sf_dir, TableSpec("ts", chunk="3 days", segment_by=["event_type"]))
    cf.enable_chunk_skipping(spark, path, "event_id")
    cf.compress_chunks(spark, path, now=NOW)
    return cf.scan(spark, path, where="event_id >= 4000 AND event_id < 4700 OR event_id IN (1, 2, 3)")


def uuid7_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scratch_folder(spark, "chronofold")
    cf.with_uuid7(_events(spark, sf_dir), "ts").write.parquet(stored)
    found = spark.read.parquet(stored).where(cf.uuid7_between("id", "2024-01-05T06:00:00", "2024-01-09"))
    return found.select("event_id", "ts")


# --- contract -------------------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: hourly average, first and last value by time."""
    return bucket_hourly_ohlc(spark, "/root/testdata/sf0.001")


QUERIES = (
    bucket_hourly_ohlc,
    bucket_text_width,
    bucket_projection,
    bucket_timestamp_zone,
    bucket_week_date,
    bucket_month,
    bucket_quarter,
    bucket_year,
    bucket_integer,
    bucket_by_key,
    bucket_origin,
    bucket_sql_functions,
    first_last_by_key,
    histogram_value,
    histogram_by_hour,
    uuid7_roundtrip,
    uuid7_generated,
    uuid7_range,
    gapfill_6h,
    gapfill_locf,
    gapfill_interpolate,
    gapfill_range,
    gapfill_long_series,
    gapfill_month,
    daily_over_hourly,
    scan_time_range,
    scan_hash_key,
    scan_skip_range,
    integer_hypertable,
    append_rows,
    layout_report,
    compressed_rows,
    merged_rows,
    decompressed_rows,
    columnstore_layout_change,
    reordered_rows,
    order_spec_rows,
    retention_rows,
    retention_integer_rows,
    convert_rows,
    to_plain_rows,
    repartition_column_rows,
    resize_dimension_rows,
    add_dimension_rows,
    interval_change_rows,
    rollup_full,
    rollup_no_data,
    rollup_window_refresh,
    rollup_realtime,
    rollup_hierarchy,
    rollup_redefined,
    rollup_retention,
    rollup_after_source_retention,
    rollup_compressed,
    rollup_stream,
    rollup_incremental,
    rollup_straddling_retention,
    rollup_realtime_holes,
    rollup_redefined_tree,
    rollup_stream_deltas,
    scan_where,
    scan_joined,
    latest_rows,
    count_in_range,
    skipping_enabled_rows,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in QUERIES}
    if llm_queries:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def _gapfill_sql(width: str, key: str, aggs: str, filled: str, table: str = "events", ts: str = "ts") -> str:
    on_key = f"spine.{key} IS NOT DISTINCT FROM agg.{key} AND " if key else ""
    key_list = f"{key}, " if key else ""
    keys_from = f"(SELECT DISTINCT {key} FROM {table}), " if key else ""
    return f"""
        WITH agg AS (
            SELECT {key_list}time_bucket(INTERVAL '{width}', {ts})::TIMESTAMP AS bucket, {aggs} FROM {table} GROUP BY ALL
        ), bounds AS (
            SELECT time_bucket(INTERVAL '{width}', min({ts}))::TIMESTAMP AS lo,
                   time_bucket(INTERVAL '{width}', max({ts}))::TIMESTAMP AS hi FROM {table}
        ), spine AS (
            SELECT {key_list}unnest(generate_series(lo, hi, INTERVAL '{width}')) AS bucket FROM {keys_from}bounds
        ), dense AS (
            SELECT spine.*, agg.* EXCLUDE ({key_list}bucket)
            FROM spine LEFT JOIN agg ON {on_key}spine.bucket = agg.bucket
        )
        SELECT {key_list}bucket, {filled} FROM dense
        WINDOW before AS ({f'PARTITION BY {key} ' if key else ''}ORDER BY bucket
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               onward AS ({f'PARTITION BY {key} ' if key else ''}ORDER BY bucket
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    """


def _line_sql(name: str) -> str:
    def known(what: str, way: str, window: str) -> str:
        return f"{way}_value({what} IGNORE NULLS) OVER {window}"

    at = f"CASE WHEN {name} IS NOT NULL THEN epoch_us(bucket) END"
    y0, y1 = known(name, "last", "before"), known(name, "first", "onward")
    t0, t1 = known(at, "last", "before"), known(at, "first", "onward")
    return (
        f"round(coalesce({name}, {y0} + ({y1} - {y0}) * (epoch_us(bucket) - {t0})::DOUBLE / ({t1} - {t0})::DOUBLE) + 1.234e-9, 8)"
        f" AS {name}"
    )


def _hourly_sql(where: str = "true", width: str = "1 hour", aggs: str | None = None) -> str:
    aggs = aggs or "round(avg(value) + 1.234e-9, 8) AS average, count(*) AS n, arg_max_null(value, ts) AS last_value"
    return f"""
        SELECT time_bucket(INTERVAL '{width}', ts) AS bucket, event_type, {aggs}
        FROM events WHERE {where} GROUP BY 1, 2
    """


def _orders_sql(width: str) -> str:
    return f"""
        SELECT time_bucket(INTERVAL '{width}', o_orderdate)::TIMESTAMP AS bucket,
               round(sum(o_totalprice), 2) AS total, count(*) AS n
        FROM orders GROUP BY 1
    """


def _bins_sql(lo: float, hi: float, n: int) -> str:
    step = (hi - lo) / n
    bins = [f"count(*) FILTER (WHERE value < {lo})"]
    bins += [f"count(*) FILTER (WHERE value >= {lo + i * step} AND value < {lo + (i + 1) * step})" for i in range(n)]
    bins.append(f"count(*) FILTER (WHERE value >= {hi})")
    return "[" + ", ".join(f"({b})::DOUBLE" for b in bins) + "] AS histogram"


_ALL_EVENTS = f"SELECT {EVENT_COLUMNS} FROM events"
_DAY = "date_trunc('day', ts)"
_KEPT = "time_bucket(INTERVAL '3 days', ts) + INTERVAL '3 days' > TIMESTAMP '2024-01-24'"
_CHUNK_COLUMNS = "count(*) AS rows, min(ts) AS min_time, max(ts) AS max_time"


def oracle_sql() -> dict[str, str]:
    """SQL for every query of the library itself, and for those of the optional part that SQL can express."""
    more = dict(llm_queries.ORACLE_SQL) if llm_queries else {}
    if llm_queries and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | {
        "bucket_hourly_ohlc": """
            SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, round(avg(value) + 1.234e-9, 8) AS average,
                   arg_min_null(value, ts) AS first_value, arg_max_null(value, ts) AS last_value,
                   min(value) AS low, max(value) AS high, count(*) AS n
            FROM events GROUP BY 1
        """,
        "bucket_text_width": "SELECT time_bucket(INTERVAL '15 minutes', ts) AS bucket, count(*) AS n FROM events GROUP BY 1",
        "bucket_projection": "SELECT event_id, time_bucket(INTERVAL '5 hours 30 minutes', ts) AS bucket FROM events",
        "bucket_timestamp_zone": """
            SELECT time_bucket(INTERVAL '30.5 seconds', ts) AS bucket, count(*) AS n FROM events GROUP BY 1
        """,
        "bucket_week_date": """
            SELECT time_bucket(INTERVAL '7 days', o_orderdate::DATE)::DATE AS week, count(*) AS n FROM orders GROUP BY 1
        """,
        "bucket_month": _orders_sql("1 month"),
        "bucket_quarter": _orders_sql("3 months"),
        "bucket_year": _orders_sql("24 months"),
        "bucket_integer": """
            SELECT epoch_us(ts) - epoch_us(ts) % 7000000000 AS bucket, count(*) AS n, round(sum(value), 2) AS total
            FROM events GROUP BY 1
        """,
        "bucket_by_key": """
            SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, event_type, round(avg(value) + 1.234e-9, 8) AS average, count(*) AS n
            FROM events GROUP BY 1, 2
        """,
        "bucket_origin": """
            SELECT time_bucket(INTERVAL '7 hours', ts, TIMESTAMP '2024-01-01 03:00:00') AS bucket, count(*) AS n
            FROM events GROUP BY 1
        """,
        "bucket_sql_functions": """
            SELECT time_bucket(INTERVAL '20 minutes', ts) AS bucket,
                   time_bucket(INTERVAL '1 month', max(ts))::TIMESTAMP AS month,
                   max(time_bucket(INTERVAL '3 days', ts::DATE))::DATE AS days,
                   max(event_id - event_id % 1000) AS ids,
                   arg_min_null(value, ts) AS first_value, arg_max_null(value, ts) AS last_value
            FROM events GROUP BY 1
        """,
        "first_last_by_key": """
            SELECT user_id,
                   arg_min_null(event_type, (ts, event_id)) AS first_type,
                   arg_max_null(event_type, (ts, event_id)) AS last_type,
                   arg_min_null(CASE WHEN value > 20 THEN value END, ts) AS first_above
            FROM events GROUP BY 1
        """,
        "histogram_value": f"SELECT event_type, {_bins_sql(5.0, 155.0, 10)} FROM events GROUP BY 1",
        "histogram_by_hour": f"""
            SELECT time_bucket(INTERVAL '6 hours', ts) AS bucket, {_bins_sql(0.0, 100.0, 4)} FROM events GROUP BY 1
        """,
        "uuid7_roundtrip": "SELECT event_id, date_trunc('millisecond', ts) AS ts_ms FROM events",
        "uuid7_generated": "SELECT event_id, true AS well_formed, true AS is_now FROM events",
        "gapfill_6h": _gapfill_sql(
            "6 hours", "user_id", "avg(value) AS average, count(*) AS n", "round(average + 1.234e-9, 8) AS average, n"
        ),
        "gapfill_locf": _gapfill_sql(
            "15 minutes",
            "event_type",
            "arg_max_null(value, ts) AS latest, count(*) AS n",
            "last_value(latest IGNORE NULLS) OVER before AS latest, n",
        ),
        "gapfill_interpolate": _gapfill_sql("15 minutes", "event_type", "avg(value) AS average", _line_sql("average")),
        "gapfill_range": f"""
            WITH ranged AS (
                SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-09 12:00:00' AND ts < TIMESTAMP '2024-01-12'
            ), agg AS (
                SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS bucket, max(value) AS high, min(value) AS low
                FROM ranged GROUP BY ALL
            ), spine AS (
                SELECT user_id, unnest(generate_series(
                    TIMESTAMP '2024-01-09 12:00:00', TIMESTAMP '2024-01-11 23:00:00', INTERVAL '1 hour')) AS bucket
                FROM (SELECT DISTINCT user_id FROM ranged)
            ), dense AS (
                SELECT spine.*, high, low FROM spine LEFT JOIN agg USING (user_id, bucket)
            )
            SELECT user_id, bucket, last_value(high IGNORE NULLS) OVER before AS high, {_line_sql("low")} FROM dense
            WINDOW before AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                   onward AS (PARTITION BY user_id ORDER BY bucket ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        """,
        "gapfill_long_series": _gapfill_sql(
            "20 seconds",
            "",
            "max(value) AS high, min(value) AS low, count(*) AS n",
            f"last_value(high IGNORE NULLS) OVER before AS high, {_line_sql('low')}, n",
        ),
        "gapfill_month": _gapfill_sql(
            "1 month",
            "o_custkey",
            "count(*) AS n, max(o_totalprice) AS high",
            "n, last_value(high IGNORE NULLS) OVER before AS high",
            table="orders",
            ts="o_orderdate",
        ),
        "daily_over_hourly": """
            SELECT time_bucket(INTERVAL '1 day', bucket) AS day, round(avg(average) + 1.234e-9, 8) AS average FROM (
                SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, event_type, avg(value) AS average
                FROM events GROUP BY 1, 2)
            GROUP BY 1
        """,
        "scan_time_range": f"{_ALL_EVENTS} WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09'",
        "scan_hash_key": f"{_ALL_EVENTS} WHERE ts >= TIMESTAMP '2024-01-04' AND user_id = 7",
        "scan_skip_range": f"{_ALL_EVENTS} WHERE event_id >= 1000 AND event_id < 2500",
        "integer_hypertable": """
            SELECT epoch_us(ts) AS us, value FROM events
            WHERE epoch_us(ts) >= 1704500000000000 AND epoch_us(ts) < 1705500000000000
        """,
        "append_rows": _ALL_EVENTS,
        "layout_report": f"""
            SELECT {_DAY} AS chunk_start, {_DAY} + INTERVAL '1 day' AS chunk_end, {_CHUNK_COLUMNS}, false AS compressed
            FROM events GROUP BY 1, 2
        """,
        "compressed_rows": _ALL_EVENTS,
        # Weeks that end at least ten days before 2024-01-31 are merged, other days up to then only compressed.
        "merged_rows": f"""
            SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN time_bucket(INTERVAL '7 days', ts) ELSE {_DAY} END AS chunk_start,
                   max({_DAY}) + INTERVAL '1 day' AS chunk_end, {_CHUNK_COLUMNS},
                   min(ts) < TIMESTAMP '2024-01-21' AS compressed
            FROM events GROUP BY 1
        """,
        "decompressed_rows": _ALL_EVENTS,
        "columnstore_layout_change": _ALL_EVENTS,
        "reordered_rows": _ALL_EVENTS,
        "order_spec_rows": """
            SELECT o_orderkey,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY urgency DESC NULLS FIRST, o_orderkey) AS down,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY urgency NULLS LAST, o_orderkey DESC) AS up
            FROM (SELECT *, nullif(o_orderpriority, '5-LOW') AS urgency FROM orders)
        """,
        # Whole chunks only: what is left is every chunk that ends after 2024-01-24.
        "retention_rows": f"{_ALL_EVENTS} WHERE {_KEPT}",
        "retention_integer_rows": """
            SELECT epoch_us(ts) // 1000000 AS unix_seconds, value FROM events
            WHERE (epoch_us(ts) // 259200000000 + 1) * 259200 > 1706054400
        """,
        "convert_rows": "SELECT * FROM lineitem",
        "to_plain_rows": _ALL_EVENTS,
        "repartition_column_rows": "SELECT *, o_orderdate + to_days((o_orderkey % 90)::INT) AS received FROM orders",
        "resize_dimension_rows": _ALL_EVENTS,
        "add_dimension_rows": _ALL_EVENTS,
        "interval_change_rows": f"""
            SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN {_DAY} ELSE time_bucket(INTERVAL '7 days', ts) END AS chunk_start,
                   CASE WHEN ts < TIMESTAMP '2024-01-16' THEN {_DAY} + INTERVAL '1 day'
                        ELSE time_bucket(INTERVAL '7 days', ts) + INTERVAL '7 days' END AS chunk_end,
                   count(*) AS rows
            FROM events GROUP BY 1, 2
        """,
        "rollup_full": _hourly_sql(),
        "rollup_no_data": _hourly_sql(),
        # From 20 to 10 days before 2024-01-31 00:30: whole hours only.
        "rollup_window_refresh": _hourly_sql("ts >= TIMESTAMP '2024-01-11 01:00:00' AND ts < TIMESTAMP '2024-01-21'"),
        "rollup_realtime": _hourly_sql("ts >= TIMESTAMP '2024-01-11 01:00:00'"),
        "rollup_hierarchy": """
            SELECT time_bucket(INTERVAL '1 day', bucket) AS day, round(avg(average) + 1.234e-9, 8) AS average FROM (
                SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, event_type, avg(value) AS average
                FROM events GROUP BY 1, 2)
            GROUP BY 1
        """,
        "rollup_redefined": _hourly_sql("event_type <> 'error'", "2 hours", "round(sum(value), 2) AS total"),
        "rollup_retention": _hourly_sql(_KEPT),
        "rollup_after_source_retention": _hourly_sql(),
        "rollup_compressed": _hourly_sql(),
        "rollup_incremental": _hourly_sql(),
        "rollup_straddling_retention": _hourly_sql(
            width="10 days",
            aggs="""round(avg(value) + 1.234e-9, 8) AS average, count(*) AS n, min(value) AS low, max(value) AS high,
                    arg_max(value, ts) AS last_value, arg_min(value, ts) AS first_value""",
        ),
        "rollup_realtime_holes": _hourly_sql(),
        "rollup_redefined_tree": """
            SELECT time_bucket(INTERVAL '7 days', bucket) AS week, sum(n)::BIGINT AS n, max(last_value) AS high FROM (
                SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, count(*) AS n, arg_max(value, ts) AS last_value
                FROM events WHERE event_type <> 'error' GROUP BY time_bucket(INTERVAL '1 hour', ts), event_type)
            GROUP BY 1
        """,
        "rollup_stream_deltas": _hourly_sql(),
        "scan_where": f"""{_ALL_EVENTS} WHERE ts BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-06' AND user_id IN (7, 11, 23)
                          OR ts >= TIMESTAMP '2024-01-28' AND value > 50""",
        "scan_joined": """
            SELECT e.*, c.c_acctbal FROM events e JOIN customer c ON c.c_custkey = e.user_id WHERE c.c_nationkey = 3 AND c.c_acctbal > 0
        """,
        "latest_rows": "SELECT ts FROM events ORDER BY ts DESC LIMIT 500",
        "count_in_range": """
            SELECT count(*) AS rows, min(ts) AS first_time, max(ts) AS last_time FROM events
            WHERE ts >= TIMESTAMP '2024-01-04 07:30:00' AND ts < TIMESTAMP '2024-01-22 21:15:00'
        """,
        "skipping_enabled_rows": f"{_ALL_EVENTS} WHERE event_id >= 4000 AND event_id < 4700 OR event_id IN (1, 2, 3)",
        "uuid7_range": "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-09'",
        "rollup_stream": _hourly_sql(
            "time_bucket(INTERVAL '1 hour', ts) + INTERVAL '3 hours' <= (SELECT max(ts) FROM events)",
            aggs="round(avg(value) + 1.234e-9, 8) AS average, count(*) AS n",
        ),
    }
