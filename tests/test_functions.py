from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import chronofold as cf
from chronofold.functions.buckets import bucket_index, from_position, index_time, position
from chronofold.functions.widths import as_instant, bucket_floor, parse_width


def _times(spark, kind, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("t"))


MOMENTS = ["1969-12-31 23:59:59.999999", "1999-12-31 23:00:00", "2000-01-03 00:00:00", "2024-01-05 13:17:59.5", "2024-02-29 12:00:00"]
WIDTHS = ["1 day", "7 days", "15 minutes", "5 hours 30 minutes", "00:00:00.5", "1 month", "3 months", "5 months", "2 years"]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_bucket_matches_plain_arithmetic(spark, width, kind):
    df = _times(spark, kind, *MOMENTS)
    dtype = df.schema["t"].dataType
    out = df.select(
        cf.time_bucket(width, "t").alias("scalar"),
        index_time(bucket_index("t", width, dtype), width, dtype).alias("by_number"),
    )
    assert [t for _, t in out.dtypes] == [kind, kind]
    expected = [bucket_floor(as_instant(m.replace(" ", "T")), parse_width(width)) for m in MOMENTS]
    for name in ("scalar", "by_number"):
        got = out.select(position(name, dtype).alias("p")).collect()
        assert [row.p for row in got] == expected, name


def test_hand_made_buckets(spark):
    row = _times(spark, "timestamp_ntz", "1999-12-31 23:00:00").select(cf.time_bucket("1 day", "t")).first()
    assert row[0] == datetime(1999, 12, 31)
    row = _times(spark, "timestamp_ntz", "2024-01-05").select(cf.time_bucket((7, "day"), "t")).first()
    assert row[0] == datetime(2024, 1, 1)
    row = _times(spark, "date", "2024-01-05").select(cf.time_bucket_date("7 days", "t")).first()
    assert row[0] == date(2024, 1, 1)
    row = spark.range(-3, -2).select(cf.time_bucket_int(10, "id")).first()
    assert row[0] == -10


def test_null_in_null_out(spark):
    df = spark.sql("SELECT cast(null AS timestamp) AS t, cast(null AS date) AS d, cast(null AS bigint) AS i, cast(null AS string) AS s")
    row = df.select(
        cf.time_bucket("1 day", "t"),
        cf.time_bucket("1 month", "t"),
        cf.time_bucket_date("1 day", "d"),
        cf.time_bucket_int(3, "i"),
        cf.to_uuid7("t"),
        cf.uuid7_timestamp("s"),
    ).first()
    assert set(row) == {None}


def test_width_must_fit_the_column(spark):
    with pytest.raises(TypeError):
        cf.time_bucket(5, "t")
    with pytest.raises(TypeError):
        cf.typed_bucket("1 day", "t", T.LongType())


def test_other_session_zone_is_refused(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Istanbul")
    try:
        with pytest.raises(ValueError, match="UTC"):
            cf.time_bucket("1 day", "t")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint", "int", "smallint"])
def test_positions_round_trip(spark, kind):
    df = spark.createDataFrame([(-5,), (0,), (12_345,)], "i int")
    stored = {"timestamp": F.timestamp_micros("i"), "timestamp_ntz": F.timestamp_micros("i").cast(kind), "date": F.date_from_unix_date("i")}
    df = df.select(stored.get(kind, F.col("i").cast(kind)).alias("t"))
    dtype = df.schema["t"].dataType
    out = df.select("t", from_position(position("t", dtype), dtype).alias("back"))
    assert out.schema["back"].dataType == dtype
    assert all(row.t == row.back for row in out.collect())


def test_first_and_last_follow_time_and_keep_null_values(spark):
    rows = [(1, None), (2, 5), (None, 3), (4, 9), (None, 10)]
    df = spark.createDataFrame(rows, "value int, time int")
    assert tuple(df.agg(cf.first_by("value", "time"), cf.last_by("value", "time")).first()) == (None, None)
    kept = df.where("value IS NOT NULL")
    assert tuple(kept.agg(cf.first_by("value", "time"), cf.last_by("value", "time")).first()) == (2, 4)


def test_ties_are_broken_by_another_column(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 1), ("c", None, 0)], "value string, time int, seq int")
    row = df.agg(cf.first_by("value", "time", tie_by="seq"), cf.last_by("value", "time", tie_by="seq")).first()
    assert tuple(row) == ("b", "a")


VALUES = [-1.0, 0.0, 9.99, 10.0, 99.99, 100.0, 250.0, None, float("nan")]
BINS = [1, 2, 1, 0, 0, 0, 0, 0, 0, 0, 1, 2]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v double")
    assert df.agg(cf.histogram("v", 0, 100, 10)).first()[0] == BINS
    assert cf.histogram_by(df.withColumn("k", F.lit(1)), ["k"], "v", 0, 100, 10).first()["histogram"] == BINS


def test_histogram_of_nothing_is_all_zero(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert df.groupBy("k").agg(cf.histogram("v", 0, 1, 2).alias("h")).first()["h"] == [0.0] * 4
    assert cf.histogram_by(df, ["k"], "v", 0, 1, 2).first()["histogram"] == [0.0] * 4


@pytest.mark.parametrize("bad", [(1, 1, 5), (2, 1, 5), (0, 1, 0)])
def test_histogram_arguments(bad):
    with pytest.raises(ValueError):
        cf.histogram("v", *bad)


def test_ids_carry_their_time_and_sort_by_it(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamped = cf.with_uuid7(events, "ts").withColumn("back", cf.uuid7_timestamp("id"))
    assert stamped.where(F.date_trunc("millisecond", "ts") != F.col("back").cast("timestamp_ntz")).isEmpty()
    assert stamped.select("id").distinct().count() == events.count()
    rows = stamped.select("ts", "id").collect()
    by_id = [r.ts.replace(microsecond=r.ts.microsecond // 1000 * 1000) for r in sorted(rows, key=lambda r: r.id)]
    assert by_id == sorted(by_id)


def test_times_before_1970_do_not_fit_an_id(spark):
    with pytest.raises(Exception, match="1970"):
        _times(spark, "timestamp", "1969-12-31").select(cf.to_uuid7("t")).collect()


def test_sql_functions(spark):
    names = cf.register(spark)
    assert "time_bucket" in names
    row = spark.sql(
        """
        SELECT time_bucket(INTERVAL 15 MINUTES, TIMESTAMP'2024-01-01 00:17:00') AS a,
               time_bucket_ntz(INTERVAL 7 DAYS, TIMESTAMP_NTZ'2024-01-05') AS b,
               time_bucket_date(INTERVAL 7 DAYS, DATE'2024-01-05') AS c,
               time_bucket_month(INTERVAL 3 MONTHS, TIMESTAMP'1999-06-05') AS d,
               time_bucket_month_ntz(INTERVAL 1 YEAR, TIMESTAMP_NTZ'1999-06-05') AS e,
               time_bucket_month_date(INTERVAL 1 YEAR, DATE'1999-06-05') AS f,
               time_bucket_int(10, -3) AS g,
               uuid7_timestamp(to_uuid7(TIMESTAMP'2024-01-01 00:17:00')) AS h,
               substr(generate_uuid7(), 15, 1) AS i
        """
    )
    kinds = ["timestamp", "timestamp_ntz", "date", "timestamp", "timestamp_ntz", "date", "bigint", "timestamp", "string"]
    assert [kind for _, kind in row.dtypes] == kinds
    text = row.select(*[F.col(c).cast("string") for c in row.columns]).first()
    assert list(text) == [
        "2024-01-01 00:15:00",
        "2024-01-01 00:00:00",
        "2024-01-01",
        "1999-04-01 00:00:00",
        "1999-01-01 00:00:00",
        "1999-01-01",
        "-10",
        "2024-01-01 00:17:00",
        "7",
    ]


@pytest.mark.parametrize(
    "call",
    [
        "time_bucket(INTERVAL '-1' MINUTE, TIMESTAMP'2024-01-01')",
        "time_bucket_ntz(INTERVAL '0' MINUTE, TIMESTAMP_NTZ'2024-01-01')",
        "time_bucket_month(INTERVAL '-1' MONTH, TIMESTAMP'2024-01-01')",
        "time_bucket_int(-5, 7)",
    ],
)
def test_sql_widths_must_be_positive(spark, call):
    cf.register(spark)
    with pytest.raises(Exception, match="above zero"):
        spark.sql(f"SELECT {call}").collect()


def test_bucket_by_end_to_end_case(spark):
    rows = [("2026-06-01 10:00:00", "a", 10.0), ("2026-06-01 10:20:00", "a", 30.0), ("2026-06-01 10:40:00", "b", 50.0)]
    df = spark.createDataFrame(rows, "time string, device_id string, value double").withColumn("time", F.col("time").cast("timestamp"))
    aggs = {"avg": "avg(value)", "first": cf.first_by("value", "time"), "last": cf.last_by("value", "time")}
    assert [tuple(r)[1:] for r in cf.bucket_by(df, "1 hour", "time", aggs).collect()] == [(30.0, 10.0, 50.0)]
    per_device = cf.bucket_by(df, "1 hour", "time", {"avg": "avg(value)"}, keys=["device_id"]).orderBy("device_id")
    assert [(r.device_id, r.avg) for r in per_device.collect()] == [("a", 20.0), ("b", 50.0)]


def test_bucket_by_keeps_rows_without_a_time(spark):
    df = spark.createDataFrame([(None, 1), ("2024-01-01", 2)], "t string, v int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = cf.bucket_by(df, "1 day", "t", {"n": "count(*)"}).orderBy("bucket").collect()
    assert [(r.bucket, r.n) for r in out] == [(None, 1), (datetime(2024, 1, 1), 1)]


def test_order_specs_place_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")

    def values(spec):
        return [r.v for r in cf.ordered(df, spec).collect()]

    assert values("v") == [1, 2, None]
    assert values("v DESC") == [None, 2, 1]
    assert values("v ASC NULLS FIRST") == [None, 1, 2]
    assert values("v desc nulls last") == [2, 1, None]
    for bad in ("v DOWN", "v NULLS", "v ASC NULLS MIDDLE", "v ASC DESC"):
        with pytest.raises(ValueError):
            cf.order_columns([bad])
