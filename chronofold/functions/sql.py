"""The same functions for Spark SQL, as SQL expressions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from chronofold.functions.buckets import require_utc
from chronofold.functions.widths import CALENDAR_ORIGIN, CALENDAR_ORIGIN_YEAR, FIXED_ORIGIN, MICROS_PER_DAY


def _positive(width: str) -> str:
    """With a constant width the optimizer folds the check away."""
    return f"if({width} > 0, {width}, cast(raise_error('a width must be above zero') AS BIGINT))"


_WIDTH_MICROS = _positive(
    "(extract(DAY FROM width) * 86400000000L + extract(HOUR FROM width) * 3600000000L"
    " + extract(MINUTE FROM width) * 60000000L + cast(extract(SECOND FROM width) * 1000000 AS BIGINT))"
)
_BACK = f"pmod(unix_micros(cast(ts AS TIMESTAMP)) - {FIXED_ORIGIN}L, {_WIDTH_MICROS})"
_MONTHS = f"((year(ts) - {CALENDAR_ORIGIN_YEAR}) * 12 + month(ts) - 1)"
_MONTH_START = (
    f"add_months(DATE'{CALENDAR_ORIGIN}', cast({_MONTHS} - pmod({_MONTHS},"
    f" {_positive('(extract(YEAR FROM width) * 12 + extract(MONTH FROM width))')}) AS INT))"
)
_DAYS = f"(datediff(day, DATE'1970-01-01') * {MICROS_PER_DAY}L - {FIXED_ORIGIN}L)"
_NOISE = "substr(uuid(), 16)"


def _id(millis: str) -> str:
    clock = f"lower(lpad(hex({millis}), 12, '0'))"
    return f"concat(substr({clock}, 1, 8), '-', substr({clock}, 9, 4), '-7', {_NOISE})"


# name -> (arguments, result type, body)
SQL_FUNCTIONS = {
    "time_bucket": (
        "width INTERVAL DAY TO SECOND, ts TIMESTAMP",
        "TIMESTAMP",
        f"timestamp_micros(unix_micros(ts) - {_BACK})",
    ),
    "time_bucket_ntz": (
        "width INTERVAL DAY TO SECOND, ts TIMESTAMP_NTZ",
        "TIMESTAMP_NTZ",
        f"timestampadd(MICROSECOND, -{_BACK}, ts)",
    ),
    "time_bucket_date": (
        "width INTERVAL DAY TO SECOND, day DATE",
        "DATE",
        f"date_from_unix_date(cast((({_DAYS} - pmod({_DAYS}, {_WIDTH_MICROS})) + {FIXED_ORIGIN}L)"
        f" div {MICROS_PER_DAY}L AS INT))",
    ),
    "time_bucket_month": (
        "width INTERVAL YEAR TO MONTH, ts TIMESTAMP",
        "TIMESTAMP",
        f"cast({_MONTH_START} AS TIMESTAMP)",
    ),
    "time_bucket_month_ntz": (
        "width INTERVAL YEAR TO MONTH, ts TIMESTAMP_NTZ",
        "TIMESTAMP_NTZ",
        f"cast({_MONTH_START} AS TIMESTAMP_NTZ)",
    ),
    "time_bucket_month_date": (
        "width INTERVAL YEAR TO MONTH, ts DATE",
        "DATE",
        _MONTH_START,
    ),
    "time_bucket_int": ("width BIGINT, x BIGINT", "BIGINT", f"x - pmod(x, {_positive('width')})"),
    "generate_uuid7": ("", "STRING", _id("unix_millis(current_timestamp())")),
    "to_uuid7": (
        "ts TIMESTAMP",
        "STRING",
        "CASE WHEN unix_millis(ts) < 0 THEN"
        " cast(raise_error('a time before 1970 does not fit a time-ordered id') AS STRING)"
        f" WHEN ts IS NOT NULL THEN {_id('unix_millis(ts)')} END",
    ),
    "uuid7_timestamp": (
        "id STRING",
        "TIMESTAMP",
        "timestamp_millis(cast(conv(substr(replace(id, '-', ''), 1, 12), 16, 10) AS BIGINT))",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in this session and return their names.

    ``first_by`` and ``last_by`` are Spark's own ``min_by`` and ``max_by`` in SQL.
    """
    require_utc()
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)
