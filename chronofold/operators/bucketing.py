"""Rollups by time bucket and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.aggregates import bin_number, check_bins
from chronofold.functions.buckets import TIME_TYPES, bucket_index, index_time
from chronofold.functions.widths import as_instant, parse_width

INDEX = "__bucket_index"

Aggregates = Mapping[str, "Column | str"]


def time_type(df: DataFrame, ts: str) -> T.DataType:
    dtype = df.schema[ts].dataType
    if not isinstance(dtype, TIME_TYPES):
        raise TypeError(f"{ts} is {dtype.simpleString()}, which is not a time column type")
    return dtype


def named(aggs: Aggregates) -> list[Column]:
    """Aggregates given as columns or as SQL text, e.g. ``{"average": "avg(value)"}``."""
    if not aggs:
        raise ValueError("at least one aggregate is needed")
    return [(F.expr(agg) if isinstance(agg, str) else agg).alias(name) for name, agg in aggs.items()]


def group_by_index(
    df: DataFrame, width: Any, ts: str, aggs: Aggregates, keys: Sequence[str] = (), origin: int | None = None
) -> DataFrame:
    """Aggregate per key and bucket number: partial aggregation before the one shuffle, so hot keys stay cheap."""
    index = bucket_index(ts, width, time_type(df, ts), origin)
    return df.groupBy(*keys, index.alias(INDEX)).agg(*named(aggs))


def bucket_by(
    df: DataFrame,
    width: Any,
    ts: str,
    aggs: Aggregates,
    keys: Sequence[str] = (),
    bucket: str = "bucket",
    origin: Any = None,
) -> DataFrame:
    """Group by time bucket and keys. Rows without a time form the group whose bucket is null."""
    start = None if origin is None else as_instant(origin)
    grouped = group_by_index(df, width, ts, aggs, keys, start)
    bucket_time = index_time(F.col(INDEX), parse_width(width), time_type(df, ts), start)
    return grouped.select(bucket_time.alias(bucket), *keys, *aggs)


def histogram_by(
    df: DataFrame,
    keys: Sequence[Column | str],
    value: str,
    lo: float,
    hi: float,
    n: int,
    name: str = "histogram",
) -> DataFrame:
    """Histogram per key for any number of bins.

    Counts per key and bin first, then puts at most ``n + 2`` counts per key into the array. A hot key is spread over
    its bins and over the partial counts of every task before it meets itself.
    """
    check_bins(lo, hi, n)
    keyed = [F.col(k) if isinstance(k, str) else k for k in keys]
    counted = df.groupBy(*keyed, bin_number(value, lo, hi, n).alias("__bin")).agg(F.count("*").alias("__n"))
    names = counted.columns[: len(keyed)]
    filled = F.map_from_entries(
        F.collect_list(F.when(F.col("__bin").isNotNull(), F.struct(F.col("__bin").cast("int"), "__n")))
    )
    return (
        counted.groupBy(*names)
        .agg(filled.alias("__counts"))
        .select(
            *names,
            F.transform(
                F.sequence(F.lit(0), F.lit(n + 1)),
                lambda i: F.coalesce(F.element_at("__counts", i), F.lit(0)).cast("double"),
            ).alias(name),
        )
    )
