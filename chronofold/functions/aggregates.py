"""Aggregates that need an order or a set of bins."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronofold.functions.buckets import column


def _order(time: Any, tie_by: Any) -> Column:
    return column(time) if tie_by is None else F.when(column(time).isNotNull(), F.struct(column(time), column(tie_by)))


def first_by(value: Any, time: Any, tie_by: Any = None) -> Column:
    """Value of the row with the smallest time. A row without a time never wins; a null value may."""
    return F.min_by(column(value), _order(time, tie_by))


def last_by(value: Any, time: Any, tie_by: Any = None) -> Column:
    """Value of the row with the largest time. A row without a time never wins; a null value may."""
    return F.max_by(column(value), _order(time, tie_by))


def check_bins(lo: float, hi: float, n: int) -> None:
    if n < 1 or not lo < hi:
        raise ValueError("a histogram needs lo < hi and at least one bin")


def bin_number(value: Any, lo: float, hi: float, n: int) -> Column:
    """0 below ``lo``, 1..n inside, n + 1 from ``hi`` on; null for null and NaN."""
    number = column(value).cast("double")
    return F.when(~F.isnan(number), F.width_bucket(number, F.lit(float(lo)), F.lit(float(hi)), F.lit(n)))


def histogram(value: Any, lo: float, hi: float, n: int) -> Column:
    """Counts per bin as an array of n + 2 doubles. One pass with n + 2 plain counters.

    For many bins use :func:`chronofold.operators.histogram_by`, whose plan does not grow with ``n``.
    """
    check_bins(lo, hi, n)
    number = bin_number(value, lo, hi, n)
    return F.array(*[F.count_if(number == F.lit(i)).cast("double") for i in range(n + 2)])
