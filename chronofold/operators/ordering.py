"""Order specs: ``"time DESC"``, ``"value ASC NULLS FIRST"``.

Without a NULLS clause nulls come last ascending and first descending. Spark's own default is the opposite, so the
placement is always stated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_order(spec: str) -> tuple[str, bool, bool]:
    """(column, descending, nulls first) of one order spec."""
    name, *words = spec.split()
    words = [w.upper() for w in words]
    descending = False
    if words and words[0] in ("ASC", "DESC"):
        descending = words.pop(0) == "DESC"
    nulls_first = descending
    if len(words) == 2 and words[0] == "NULLS" and words[1] in ("FIRST", "LAST"):
        nulls_first = words[1] == "FIRST"
        words = []
    if words:
        raise ValueError(f"not an order spec: {spec!r}")
    return name, descending, nulls_first


def order_column(spec: str) -> Column:
    name, descending, nulls_first = parse_order(spec)
    col = F.col(name)
    if descending:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def ordered(df: DataFrame, *specs: str) -> DataFrame:
    """Globally sorted by order specs."""
    return df.orderBy(*order_columns(specs))


def order_columns(specs: Sequence[str]) -> list[Column]:
    return [order_column(spec) for spec in specs]
