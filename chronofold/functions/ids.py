"""Time-ordered ids (UUID version 7), as 36-character text.

The first 48 bits are milliseconds since 1970, so ids sort by time and a range of ids is a range of time.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronofold.functions.buckets import column, require_utc
from chronofold.functions.widths import as_instant


def _from_millis(millis: Column) -> Column:
    clock = F.lower(F.lpad(F.hex(millis), 12, "0"))
    # A version 4 id already has the variant bits and the random bits where version 7 wants them.
    noise = F.uuid()
    made = F.concat(
        F.substring(clock, 1, 8), F.lit("-"), F.substring(clock, 9, 4), F.lit("-7"), F.substring(noise, 16, 21)
    )
    early = F.raise_error(F.lit("a time before 1970 does not fit a time-ordered id"))
    return F.when(millis < 0, early.cast("string")).when(millis.isNotNull(), made)


def generate_uuid7() -> Column:
    """A new id from the current time."""
    return _from_millis(F.unix_millis(F.current_timestamp()))


def to_uuid7(ts: Any) -> Column:
    """A new id that carries the given time. Null in, null out."""
    require_utc()
    return _from_millis(F.unix_millis(column(ts).cast("timestamp")))


def uuid7_timestamp(id_col: Any) -> Column:
    """The time inside an id, in milliseconds."""
    clock = F.substring(F.replace(column(id_col), F.lit("-"), F.lit("")), 1, 12)
    return F.timestamp_millis(F.conv(clock, 16, 10).cast("bigint"))


def _lowest(instant: int) -> str:
    """The lowest id of the first millisecond that is not before a time."""
    millis = -(-instant // 1000)
    if not 0 <= millis < 1 << 48:
        raise ValueError("a time outside the range of time-ordered ids")
    clock = f"{millis:012x}"
    return f"{clock[:8]}-{clock[8:]}-7000-8000-000000000000"


def uuid7_between(id_col: Any, start: Any = None, end: Any = None) -> Column:
    """Whether the time inside an id lies in ``[start, end)``, by comparing the id itself with constants.

    Ids sort like their times, so this reaches the Parquet filters and skips row groups, which ``uuid7_timestamp`` cannot.
    A null id gives null. Ids are the lower-case text that this library makes.
    """
    found = F.lit(True)
    if start is not None:
        found = found & (column(id_col) >= _lowest(as_instant(start)))
    if end is not None:
        found = found & (column(id_col) < _lowest(as_instant(end)))
    return found


def with_uuid7(df: DataFrame, ts: str, name: str = "id") -> DataFrame:
    """Stamp a table with time-ordered ids.

    The random bits differ from run to run; write the result out before using the ids on both sides of a join.
    """
    return df.withColumn(name, to_uuid7(ts))
