"""Gap filling: buckets without rows appear too, optionally carried forward or interpolated.

The series of a key is cut into blocks of buckets, and each (key, block) is a window of its own. So no task ever holds
a whole series, however few keys there are. A row of the aggregate expands into itself and the empty buckets up to the
next row of its block; nothing is shuffled after that expansion. When a series needs more than one block, a summary with
one row per (key, block) carries the last known value forward and the next known value back across blocks, and stands in
for blocks without any row.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.buckets import from_position, index_position, position, time_literal
from chronofold.functions.widths import Width, as_instant, bucket_index_at, parse_width
from chronofold.operators.bucketing import INDEX, Aggregates, group_by_index, time_type

# Up to this many buckets a series is one block: about a megabyte per filled column in one task.
BLOCK_BUCKETS = 65_536

_BLOCK = "__block"
_NEXT = "__next_index"
_FROM = "__from_index"
_AT = "__at"


def _range(df: DataFrame, width: Width, ts: str, dtype: T.DataType, start: Any, finish: Any) -> tuple[int, int] | None:
    """First and last bucket number. Only a bound that the caller left out costs a scan (of the time column alone)."""
    low = None if start is None else as_instant(start)
    high = None if finish is None else as_instant(finish) - 1
    if low is None or high is None:
        seen_low, seen_high = df.agg(position(F.min(ts), dtype), position(F.max(ts), dtype)).first()
        low = seen_low if low is None else low
        high = seen_high if high is None else high
        if low is None or high is None:
            return None
    if high < low:
        return None
    return bucket_index_at(low, width), bucket_index_at(high, width)


def _point(at: str, value: str) -> Column:
    return F.struct(F.col(at).alias("at"), F.col(value).alias("value"))


def _known(name: str) -> Column:
    """(bucket number, value) of a row whose value is known, else null."""
    return F.when(F.col(name).isNotNull(), _point(INDEX, name))


def _with_carries(
    rows: DataFrame, keys: Sequence[str], filled: Sequence[str], block_size: int, first: int, last: int
) -> DataFrame:
    """Adds the known values on both sides of each block, and a row for every block that has none."""
    blocks = (last - first) // block_size + 1
    aggs = []
    for c in filled:
        known_at = F.when(F.col(c).isNotNull(), F.col(INDEX))
        aggs += [F.max(known_at).alias(f"__last_at_{c}"), F.max_by(c, known_at).alias(f"__last_value_{c}")]
        aggs += [F.min(known_at).alias(f"__first_at_{c}"), F.min_by(c, known_at).alias(f"__first_value_{c}")]
    # The summary reads every column of the rows, not only those it needs. So it has the same input as the rows
    # themselves, Spark reuses that shuffle, and the raw table is scanned once.
    hashable = [name for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    every = F.max(F.xxhash64(*hashable)).alias("__every")
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_BLOCK)
    back = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc(_BLOCK))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.groupBy(*keys, _BLOCK).agg(every, *aggs).where(F.col("__every").isNotNull())
    sides = [
        F.when(F.col(f"__{side}_at_{c}").isNotNull(), _point(f"__{side}_at_{c}", f"__{side}_value_{c}")).alias(f"__{side}_{c}")
        for c in filled
        for side in ("last", "first")
    ]
    summary = summary.select(*keys, _BLOCK, *sides).select(
        *keys,
        _BLOCK,
        F.lead(_BLOCK).over(along).alias("__next_block"),
        F.lag(_BLOCK).over(along).isNull().alias("__is_first"),
        *[F.col(f"__{side}_{c}") for c in filled for side in ("last", "first")],
        *[F.last(f"__last_{c}", ignorenulls=True).over(earlier).alias(f"__before_{c}") for c in filled],
        *[F.last(f"__first_{c}", ignorenulls=True).over(later).alias(f"__after_{c}") for c in filled],
    )
    carries = [f"__{side}_{c}" for c in filled for side in ("before", "after")]
    with_carries = (
        rows.alias("r")
        .join(
            summary.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.col(_BLOCK).alias("__key_block"), *carries),
            _same([(f"r.{k}", f"__key_{k}") for k in keys] + [(f"r.{_BLOCK}", "__key_block")]),
            "left",
        )
        .select("r.*", *carries)
        if filled
        else rows
    )

    def block_range(low: Column, high: Column) -> Column:
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

    after_this = block_range(F.col(_BLOCK) + 1, F.coalesce(F.col("__next_block"), F.lit(blocks)) - 1)
    empty_after = summary.select(
        *keys,
        F.explode(after_this).alias(_BLOCK),
        *[F.coalesce(f"__last_{c}", f"__before_{c}").alias(f"__before_{c}") for c in filled],
        *[F.col(f"__after_{c}") for c in filled],
    )
    before_first = summary.where("__is_first").select(
        *keys,
        F.explode(block_range(F.lit(0).cast("bigint"), F.col(_BLOCK) - 1)).alias(_BLOCK),
        *[F.col(f"__before_{c}") for c in filled],
        *[F.coalesce(f"__first_{c}", f"__after_{c}").alias(f"__after_{c}") for c in filled],
    )
    # A row behind the end of its block: all it does is expand into the buckets before it.
    behind = F.least((F.col(_BLOCK) + 1) * block_size + first, F.lit(last + 1).cast("bigint"))
    empty = empty_after.unionByName(before_first).withColumn(INDEX, behind)
    return with_carries.unionByName(empty, allowMissingColumns=True)


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for left, right in pairs:
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


def gapfill(
    df: DataFrame,
    width: Any,
    ts: str,
    aggs: Aggregates,
    keys: Sequence[str] = (),
    start: Any = None,
    finish: Any = None,
    locf: Sequence[str] = (),
    interpolate: Sequence[str] = (),
    bucket: str = "bucket",
    block_buckets: int = BLOCK_BUCKETS,
) -> DataFrame:
    """Aggregate per key and bucket, with a row for every bucket of the range.

    The range is ``[start, finish)`` and rows outside it are left out; a missing bound is the lowest or highest bucket
    of the whole input, the same for every key. ``locf`` names aggregates to carry forward over buckets without a
    value (null before the first one). ``interpolate`` names aggregates to fill with the straight line between the
    known values on both sides (null outside them); the result keeps the aggregate's type.
    """
    width = parse_width(width)
    dtype = time_type(df, ts)
    keys, locf, interpolate = list(keys), list(locf), list(interpolate)
    filled = [*locf, *interpolate]
    if set(locf) & set(interpolate) or not set(filled) <= set(aggs):
        raise ValueError("locf and interpolate name different aggregates of this call")
    if start is not None:
        df = df.where(F.col(ts) >= time_literal(start, dtype))
    if finish is not None:
        df = df.where(F.col(ts) < time_literal(finish, dtype))
    df = df.where(F.col(ts).isNotNull())

    rows = group_by_index(df, width, ts, aggs, keys)
    types = {f.name: f.dataType for f in rows.schema.fields}
    bounds = _range(df, width, ts, dtype, start, finish)
    if bounds is None:
        empty_time = from_position(F.col(INDEX), dtype).alias(bucket)
        return rows.where(F.lit(False)).select(*keys, empty_time, *aggs)
    first, last = bounds
    # With s buckets per block there are n / s blocks, so neither grows beyond the square root of a long series.
    block_size = max(block_buckets, isqrt(last - first) + 1)
    one_block = last - first < block_size

    if not keys:
        # One row behind the end, so that an empty range still expands.
        seed = df.sparkSession.range(1).select(F.lit(last + 1).cast("bigint").alias(INDEX))
        rows = rows.unionByName(seed, allowMissingColumns=True)
    block = F.call_function("div", F.least(F.col(INDEX), F.lit(last)) - F.lit(first), F.lit(block_size).cast("bigint"))
    rows = rows.withColumn(_BLOCK, F.lit(0).cast("bigint") if one_block else block)
    if not one_block:
        rows = _with_carries(rows, keys, filled, block_size, first, last)

    along = Window.partitionBy(*keys, _BLOCK).orderBy(INDEX)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Looking ahead means looking back in reverse order: Spark grows a frame that starts at the partition's start row by
    # row, but evaluates one that ends at the partition's end anew for every row.
    ahead = Window.partitionBy(*keys, _BLOCK).orderBy(F.desc(INDEX)).rowsBetween(Window.unboundedPreceding, -1)
    block_start = F.col(_BLOCK) * F.lit(block_size) + F.lit(first)
    block_stop = F.least(block_start + F.lit(block_size), F.lit(last + 1).cast("bigint"))
    windowed = [
        F.coalesce(F.lead(INDEX).over(along), block_stop).alias(_NEXT),
        F.when(F.lag(INDEX).over(along).isNull(), block_start).otherwise(F.col(INDEX)).alias(_FROM),
    ]
    for c in filled:
        known = _known(c)
        windowed.append(F.last(known, ignorenulls=True).over(upto).alias(f"__upto_{c}"))
        if c in interpolate:
            windowed.append(F.last(known, ignorenulls=True).over(ahead).alias(f"__ahead_{c}"))
    dense = (
        rows.select("*", *windowed)
        .where(F.col(_FROM) < F.col(_NEXT))
        .withColumn(_AT, F.explode(F.sequence(_FROM, F.col(_NEXT) - 1)))
    )

    at, own = F.col(_AT), F.col(INDEX)

    def carried(side: str, c: str, near: Column) -> Column:
        return near if one_block else F.coalesce(near, F.col(f"__{side}_{c}"))

    def value(c: str) -> Column:
        seen = F.when(at == own, F.col(c))
        if c not in filled:
            return seen.alias(c)
        previous = carried("before", c, F.when(at >= own, F.col(f"__upto_{c}")))
        if c in locf:
            return F.coalesce(seen, previous["value"]).alias(c)
        following = F.coalesce(F.when(at < own, _known(c)), F.col(f"__ahead_{c}"))
        following = carried("after", c, following)
        t, t0, t1 = (index_position(i, width).cast("double") for i in (at, previous["at"], following["at"]))
        y0, y1 = previous["value"].cast("double"), following["value"].cast("double")
        line = y0 + (y1 - y0) * (t - t0) / (t1 - t0)
        return F.coalesce(seen, line.cast(types[c])).alias(c)

    bucket_time = from_position(index_position(at, width), dtype).alias(bucket)
    return dense.select(*keys, bucket_time, *[value(c) for c in aggs])
