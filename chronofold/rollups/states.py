"""Partial aggregates: what a rollup keeps besides its values, so that buckets can be put together from parts.

A bucket is the union of the source chunks it meets. Each of them is a part with states of its own, and the states of
parts merge into the bucket's values. When retention drops a chunk, its part stays as it was while the others are
computed anew, so neither the dropped rows nor rows that came later are lost.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.operators.bucketing import group_by_index

# Hidden column of a rollup: one struct per part of the bucket.
PARTS = "__parts"
# The end of the source chunk that a part was made from, and the source's version at that time.
UNTIL, VERSION = "__until", "__version"
# The streamed batch that a part came with; null for parts that a refresh made.
BATCH = "__batch"

CALL = re.compile(r"\s*(\w+)\s*\((.*)\)\s*", re.DOTALL)
SINGLE = ("sum", "count", "min", "max", "avg", "mean")
PICKS = ("min_by", "max_by")
FRACTIONS = (T.DoubleType, T.FloatType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Mergeable:
    """An aggregate whose states over parts give its value over all of them; states are named after its place."""

    kind: str
    args: tuple[str, ...]
    place: int

    @property
    def names(self) -> tuple[str, ...]:
        more = self.kind in ("avg", *PICKS)
        return (f"s{self.place}", f"t{self.place}") if more else (f"s{self.place}",)

    def make(self, rows: DataFrame) -> dict[str, Column]:
        """The states of source rows."""
        first = F.expr(self.args[0]) if self.args[0].strip() != "*" else F.lit(1)
        s, t = self.names[0], self.names[-1]
        if self.kind == "avg":
            kind = rows.select(first).schema[0].dataType
            if not isinstance(kind, (*FRACTIONS, T.DecimalType)):
                raise TypeError(f"avg of {kind.simpleString()}")
            wide = first if isinstance(kind, T.DecimalType) else first.cast("double")
            return {s: F.sum(wide), t: F.count(first)}
        if self.kind in PICKS:
            by = F.expr(self.args[1])
            picked = (F.min_by, F.min) if self.kind == "min_by" else (F.max_by, F.max)
            return {s: picked[0](first, by), t: picked[1](by)}
        return {s: {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[self.kind](first)}

    def merged(self) -> Column:
        """The value, from the states of the parts."""
        s, t = self.names[0], self.names[-1]
        if self.kind == "avg":
            return F.try_divide(F.sum(s), F.sum(t))
        if self.kind in PICKS:
            return (F.min_by if self.kind == "min_by" else F.max_by)(s, t)
        if self.kind == "count":
            return F.coalesce(F.sum(s), F.lit(0).cast("bigint"))
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](s)


def _parses(text: str, rows: DataFrame) -> bool:
    if not text.strip() or re.match(r"\s*(distinct|all)\b", text, re.IGNORECASE):
        return False
    try:
        rows.select(F.expr(text))
    except PySparkException:
        return False
    return True


def _arguments(text: str, count: int, rows: DataFrame) -> tuple[str, ...] | None:
    """The text as `count` arguments that Spark can parse and resolve; a comma may also be inside one of them."""
    if count == 1:
        return (text,) if _parses(text, rows) else None
    for comma in (m.start() for m in re.finditer(",", text)):
        parts = text[:comma], text[comma + 1 :]
        if all(_parses(p, rows) for p in parts):
            return parts
    return None


def mergeable(aggs: Mapping[str, str], rows: DataFrame) -> dict[str, Mergeable] | None:
    """Each aggregate as states that merge, or None when one of them is no plain sum, count, min, max, avg, min_by or max_by."""
    found = {}
    for place, (name, text) in enumerate(aggs.items()):
        call = CALL.fullmatch(text)
        kind = call[1].lower() if call else ""
        if kind == "count" and call[2].strip() == "*":
            args: tuple[str, ...] | None = ("*",)
        elif kind in SINGLE + PICKS:
            args = _arguments(call[2], 1 + (kind in PICKS), rows)
        else:
            return None
        if args is None:
            return None
        found[name] = Mergeable("avg" if kind == "mean" else kind, args, place)
        try:
            found[name].make(rows)
        except TypeError:
            return None
    return found


def part_rows(
    rows: DataFrame, width, time: str, keys, merges: Mapping[str, Mergeable], version: int, batch: str | None = None
) -> DataFrame:
    """States per bucket number, keys and source chunk, of rows that carry the end of their chunk as `UNTIL`."""
    made = {name: c for m in merges.values() for name, c in m.make(rows).items()}
    return group_by_index(rows, width, time, made, [*keys, UNTIL]).withColumns(
        {VERSION: F.lit(version).cast("bigint"), BATCH: F.lit(batch).cast("string")}
    )


def state_names(merges: Mapping[str, Mergeable]) -> list[str]:
    return [name for m in merges.values() for name in m.names]


def merged_parts(parts: DataFrame, by: list[str], merges: Mapping[str, Mergeable]) -> DataFrame:
    """One row per bucket and keys: the values, and the parts as a list. The shuffled rows are states, not source rows."""
    part = F.struct(UNTIL, VERSION, BATCH, *state_names(merges))
    return parts.groupBy(*by).agg(*(m.merged().alias(name) for name, m in merges.items()), F.collect_list(part).alias(PARTS))


def exploded_parts(rows: DataFrame, by: list[str]) -> DataFrame:
    """The parts of stored rows as rows."""
    return rows.select(*by, F.explode(PARTS).alias("part")).select(*by, "part.*")


