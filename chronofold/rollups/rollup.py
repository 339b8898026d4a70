"""Stored rollups: created, refreshed by window, read in real time, stacked, redefined, dropped.

A rollup is a chunked table of its own, so it is scanned, compressed and expired by the same jobs as raw data. A refresh
recomputes whole buckets from the source chunks inside its window and replaces just those rollup chunks; the other
buckets of a chunk that is only half inside the window are carried over. An incremental refresh recomputes only buckets
that no refresh has taken in yet, or whose source chunks changed since: the rollup knows for each stretch of time the
version of the source up to which it is complete, and the source's manifest knows the version that changed each chunk.

Besides its values a bucket keeps the states of its parts, one per source chunk (:mod:`chronofold.rollups.states`). Parts
whose chunk was dropped by retention stay, all others are computed anew.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.buckets import index_time, position, time_literal
from chronofold.functions.widths import as_instant, bucket_ceiling, bucket_end, bucket_floor, parse_width
from chronofold.maintenance.chunks import cutoff
from chronofold.operators.bucketing import INDEX, group_by_index, time_type
from chronofold.plans.spec import RollupSpec, SpecError
from chronofold.rollups.coverage import OPEN, Stretch, fewer, intersection, stale, union, with_stretch
from chronofold.rollups.states import BATCH, PARTS, UNTIL, VERSION, Mergeable, exploded_parts, mergeable, merged_parts, part_rows
from chronofold.sources.hypertable import (
    commit,
    conform,
    new_table,
    pick,
    read_picked,
    scan,
    visible,
    with_chunk_columns,
    write_generation,
)
from chronofold.sources.manifest import Table, TableError


def _filtered(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    if spec.where is not None:
        rows = rows.where(spec.where)
    return rows.where(F.col(spec.time).isNotNull())


def aggregate(rows: DataFrame, spec: RollupSpec) -> DataFrame:
    """The rollup of some source rows, without the states of its parts."""
    grouped = group_by_index(_filtered(rows, spec), spec.width, spec.time, spec.aggs, spec.keys)
    bucket = index_time(F.col(INDEX), spec.width, time_type(rows, spec.time))
    return grouped.select(bucket.alias(spec.bucket), *spec.keys, *spec.aggs)


def states(rows: DataFrame, spec: RollupSpec, merges: dict[str, Mergeable], version: int, batch: str | None = None) -> DataFrame:
    """The parts of some source rows that carry the end of their chunk, as rows."""
    made = part_rows(_filtered(rows, spec), spec.width, spec.time, spec.keys, merges, version, batch)
    bucket = index_time(F.col(INDEX), spec.width, time_type(rows, spec.time))
    return made.select(bucket.alias(spec.bucket), *spec.keys, *[c for c in made.columns if c not in (INDEX, *spec.keys)])


def _empty_source(spark: SparkSession, source: Table) -> DataFrame:
    return visible(spark.createDataFrame([], source.state.schema))


def _stored_columns(spark: SparkSession, source: Table, spec: RollupSpec) -> T.StructType:
    """The columns of the rollup: bucket, keys, values, and the parts where all aggregates have states that merge."""
    empty = _empty_source(spark, source)
    values = aggregate(empty, spec).schema
    merges = mergeable(spec.aggs, empty)
    if merges is None:
        return values
    parts = merged_parts(states(empty.withColumn(UNTIL, F.lit(0).cast("bigint")), spec, merges, 0), [spec.bucket, *spec.keys], merges)
    return T.StructType([*values.fields, T.StructField(PARTS, _nullable(parts.schema[PARTS].dataType))])


def _nullable(dtype: T.DataType) -> T.DataType:
    """The same type with nulls everywhere, as files have it."""
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _nullable(dtype.valueType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    return dtype


def _rollup_at(spark: SparkSession, path: str) -> tuple[Table, RollupSpec]:
    table = Table.at(spark, path)
    if table.state.rollup is None:
        raise TableError(f"{path} is not a rollup")
    return table, table.state.rollup


def _any_of(name: str | Column, stretches: Sequence[Stretch], dtype: Any) -> Column:
    """Whether a time column lies in one of some stretches."""
    time = F.col(name) if isinstance(name, str) else name
    found = F.lit(False)
    for low, high in stretches:
        inside = F.lit(True)
        if low > -OPEN:
            inside = inside & (time >= time_literal(low, dtype))
        if high < OPEN:
            inside = inside & (time < time_literal(high, dtype))
        found = found | inside
    return found


def _meeting(stretches: Sequence[Stretch], low: str, high: str) -> Column:
    """Chunks whose range [low, high) meets one of some stretches."""
    found = F.lit(False)
    for a, b in stretches:
        found = found | ((F.col(high) > a) & (F.col(low) < b))
    return found


def _source_rows(spark: SparkSession, source: str, stretches: Sequence[Stretch]) -> DataFrame:
    """Source rows in some stretches, with the end of their chunk; a rollup as source gives what reading it gives."""
    table = Table.at(spark, source)
    state = table.state
    if state.rollup is not None and (state.split or not state.rollup.materialized_only):
        span = stretches[0][0], stretches[-1][1]
        start, end = (None if abs(p) >= OPEN else p for p in span)
        rows = read_rollup(spark, source, start, end)
        ends = with_chunk_columns(rows, state).withColumn(UNTIL, F.col("_until")).select(*rows.columns, UNTIL)
    else:
        chosen = _meeting(stretches, "lo", "hi")
        rows = read_picked(table, pick(table, chosen), keep_folder_columns=True)
        # A merged chunk is dropped at the end of the chunks it was made from, not at that of its span.
        merged = table.chunks().where("hi <> until").groupBy("chunk", "until").agg(F.max("hi").alias(UNTIL))
        if merged.isEmpty():
            rows = rows.withColumn(UNTIL, F.col("_until"))
        else:
            ends_at = merged.select(F.col("chunk").alias("_chunk"), F.col("until").alias("_until"), UNTIL)
            rows = rows.join(ends_at, ["_chunk", "_until"], "left").withColumn(UNTIL, F.coalesce(UNTIL, "_until"))
        ends = visible(rows.select(*state.schema.names, UNTIL))
    return ends.where(_any_of(state.spec.time, stretches, state.time_type))


def _dropped(source: Table, until: Column, version: Column) -> Column:
    """Whether the chunk that a part was made from has been dropped since."""
    found = F.lit(False)
    for dropped_at, limit in source.state.drops:
        found = found | ((version < dropped_at) & (until <= limit))
    return found


def _recomputed(table: Table, spec: RollupSpec, stored: DataFrame, stretches: Sequence[Stretch], unseen: Sequence[Stretch]) -> DataFrame:
    """What the buckets in some stretches are now: parts from the source, and stored parts whose chunks are gone.

    `stored` are the stored rows of these stretches, `unseen` the stretches of the source that they haven't taken in.
    """
    spark = table.spark
    source = Table.at(spark, spec.source)
    rows = _source_rows(spark, spec.source, stretches)
    by = [spec.bucket, *spec.keys]
    if PARTS not in table.state.schema.names:
        fresh = aggregate(rows.drop(UNTIL), spec)
        return conform(_beside_frozen(fresh, stored, source, spec, unseen, refuse=True), table.state.schema)
    merges = mergeable(spec.aggs, _empty_source(spark, source))
    parts = states(rows, spec, merges, source.state.version)
    if source.state.drops:
        kept = exploded_parts(stored, by)
        parts = parts.unionByName(kept.where(_dropped(source, F.col(UNTIL), F.col(VERSION))))
    found = conform(merged_parts(parts, by, merges), table.state.schema)
    if source.state.dropped_until is None:
        return found
    # Buckets without parts were put there by a stream; they can be kept, but not added to.
    whole = stored.where(F.col(PARTS).isNull())
    return found if whole.isEmpty() else _beside_frozen(found, whole, source, spec, unseen, refuse=False)


def _beside_frozen(fresh: DataFrame, stored: DataFrame, source: Table, spec: RollupSpec, unseen: Sequence[Stretch], refuse: bool) -> DataFrame:
    """Fresh buckets, and those stored ones that have lost source rows to retention in place of fresh ones."""
    limit = source.state.dropped_until
    if limit is None:
        return fresh
    dtype, width = source.state.time_type, parse_width(spec.width)
    frozen = stored.where(F.col(spec.bucket) < time_literal(limit, dtype))
    start = bucket_floor(limit, width)
    if refuse and start < limit:
        new = intersection(unseen, [(limit, bucket_end(limit, width))])
        cut = stored.where(F.col(spec.bucket) == time_literal(start, dtype)) if new else None
        if cut is not None and not cut.isEmpty():
            name = cut.first()[spec.bucket]
            raise TableError(
                f"the bucket {name} has lost source rows to retention and new ones have come; its aggregates have no"
                " states that can be added to (only sum, count, min, max, avg, min_by and max_by have)"
            )
    # The two sides read different source chunks, so nothing is aggregated twice.
    early = fresh.where(F.col(spec.bucket) < time_literal(limit, dtype))
    early = early.join(frozen.select(spec.bucket).distinct(), spec.bucket, "left_anti")
    late = fresh.where(F.col(spec.bucket) >= time_literal(limit, dtype))
    return late.unionByName(early).unionByName(frozen.select(*fresh.columns))


def create_rollup(spark: SparkSession, path: str, spec: RollupSpec, with_data: bool = False) -> None:
    """Create a rollup: empty, or with every bucket of the source."""
    source = Table.at(spark, spec.source)
    if spec.time != source.state.spec.time:
        raise SpecError(f"a rollup buckets the time column of its source, {source.state.spec.time!r}")
    columns = _stored_columns(spark, source, spec)
    new_table(spark, columns, path, spec.table_spec(), rollup=spec).publish()
    _link(spark, spec.source, path)
    if with_data:
        refresh(spark, path)


def _link(spark: SparkSession, source: str, path: str) -> None:
    """The source remembers who is built on it."""
    table, name = Table.at(spark, source), path.rstrip("/")
    if name not in table.state.dependents:
        table.publish(dependents=(*table.state.dependents, name))


def _unlink(spark: SparkSession, source: str, path: str) -> None:
    try:
        table = Table.at(spark, source)
    except TableError:
        return
    left = tuple(name for name in table.state.dependents if name != path.rstrip("/"))
    if left != table.state.dependents:
        table.publish(dependents=left)


def _built_on(spark: SparkSession, path: str) -> list[str]:
    """The rollups built directly on a table that are still there and still read it."""
    found = []
    for name in Table.at(spark, path).state.dependents:
        try:
            spec = _rollup_at(spark, name)[1]
        except TableError:
            continue
        if spec.source.rstrip("/") == path.rstrip("/"):
            found.append(name)
    return found


def dependents_of(spark: SparkSession, path: str) -> list[str]:
    """All rollups built on a table or rollup, directly or through others, sources before dependents."""
    found: list[str] = []
    waiting = _built_on(spark, path)
    while waiting:
        name = waiting.pop()
        if name not in found:
            found.append(name)
            waiting += _built_on(spark, name)
    return refresh_order(spark, found)


def _changes(source: Table, after: int) -> list[tuple[int, int, int]]:
    """(first time, behind the last, version) of source chunks that changed after a version: small rows, one per chunk."""
    since = F.coalesce("since", F.col("gen").cast("bigint"))
    rows = source.chunks().where((since > after) & F.col("min_time").isNotNull())
    return [tuple(r) for r in rows.select("min_time", F.col("max_time") + 1, since).collect()]


def _aligned(stretches: Sequence[Stretch], spec: RollupSpec, low: int, high: int) -> list[Stretch]:
    """Whole buckets, inside a window of whole buckets."""
    width = parse_width(spec.width)
    whole = ((a if a <= -OPEN else bucket_floor(a, width), b if b >= OPEN else bucket_ceiling(b, width)) for a, b in stretches)
    return fewer(intersection(union(whole), [(low, high)]))


def refresh(
    spark: SparkSession, path: str, start: Any = None, end: Any = None, purge: bool = True, incremental: bool = False
) -> None:
    """Recompute the buckets that lie entirely in ``[start, end)``; an open side means everything there.

    With ``incremental`` only those that were never taken in, or whose source chunks have changed since; without any no
    file is written. Parts of buckets whose source chunks were dropped by retention stay as they are; rows that come later
    are added to them. Buckets whose aggregates have no states that merge stay whole in that case; new rows for one that
    the retention limit cuts raise an error.
    """
    table, spec = _rollup_at(spark, path)
    width = parse_width(spec.width)
    lo = -OPEN if start is None else bucket_ceiling(as_instant(start), width)
    hi = OPEN if end is None else bucket_floor(as_instant(end), width)
    if lo >= hi:
        return
    source = Table.at(spark, spec.source)
    covered = table.state.covered
    seen = min((v for a, b, v in covered if a < hi and b > lo), default=0)
    unseen = stale(covered, lo, hi, _changes(source, seen))
    highest = source.chunks().agg(F.max("max_time")).first()[0]
    until = lo if highest is None else min(hi, bucket_end(highest, width))
    # What lies behind the last row of the source is no gap: there is nothing to take in.
    unseen = intersection(unseen, [(lo, max(until, lo))])
    stretches = _aligned(unseen, spec, lo, hi) if incremental else [(lo, hi)]
    if not stretches:
        return
    covered = with_stretch(covered, lo, until, source.state.version)
    _replace_buckets(table, spec, stretches, unseen, purge, covered)


def _replace_buckets(table: Table, spec: RollupSpec, stretches: Sequence[Stretch], unseen: Sequence[Stretch], purge: bool, covered: Any) -> None:
    """Put recomputed buckets in place of the stored ones in some stretches."""
    touched = _meeting(stretches, "lo", "hi")
    replaced = pick(table, touched)
    stored = _one_row_each(table, spec, read_picked(table, replaced))
    inside = _any_of(spec.bucket, stretches, table.state.time_type)
    rows = _recomputed(table, spec, stored.where(inside), stretches, unseen).unionByName(stored.where(~inside))
    _publish(table, spec, rows, touched, replaced if purge else [], covered=covered)


def _touched(lo: int | None, hi: int | None) -> Column:
    """Chunks whose range meets ``[lo, hi)``."""
    return _meeting([(-OPEN if lo is None else lo, OPEN if hi is None else hi)], "lo", "hi")


def _publish(table: Table, spec: RollupSpec, rows: DataFrame, touched: Column, replaced: Sequence[Row], **changes: Any) -> None:
    def high_water(highest: int | None) -> dict[str, Any]:
        known = table.state.high_water
        if highest is None:
            return {}
        end = bucket_end(highest, parse_width(spec.width))
        return {"high_water": end if known is None else max(known, end)}

    new = write_generation(table, with_chunk_columns(rows, table.state), table.state.layout)
    result = commit(table, [new], table.chunks().where(~touched), from_highest=high_water, **changes)
    result.discard(replaced)


def _one_row_each(table: Table, spec: RollupSpec, rows: DataFrame, without: str | None = None) -> DataFrame:
    """Stored rows with one row per bucket and keys; streamed batches leave several. `without` leaves a batch out."""
    if not table.state.split and without is None:
        return rows
    by = [spec.bucket, *spec.keys]
    merges = mergeable(spec.aggs, _empty_source(table.spark, Table.at(table.spark, spec.source)))
    parts = exploded_parts(rows, by)
    if without is not None:
        parts = parts.where(~F.col(BATCH).eqNullSafe(F.lit(without)))
    merged = conform(merged_parts(parts, by, merges), table.state.schema)
    return merged.unionByName(rows.where(F.col(PARTS).isNull()))


def _merged_scan(table: Table, spec: RollupSpec, start: Any, end: Any) -> DataFrame:
    low = -OPEN if start is None else as_instant(start)
    high = OPEN if end is None else as_instant(end)
    stored = read_picked(table, pick(table, _meeting([(low, high)], "lo", "hi")))
    return visible(_one_row_each(table, spec, _ranged(stored, spec, table, start, end)))


def add_batch(spark: SparkSession, path: str, rows: DataFrame, stream: str, number: int) -> None:
    """Add the states of a streamed batch of source rows to a rollup, as files of their own; no file is written again.

    The rollup knows the number of the last batch of each stream. A batch that is replayed takes the place of what it wrote
    before: the chunks it meets are written again without its parts, and with them as they are now.
    """
    table, spec = _rollup_at(spark, path)
    if PARTS not in table.state.schema.names:
        raise SpecError("only sum, count, min, max, avg, min_by and max_by can be added to; stream closed buckets instead")
    source = Table.at(spark, spec.source)
    names = [name for name in source.state.schema.names if name not in (PARTS,)]
    labelled = with_chunk_columns(conform(rows, _empty_source(spark, source).schema).where(F.col(spec.time).isNotNull()), source.state)
    labelled = labelled.withColumn(UNTIL, F.col("_until")).select(*names, UNTIL)
    merges = mergeable(spec.aggs, _empty_source(spark, source))
    tag = f"{stream}:{number}"
    parts = states(labelled, spec, merges, source.state.version, tag)
    fresh = conform(merged_parts(parts, [spec.bucket, *spec.keys], merges), table.state.schema)
    streams = {**table.state.streams, stream: max(number, table.state.streams.get(stream, number))}
    if number > table.state.streams.get(stream, -1):
        _publish(table, spec, fresh, F.lit(False), [], streams=streams, split=True)
        return
    at = position(spec.bucket, table.state.time_type)
    low, high = fresh.agg(F.min(at), F.max(at)).first()
    if low is None:
        return
    touched = _touched(low, high + 1)
    replaced = pick(table, touched)
    kept = _one_row_each(table, spec, read_picked(table, replaced), without=tag)
    _publish(table, spec, kept.unionByName(fresh), touched, replaced, split=True)


def fold(spark: SparkSession, path: str, purge: bool = True) -> None:
    """Put the rows that streamed batches left for the same bucket into one, chunk by chunk."""
    table, spec = _rollup_at(spark, path)
    if not table.state.split:
        return
    several = table.chunks().groupBy("lo", "hi").agg(F.count("*").alias("n")).where("n > 1")
    stretches = fewer(union((r["lo"], r["hi"]) for r in several.collect()))
    if not stretches:
        table.publish(split=False)
        return
    touched = _meeting(stretches, "lo", "hi")
    replaced = pick(table, touched)
    rows = _one_row_each(table, spec, read_picked(table, replaced))
    _publish(table, spec, rows, touched, replaced if purge else [], split=False)


def upsert_buckets(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Put complete buckets in place of the stored ones with the same bucket and keys. Doing it twice changes nothing."""
    table, spec = _rollup_at(spark, path)
    if PARTS in table.state.schema.names and PARTS not in rows.columns:
        rows = rows.withColumn(PARTS, F.lit(None).cast(table.state.schema[PARTS].dataType))
    rows = conform(rows, table.state.schema)
    time = position(spec.bucket, table.state.time_type)
    lowest, highest = rows.agg(F.min(time), F.max(time)).first()
    if lowest is None:
        return
    touched = _touched(lowest, highest + 1)
    replaced = pick(table, touched)
    stored = read_picked(table, replaced).alias("stored")
    same = F.lit(True)
    for name in (spec.bucket, *spec.keys):
        same = same & F.col(f"stored.{name}").eqNullSafe(F.col(f"new.{name}"))
    kept = stored.join(rows.alias("new"), same, "left_anti")
    _publish(table, spec, rows.unionByName(kept), touched, replaced)


def run_refresh_policy(spark: SparkSession, path: str, now: Any = None, purge: bool = True, incremental: bool = False) -> None:
    """Refresh the window from ``now - start_offset`` to ``now - end_offset``."""
    table, spec = _rollup_at(spark, path)
    if spec.start_offset is None:
        raise TableError(f"{path} has no refresh offsets")
    refresh(spark, path, cutoff(table, spec.start_offset, now), cutoff(table, spec.end_offset, now), purge, incremental)


def read_rollup(
    spark: SparkSession, path: str, start: Any = None, end: Any = None, realtime: bool | None = None, holes: bool = False
) -> DataFrame:
    """Stored buckets; in real time also those of the source rows behind the highest stored bucket.

    With ``holes`` everything that no refresh has taken in is computed from the source: stretches before, between and behind
    what was refreshed, and buckets whose source chunks changed since, so the result is that of a refresh just now.
    """
    table, spec = _rollup_at(spark, path)
    if holes:
        return _read_over_holes(table, spec, start, end)
    stored = _merged_scan(table, spec, start, end) if table.state.split else scan(spark, path, start=start, end=end)
    realtime = not spec.materialized_only if realtime is None else realtime
    if not realtime:
        return stored
    width = parse_width(spec.width)
    mark = table.state.high_water
    lo = None if start is None else bucket_floor(as_instant(start), width)
    lo = max((p for p in (lo, mark) if p is not None), default=None)
    hi = None if end is None else bucket_ceiling(as_instant(end), width)
    if lo is not None and hi is not None and lo >= hi:
        return stored
    rows = _source_rows(spark, spec.source, [(-OPEN if lo is None else lo, OPEN if hi is None else hi)])
    return stored.unionByName(_ranged(conform(aggregate(rows.drop(UNTIL), spec), stored.schema), spec, table, start, end))


def _ranged(rows: DataFrame, spec: RollupSpec, table: Table, start: Any, end: Any) -> DataFrame:
    bucket = F.col(spec.bucket)
    if start is not None:
        rows = rows.where(bucket >= time_literal(start, table.state.time_type))
    if end is not None:
        rows = rows.where(bucket < time_literal(end, table.state.time_type))
    return rows


def _read_over_holes(table: Table, spec: RollupSpec, start: Any, end: Any) -> DataFrame:
    spark, width = table.spark, parse_width(spec.width)
    lo = -OPEN if start is None else bucket_floor(as_instant(start), width)
    hi = OPEN if end is None else bucket_ceiling(as_instant(end), width)
    source = Table.at(spark, spec.source)
    seen = min((v for _, _, v in table.state.covered), default=0)
    unseen = stale(table.state.covered, lo, hi, _changes(source, seen))
    stretches = _aligned(unseen, spec, lo, hi)
    if not stretches:
        return read_rollup(spark, table.path, start, end, realtime=False)
    stored = _one_row_each(table, spec, read_picked(table, pick(table, _meeting([(lo, hi)], "lo", "hi"))))
    inside = _any_of(spec.bucket, stretches, table.state.time_type)
    found = _recomputed(table, spec, stored.where(inside), stretches, unseen).unionByName(stored.where(~inside))
    return _ranged(visible(found), spec, table, start, end)


def refresh_order(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Rollups with sources before dependents. A cycle is an error."""
    names = [path.rstrip("/") for path in paths]
    sources = {name: _rollup_at(spark, name)[1].source.rstrip("/") for name in names}
    return order_by_source(sources)


def order_by_source(sources: dict[str, str]) -> list[str]:
    graph = {name: [source] if source in sources else [] for name, source in sources.items()}
    try:
        return list(TopologicalSorter(graph).static_order())
    except CycleError as wrong:
        raise SpecError(f"rollups depend on each other: {' -> '.join(wrong.args[1])}") from wrong


def refresh_tree(
    spark: SparkSession, paths: Sequence[str], start: Any = None, end: Any = None, incremental: bool = False, cascade: bool = False
) -> list[str]:
    """Refresh rollups that may be built on each other, with ``cascade`` also all built on them; returns the order."""
    names = dict.fromkeys(path.rstrip("/") for path in paths)
    if cascade:
        names |= dict.fromkeys(name for path in paths for name in dependents_of(spark, path))
    order = refresh_order(spark, names)
    for path in order:
        refresh(spark, path, start, end, incremental=incremental)
    return order


def redefine(spark: SparkSession, path: str, spec: RollupSpec, dependents: Sequence[str] = (), cascade: bool = True) -> bool:
    """Give a rollup another definition. When its rows change, it and all rollups built on it are computed anew.

    Returns whether that was needed. Settings such as offsets and ages change without touching rows. The rollups built on it
    are known to it; ``dependents`` names further ones, and without ``cascade`` only those follow. A dependent whose time
    column is gone is an error, raised before anything changes.
    """
    table, old = _rollup_at(spark, path)
    if old.same_rows(spec):
        table.publish(rollup=spec, spec=spec.table_spec().resolved(table.state.schema))
        return False
    known = dependents_of(spark, path) if cascade else []
    order = refresh_order(spark, dict.fromkeys(name.rstrip("/") for name in (*dependents, *known)))
    source = Table.at(spark, spec.source)
    if spec.time != source.state.spec.time:
        raise SpecError(f"a rollup buckets the time column of its source, {source.state.spec.time!r}")
    for name in order:
        above = _rollup_at(spark, name)[1]
        if above.source.rstrip("/") == path.rstrip("/") and above.time != spec.bucket:
            raise SpecError(f"{name} buckets {above.time!r}, which the new definition does not have")
    schema = _stored_columns(spark, source, spec)
    highest = source.chunks().agg(F.max("max_time")).first()[0]
    covered = () if highest is None else ((-OPEN, bucket_end(highest, parse_width(spec.width)), source.state.version),)
    state = replace(
        table.state,
        schema=schema,
        spec=spec.table_spec().resolved(schema),
        rollup=spec,
        layouts=(*table.state.layouts, ()),
        dropped_until=None,
        drops=(),
        high_water=None,
        covered=covered,
    )
    target = replace(table, state=state)
    none = spark.createDataFrame([], schema)
    everything = [(-OPEN, OPEN)]
    _publish(target, spec, _recomputed(target, spec, none, everything, everything), F.lit(True), pick(table, F.lit(True)))
    if spec.source.rstrip("/") != old.source.rstrip("/"):
        _unlink(spark, old.source, path)
    _link(spark, spec.source, path)
    for name in order:
        refresh(spark, name)
    return True


def drop_rollups(spark: SparkSession, paths: Sequence[str], cascade: bool = False) -> list[str]:
    """Delete rollups, dependents before their sources; returns the order.

    Rollups that are built on them and not among them are deleted as well with ``cascade``; without it they are an error, and
    nothing is deleted.
    """
    names = dict.fromkeys(path.rstrip("/") for path in paths)
    above = [name for path in paths for name in dependents_of(spark, path) if name not in names]
    if above and not cascade:
        raise TableError(f"{', '.join(dict.fromkeys(above))} would lose its source; drop it as well, or pass cascade=True")
    order = refresh_order(spark, [*names, *dict.fromkeys(above)])[::-1]
    for path in order:
        table, spec = _rollup_at(spark, path)
        _unlink(spark, spec.source, path)
        table.folder.delete("manifest")
        table.folder.delete()
    return order
