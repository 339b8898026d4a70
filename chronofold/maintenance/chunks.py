"""Jobs over chunks: compress, merge, decompress, reorder, drop.

Each job picks chunks from the manifest, rewrites all of them in one Spark job per layout, checks the row count and
publishes. None of them changes a row, except that :func:`drop_chunks` removes whole chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from chronofold.functions.buckets import INTEGER_TYPES, check_width, index_of_position, index_position
from chronofold.functions.widths import Width, as_instant, before, parse_width
from chronofold.operators.ordering import order_columns
from chronofold.plans.spec import TableSpec, check_skip_column
from chronofold.sources.hypertable import commit, pick, read_picked, write_generation
from chronofold.sources.manifest import Table, TableError

# How chunks are relabelled: (start, end) columns in, (start, end) columns out.
Relabel = Callable[[Column, Column], tuple[Column, Column]]


def instant_now(table: Table, now: Any) -> int:
    """The "now" of a job in the time column's unit. Integer time has no clock, so there it must be given."""
    integer = isinstance(table.state.time_type, INTEGER_TYPES)
    if now is None:
        if integer:
            raise TableError("a table with integer time needs now= in the unit of its time column")
        now = datetime.now(timezone.utc)
    if integer != (isinstance(now, int) and not isinstance(now, bool)):
        raise TableError(f"now={now!r} does not fit the type of {table.state.spec.time}")
    return as_instant(now)


def cutoff(table: Table, age: Any, now: Any) -> int:
    width = parse_width(age, allow_zero=True)
    check_width(width, table.state.time_type)
    return before(instant_now(table, now), width)


def _unchanged(start: Column, end: Column) -> tuple[Column, Column]:
    return start, end


def rewrite(
    table: Table,
    chosen: Column,
    relabel: Relabel = _unchanged,
    sort: Sequence[Column] = (),
    compressed: bool = False,
    skip_columns: Sequence[str] = (),
    purge: bool = True,
    **changes: Any,
) -> Table:
    """Write the chunks that meet a condition again and publish them in place of the old ones."""
    labels = [c.alias(n) for c, n in zip(relabel(F.col("chunk"), F.col("until")), ("to_chunk", "to_until"), strict=True)]
    picked = pick(table, chosen, *labels)
    if not picked:
        return table.publish(**changes) if changes else table
    written = []
    for layout in sorted({row["layout"] for row in picked}):
        mine = [row for row in picked if row["layout"] == layout]
        rows = read_picked(table, mine, keep_folder_columns=True)
        start, end = relabel(F.col("_chunk"), F.col("_until"))
        others = [c for c in rows.columns if c not in ("_chunk", "_until")]
        rows = rows.select(*others, start.alias("_chunk"), end.alias("_until"))
        new = write_generation(table, rows, layout, sort, compressed, skip_columns)
        written.append(_with_ranges(table, new, mine))
    result = commit(table, written, table.chunks().where(~chosen), sum(row["rows"] for row in picked), **changes)
    if purge:
        result.discard(picked)
    return result


def _with_ranges(table: Table, new: DataFrame, old: Sequence[Row]) -> DataFrame:
    """A rewritten chunk stands for the range of the chunks it was made from, and its rows changed when theirs last did."""
    known: dict[tuple[int, int], tuple[int, int, int]] = {}
    for row in old:
        label, since = (row["to_chunk"], row["to_until"]), row["gen"] if row["since"] is None else row["since"]
        low, high, last = known.get(label, (row["lo"], row["hi"], since))
        known[label] = min(low, row["lo"]), max(high, row["hi"]), max(last, since)
    rows = [(*label, *found) for label, found in known.items()]
    ranges = table.spark.createDataFrame(rows, "chunk bigint, until bigint, lo bigint, hi bigint, since bigint")
    return new.drop("lo", "hi", "since").join(ranges, ["chunk", "until"])


def _span_of(start: Column, span: Width) -> tuple[Column, Column]:
    index = index_of_position(start, span)
    return index_position(index, span), index_position(index + 1, span)


def _fits(start: Column, end: Column, span: Width, limit: int | None) -> Column:
    """Chunks that lie inside one span whose end is old enough."""
    high = _span_of(start, span)[1]
    return (end <= high) if limit is None else (end <= high) & (high <= limit)


def _merging(span: Width, limit: int | None) -> Relabel:
    """Label the chunks of a span as that span."""

    def relabel(start: Column, end: Column) -> tuple[Column, Column]:
        fits = _fits(start, end, span, limit)
        low, high = _span_of(start, span)
        return F.when(fits, low).otherwise(start), F.when(fits, high).otherwise(end)

    return relabel


def compress_chunks(spark: SparkSession, path: str, older_than: Any = None, now: Any = None, purge: bool = True) -> None:
    """Compress every chunk whose end is at least ``older_than`` ago; by default the spec's ``compress_after``, else all.

    Rows are clustered by ``segment_by`` and sorted by ``order_by``, so that Parquet's own statistics can skip row
    groups, and the smallest and largest value of each skip column goes into the manifest. With ``merge_up_to`` the
    chunks of one span become one chunk as soon as the whole span qualifies. Rows that streamed batches left for the same
    bucket of a rollup are put into one first.
    """
    table = Table.at(spark, path)
    spec = table.state.spec
    if not spec.columnstore:
        raise TableError(f"the columnstore of {path} is off")
    if table.state.split:
        from chronofold.rollups.rollup import fold

        fold(spark, path, purge)
        table = Table.at(spark, path)
    age = spec.compress_after if older_than is None else older_than
    limit = None if age is None else cutoff(table, age, now)
    chosen = ~F.col("compressed")
    if limit is not None:
        chosen = chosen & (F.col("hi") <= limit)
    relabel = _unchanged
    if spec.merge_up_to is not None:
        span = parse_width(spec.merge_up_to)
        relabel = _merging(span, limit)
        fits = _fits(F.col("chunk"), F.col("until"), span, limit)
        low = _span_of(F.col("chunk"), span)[0]
        # Compressed chunks of a span join in when another chunk of the same span is about to be merged.
        merging = [row[0] for row in table.chunks().where(chosen & fits).select(low).distinct().collect()]
        chosen = chosen | (fits & low.isin(merging))
    sort = [F.col(name) for name in spec.segment_by]
    sort += order_columns(spec.order_by or (f"{spec.time} DESC",))
    rewrite(table, chosen, relabel, sort, True, spec.skip_columns, purge)


def decompress(
    spark: SparkSession, path: str, auto: bool | None = None, disable: bool = False, purge: bool = True
) -> None:
    """Rewrite every compressed chunk without clustering; with ``disable`` also switch the columnstore off.

    With ``auto`` false (or the spec's ``auto_decompress`` off) nothing is rewritten, and switching the columnstore off
    is refused while a chunk is compressed.
    """
    table = Table.at(spark, path)
    spec = table.state.spec
    auto = spec.auto_decompress if auto is None else auto
    changes: dict[str, Any] = {}
    if disable:
        off = {"columnstore": False, "segment_by": (), "order_by": (), "merge_up_to": None, "compress_after": None}
        changes["spec"] = TableSpec(**{**spec.to_dict(), **off})
    compressed = F.col("compressed")
    if not auto:
        if not table.chunks().where(compressed).isEmpty():
            raise TableError(f"{path} has compressed chunks, and auto_decompress is off")
        if changes:
            table.publish(**changes)
        return
    rewrite(table, compressed, purge=purge, **changes)


def reorder(spark: SparkSession, path: str, columns: Sequence[str] = (), purge: bool = True) -> None:
    """Cluster every chunk that is not compressed by some columns (default: the spec's ``reorder_by``)."""
    table = Table.at(spark, path)
    columns = [columns] if isinstance(columns, str) else list(columns or table.state.spec.reorder_by)
    if not columns:
        raise TableError("reorder needs columns")
    rewrite(table, ~F.col("compressed"), sort=order_columns(columns), purge=purge)


def drop_chunks(spark: SparkSession, path: str, older_than: Any = None, now: Any = None, purge: bool = True) -> None:
    """Drop whole chunks whose end is at least ``older_than`` ago (default: the spec's ``drop_after``). Irreversible.

    The manifest without them is published first, then their folders are deleted. A chunk that is only partly old stays.
    """
    table = Table.at(spark, path)
    age = table.state.spec.drop_after if older_than is None else older_than
    if age is None:
        raise TableError("drop_chunks needs an age")
    parse_width(age)
    limit = cutoff(table, age, now)
    old = F.col("hi") <= limit
    picked = pick(table, old)
    if not picked:
        return
    ends = [row["hi"] for row in picked]
    if table.state.dropped_until is not None:
        ends.append(table.state.dropped_until)
    drops = (*(d for d in table.state.drops if d[1] > limit), (table.next_version, limit))
    result = commit(table, [], table.chunks().where(~old), dropped_until=max(ends), drops=drops)
    if purge:
        result.discard(picked)


def enable_chunk_skipping(spark: SparkSession, path: str, column: str) -> None:
    """Keep the smallest and largest value of a column for every chunk that is compressed from now on."""
    table = Table.at(spark, path)
    spec = table.state.spec
    if column not in table.state.schema.names:
        raise TableError(f"column {column!r} is not in {path}")
    check_skip_column(column, table.state.schema)
    if column not in spec.skip_columns:
        table.publish(spec=TableSpec(**{**spec.to_dict(), "skip_columns": (*spec.skip_columns, column)}))


def disable_chunk_skipping(spark: SparkSession, path: str, column: str) -> None:
    """Forget the values kept for a column."""
    table = Table.at(spark, path)
    spec = table.state.spec
    if column in spec.skip_columns:
        kept = tuple(c for c in spec.skip_columns if c != column)
        forget_stats(table, [column], spec=TableSpec(**{**spec.to_dict(), "skip_columns": kept}))


def forget_stats(table: Table, columns: Sequence[str], **changes: Any) -> Table:
    """Publish the same chunks without the values kept for some columns."""
    kept = F.map_filter("stats", lambda name, _: ~name.isin(list(columns)))
    return commit(table, [], table.chunks().withColumn("stats", kept), **changes)


def purge(spark: SparkSession, path: str) -> None:
    """Delete what jobs left behind: replaced or dropped chunks, unfinished generations, old manifests."""
    Table.at(spark, path).purge()
