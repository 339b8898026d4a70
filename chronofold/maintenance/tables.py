"""Changes of a whole table: plain to chunked and back, another time column, other dimensions, another spec."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.maintenance.chunks import decompress, forget_stats
from chronofold.plans.changes import DECOMPRESS, REBUILD, SET_SPEC, RebuildRefused, plan_change
from chronofold.plans.spec import TableSpec
from chronofold.sources.hypertable import (
    commit,
    create_filled,
    new_table,
    read_live,
    visible,
    with_chunk_columns,
    write_generation,
)
from chronofold.sources.manifest import Table, TableError


def checksum(df: DataFrame) -> tuple[int, int, int]:
    """Rows, and two order-free sums over their hashes: equal for tables with the same rows."""
    digest = F.xxhash64(*[F.col(f"`{name}`") for name in sorted(df.columns)])
    low = F.sum(digest.bitwiseAND(F.lit(0xFFFFF)))
    row = df.agg(F.count("*"), F.coalesce(F.bit_xor(digest), F.lit(0)), F.coalesce(low, F.lit(0))).first()
    return tuple(row)


def _compare(before: DataFrame, after: DataFrame, where: str) -> None:
    old, new = checksum(before), checksum(after)
    if old != new:
        raise TableError(f"{where}: the copy has {new[0]} rows and differs from the {old[0]} rows it was made from")


def convert(df: DataFrame, path: str, spec: TableSpec, migrate_data: bool | None = None) -> None:
    """Make a chunked table from a plain one, with all its rows.

    With ``migrate_data`` off only an empty table can be converted. The source is left as it is.
    """
    migrate = spec.migrate_data if migrate_data is None else migrate_data
    if not migrate:
        if not df.isEmpty():
            raise TableError("the table has rows, and migrate_data is off")
        new_table(df.sparkSession, df.schema, path, spec).publish()
        return
    create_filled(df, path, spec, expected=df.count())


def rebuild(
    spark: SparkSession, path: str, new_spec: TableSpec, rebuild_data: bool | None = None, purge: bool = True
) -> None:
    """Copy every row into the layout of another spec, in the same folder: new time column, other dimensions."""
    table = Table.at(spark, path)
    state = table.state
    if not (new_spec.rebuild_data if rebuild_data is None else rebuild_data):
        raise RebuildRefused("a rebuild copies every row, and rebuild_data is off")
    if state.rollup is not None:
        raise TableError("a rollup is rebuilt by redefine")
    spec = new_spec.resolved(state.schema)
    same_time = spec.time == state.spec.time
    dropped = {"dropped_until": state.dropped_until, "drops": state.drops} if same_time else {"dropped_until": None, "drops": ()}
    # The rebuilt table always gets a layout of its own, so no folder mixes two meanings of a partition column.
    layouts = (*state.layouts, tuple(spec.dims.items()))
    fresh = replace(state, spec=spec, layouts=layouts, **dropped)
    target = replace(table, state=fresh)
    rows = with_chunk_columns(read_live(table), fresh)
    total = table.chunks().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    result = commit(target, [write_generation(target, rows, fresh.layout)], None, total)
    if purge:
        result.purge()


def to_plain(
    spark: SparkSession,
    path: str,
    target: str,
    rebuild_data: bool | None = None,
    verify: bool = True,
    drop_source: bool = False,
) -> None:
    """Write all rows of a chunked table as plain Parquet. ``verify`` compares rows and checksum before the source goes."""
    table = Table.at(spark, path)
    if not (table.state.spec.rebuild_data if rebuild_data is None else rebuild_data):
        raise RebuildRefused("a rebuild copies every row, and rebuild_data is off")
    rows = visible(read_live(table)) if table.state.rollup is not None else read_live(table)
    rows.write.mode("errorifexists").parquet(target)
    if verify:
        _compare(rows, spark.read.schema(rows.schema).parquet(target), target)
    if drop_source:
        table.folder.delete()


def alter(spark: SparkSession, path: str, new_spec: TableSpec, purge: bool = True) -> list[str]:
    """Bring a table to a new spec, copying rows only where that is unavoidable; returns the steps taken."""
    table = Table.at(spark, path)
    new_spec = new_spec.resolved(table.state.schema)
    steps = plan_change(table.state.spec, new_spec)
    for step in steps:
        if step == REBUILD:
            rebuild(spark, path, new_spec, purge=purge)
        elif step == DECOMPRESS:
            decompress(spark, path, auto=new_spec.auto_decompress, disable=True, purge=purge)
        elif step == SET_SPEC:
            table = Table.at(spark, path)
            state = table.state.with_dims(new_spec.dims)
            dropped = set(table.state.spec.skip_columns) - set(new_spec.skip_columns)
            if dropped:
                forget_stats(table, sorted(dropped), spec=new_spec, layouts=state.layouts)
            else:
                table.publish(spec=new_spec, layouts=state.layouts)
    return steps
