"""Chunked tables: create, append, scan and the layout report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.buckets import (
    from_position,
    index_of_position,
    index_position,
    position,
    time_literal,
)
from chronofold.functions.widths import as_instant, parse_width
from chronofold.plans.spec import TableSpec
from chronofold.sources.manifest import State, Table, TableError, dim_column
from chronofold.sources.predicates import chunk_condition

PARTITION_TYPES = {"_run": T.StringType(), "_chunk": T.LongType(), "_until": T.LongType()}


# What rollups store besides their columns.
HIDDEN = ("__parts",)


def visible(rows: DataFrame) -> DataFrame:
    """Rows without hidden columns."""
    return rows.drop(*HIDDEN)


def hash_bucket(value: Column, partitions: int) -> Column:
    return F.pmod(F.hash(value), F.lit(partitions))


def partition_schema(names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(name, PARTITION_TYPES.get(name, T.IntegerType())) for name in names]


def with_chunk_columns(df: DataFrame, state: State) -> DataFrame:
    """Adds the folder columns of the current layout. A row without a time fails the job."""
    spec, dtype = state.spec, state.time_type
    width = parse_width(spec.chunk)
    missing = F.raise_error(F.lit(f"{spec.time} is null: a chunked table needs a time in every row")).cast("bigint")
    time = F.coalesce(position(spec.time, dtype), missing)
    index = index_of_position(time, width)
    return df.select(
        "*",
        index_position(index, width).alias("_chunk"),
        index_position(index + 1, width).alias("_until"),
        *[hash_bucket(F.col(name), n).alias(dim_column(name)) for name, n in state.layouts[-1]],
    )


# Types of columns that chunks can have minima and maxima of.
SKIP_TYPES = ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz")


def write_generation(
    table: Table,
    df: DataFrame,
    layout: int,
    sort: Sequence[Column] = (),
    compressed: bool = False,
    skip_columns: Sequence[str] = (),
) -> DataFrame:
    """Write rows that carry their folder columns as the next generation; returns its manifest rows (not published).

    The rebalance brings the rows of a chunk together, and cuts a chunk that is larger than the advisory partition size
    into several tasks, so a chunk or hash bucket that holds most of the data is written in parallel. Sorted rows are dealt
    by ranges of chunk and sort columns, whose ends Spark samples: the files of a large chunk have ranges of their own, so
    their statistics can skip whole files, and small neighbours are put together by their bytes.
    """
    parts = table.partition_columns(layout)
    table.refuse_if_published()
    target = table.folder.url(table.generation(layout, table.next_version))
    if sort:
        out = df.repartitionByRange(*parts, *sort).sortWithinPartitions(*parts, *sort)
    else:
        out = df.hint("rebalance", *parts)
    writer = out.write.mode("errorifexists").partitionBy(*parts)
    if compressed:
        writer = writer.option("compression", "zstd")
    writer.parquet(target)
    return chunk_rows(table, layout, table.next_version, compressed, skip_columns)


def chunk_rows(table: Table, layout: int, gen: int, compressed: bool, skip_columns: Sequence[str]) -> DataFrame:
    """Manifest rows of a written generation, counted from the files themselves.

    Reads the time column and the skip columns only, and shuffles one row per chunk and task.
    """
    state = table.state
    parts = table.partition_columns(layout)
    if not table.folder.has(table.generation(layout, gen), "_chunk="):
        return table.chunks(0)
    stored = read_folders(table, layout, gen, [table.generation(layout, gen)])
    time, time_type = state.spec.time, state.time_type
    columns = [(name, state.schema[name].dataType) for name in skip_columns]
    # Each file has exactly one first row, so files and bytes need no second aggregation.
    first_row = F.col("_metadata.row_index") == 0
    per_chunk = stored.groupBy(*parts).agg(
        F.count("*").alias("rows"),
        position(F.min(time), time_type).alias("min_time"),
        position(F.max(time), time_type).alias("max_time"),
        F.count_if(first_row).alias("files"),
        F.sum(F.when(first_row, F.col("_metadata.file_size"))).alias("bytes"),
        *[position(F.min(c), kind).alias(f"min_{i}") for i, (c, kind) in enumerate(columns)],
        *[position(F.max(c), kind).alias(f"max_{i}") for i, (c, kind) in enumerate(columns)],
    )

    def as_map(pairs: list[Column], kind: str) -> Column:
        return (F.create_map(*pairs) if pairs else F.create_map()).cast(kind)

    buckets = [c for name in table.dims(layout) for c in (F.lit(name), F.col(dim_column(name)))]
    stats = [
        c
        for i, name in enumerate(skip_columns)
        for c in (F.lit(name), F.struct(F.col(f"min_{i}").alias("lo"), F.col(f"max_{i}").alias("hi")))
    ]
    return per_chunk.select(
        F.lit(layout).alias("layout"),
        F.lit(gen).alias("gen"),
        F.col("_chunk").alias("chunk"),
        F.col("_until").alias("until"),
        as_map(buckets, "map<string,int>").alias("buckets"),
        F.col("_chunk").alias("lo"),
        F.col("_until").alias("hi"),
        "rows",
        "min_time",
        "max_time",
        "files",
        "bytes",
        F.lit(compressed).alias("compressed"),
        F.lit(gen).cast("bigint").alias("since"),
        as_map(stats, "map<string,struct<lo:bigint,hi:bigint>>").alias("stats"),
    )


def read_folders(table: Table, layout: int, gen: int | None, folders: Sequence[str]) -> DataFrame:
    """Stored rows of some folders of one layout, with their folder columns."""
    base = f"data/L{layout}" if gen is None else table.generation(layout, gen)
    found = []
    for with_run in (True, False):  # old generations have no run, and one read takes folders of one depth
        names = [name for name in folders if ("/_run=" in name) == with_run]
        if names:
            extra = [] if gen is not None else ["_gen", *["_run"] * with_run]
            columns = partition_schema([*extra, *table.partition_columns(layout)])
            reader = table.spark.read.schema(T.StructType([*table.state.schema.fields, *columns]))
            found.append(reader.option("basePath", table.folder.url(base)).parquet(*map(table.folder.url, names)).drop("_run"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def commit(
    table: Table,
    new_rows: Sequence[DataFrame],
    keep: DataFrame | None,
    expected: int | None = None,
    from_highest: Callable[[int | None], dict[str, Any]] | None = None,
    **changes: Any,
) -> Table:
    """Publish new generations next to the chunks to keep, after checking that no row was lost or added.

    ``from_highest`` gives further changes of the state from the highest time in the table.
    """
    version = table.next_version
    chunks = table.chunks(0) if keep is None else keep
    for rows in new_rows:
        chunks = chunks.unionByName(rows)
    generations = (
        table.write_chunks(chunks)
        .groupBy("layout", "gen")
        .agg(F.count("*").alias("folders"), F.sum("rows").alias("rows"), F.max("max_time").alias("highest"))
        .collect()
    )
    stored = sum(g["rows"] for g in generations if g["gen"] == version)
    if expected is not None and stored != expected:
        raise TableError(f"{stored} rows were written instead of {expected}; {table.path} is unchanged")
    folders = {}
    for g in generations:
        written = g["folders"] if g["gen"] == version else table.folders_written(g["layout"], g["gen"])
        folders[f"{g['layout']}/{g['gen']}"] = (written, g["folders"])
    if from_highest is not None:
        changes.update(from_highest(max((g["highest"] for g in generations), default=None)))
    return table.publish(new_chunks=True, folders=folders, **changes)


def create_hypertable(df: DataFrame, path: str, spec: TableSpec) -> None:
    """Write a table cut into chunks by time and into hash partitions. Fails on a row without a time."""
    create_filled(df, path, spec)


def new_table(spark: SparkSession, columns: T.StructType, path: str, spec: TableSpec, **state: Any) -> Table:
    """A table without chunks, not published yet."""
    spec = spec.resolved(columns)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in columns.fields])
    fresh = State(spec=spec, schema=schema, layouts=(tuple(spec.dims.items()),), **state)
    return Table.new(spark, path, fresh)


def create_filled(df: DataFrame, path: str, spec: TableSpec, expected: int | None = None) -> None:
    table = new_table(df.sparkSession, df.schema, path, spec)
    rows = write_generation(table, with_chunk_columns(df, table.state), table.state.layout)
    commit(table, [rows], None, expected)


def append(df: DataFrame, path: str) -> None:
    """Add rows, in the table's present chunk width and dimensions."""
    table = Table.at(df.sparkSession, path)
    if table.state.rollup is not None:
        raise TableError("a rollup is filled by refresh, not by append")
    rows = write_generation(table, with_chunk_columns(conform(df, table.state.schema), table.state), table.state.layout)
    commit(table, [rows], table.chunks())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same columns in the table's order and types; another set of columns is an error."""
    if set(df.columns) != set(schema.names):
        raise TableError(f"columns {sorted(df.columns)} do not match the table's {sorted(schema.names)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def overlapping(lo: int | None, hi: int | None, low: str, high: str) -> Column:
    """Chunks whose closed range [low, high] may hold a value in [lo, hi)."""
    found = F.lit(True)
    if lo is not None:
        found = found & (F.col(high) >= lo)
    if hi is not None:
        found = found & (F.col(low) < hi)
    return found


def pick(table: Table, condition: Column, *more: Column) -> list[Row]:
    """Manifest rows that meet a condition, brought to the driver: one small row per chunk."""
    return table.chunks().where(condition).select("*", *more).collect()


def read_live(table: Table) -> DataFrame:
    """All rows. A generation whose chunks are all live is read as one folder, without a look at its chunks."""
    parts = [(layout, gen) for layout, gen, whole in table.generations() if not whole]
    folders: dict[int, list[str]] = {}
    for layout, gen, whole in table.generations():
        if whole:
            folders.setdefault(layout, []).append(table.generation(layout, gen))
    if parts:
        of_parts = F.lit(False)
        for layout, gen in parts:
            of_parts = of_parts | ((F.col("layout") == layout) & (F.col("gen") == gen))
        for row in pick(table, of_parts):
            folders.setdefault(row["layout"], []).append(table.chunk_folder(row["layout"], row["gen"], row))
    return _union(table, [read_folders(table, layout, None, names) for layout, names in sorted(folders.items())])


def read_picked(table: Table, picked: Sequence[Row], keep_folder_columns: bool = False) -> DataFrame:
    """The rows of picked chunks.

    Only the picked folders are listed and opened; a generation that is picked as a whole is passed as one folder. The
    folder columns are filtered as well, which shows as ``PartitionFilters``.
    """
    generations: dict[tuple[int, int], list[Row]] = {}
    for row in picked:
        generations.setdefault((row["layout"], row["gen"]), []).append(row)
    folders: dict[int, list[str]] = {}
    span: dict[int, tuple[int, int]] = {}
    for (layout, gen), rows in generations.items():
        starts = [row["chunk"] for row in rows]
        low, high = span.get(layout, (starts[0], starts[0]))
        span[layout] = min(low, *starts), max(high, *starts)
        whole = len(rows) == table.folders_written(layout, gen)
        names = [table.generation(layout, gen)] if whole else [table.chunk_folder(layout, gen, row) for row in rows]
        folders.setdefault(layout, []).extend(names)
    found = []
    for layout, names in sorted(folders.items()):
        low, high = span[layout]
        rows = read_folders(table, layout, None, names)
        found.append(rows.where((F.col("_chunk") >= low) & (F.col("_chunk") <= high)))
    return _union(table, found, keep_folder_columns)


def _union(table: Table, parts: Sequence[DataFrame], keep_folder_columns: bool = False) -> DataFrame:
    schema = table.state.schema
    if not parts:
        if keep_folder_columns:
            schema = T.StructType([*schema.fields, *partition_schema(table.partition_columns(table.state.layout))])
        return table.spark.createDataFrame([], schema)
    if not keep_folder_columns:
        parts = [rows.select(*schema.names) for rows in parts]
    found = parts[0]
    for rows in parts[1:]:
        found = found.unionByName(rows, allowMissingColumns=True)
    return found.drop("_gen")


def chunk_filter(
    table: Table,
    start: Any = None,
    end: Any = None,
    equals: Mapping[str, Any] | None = None,
    ranges: Mapping[str, tuple[Any, Any]] | None = None,
) -> Column:
    """The chunks that a scan with these filters has to open, as a condition on manifest rows."""
    state = table.state
    lo = None if start is None else as_instant(start)
    hi = None if end is None else as_instant(end)
    wanted = overlapping(lo, hi, "min_time", "max_time")
    sizes = {name: {n for dims in state.layouts for d, n in dims if d == name} for name in (equals or {})}
    for name, value in (equals or {}).items():
        typed = F.lit(value).cast(state.schema[name].dataType)
        for size in sizes[name]:
            layouts = [i for i, dims in enumerate(state.layouts) if (name, size) in dims]
            bucket = F.element_at("buckets", F.lit(name))
            wanted = wanted & (~F.col("layout").isin(layouts) | (bucket == hash_bucket(typed, size)))
    for name, (low, high) in (ranges or {}).items():
        if state.schema[name].dataType.typeName() not in SKIP_TYPES:
            continue  # no minima are kept for it; the row filter does the work
        kept = F.element_at("stats", F.lit(name))
        inside = F.lit(True)
        if low is not None:
            inside = inside & (kept["hi"] >= as_instant(low))
        if high is not None:
            inside = inside & (kept["lo"] < as_instant(high))
        wanted = wanted & (kept.isNull() | kept["lo"].isNull() | inside)
    return wanted


def scan(
    spark: SparkSession,
    path: str,
    start: Any = None,
    end: Any = None,
    equals: Mapping[str, Any] | None = None,
    ranges: Mapping[str, tuple[Any, Any]] | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """Rows of a chunked table with ``start <= time < end``, equal values and ``low <= column < high`` ranges.

    The filters first decide which chunks are opened: time by the chunk's range, equality on a hash dimension by its
    bucket, ranges on skip columns by the compressed chunk's smallest and largest value. They then apply to the rows
    and reach the Parquet reader. So does ``where``, any condition: its comparisons of the time column, of hash dimensions and
    of skip columns with constants, under ``AND``, ``OR``, ``IN`` and ``BETWEEN``, decide on chunks too.
    """
    table = Table.at(spark, path)
    state = table.state
    known = set(state.schema.names)
    for name in [*(equals or {}), *(ranges or {})]:
        if name not in known:
            raise TableError(f"column {name!r} is not in {path}")
    shown = visible if state.rollup is not None else lambda rows: rows
    if start is None and end is None and not equals and not ranges and where is None:
        return shown(read_live(table))
    wanted = chunk_filter(table, start, end, equals, ranges)
    if where is not None:
        wanted = wanted & chunk_condition(table, where, hash_bucket)
    rows = read_picked(table, pick(table, wanted))
    if where is not None:
        rows = rows.where(where)
    time = F.col(state.spec.time)
    if start is not None:
        rows = rows.where(time >= time_literal(start, state.time_type))
    if end is not None:
        rows = rows.where(time < time_literal(end, state.time_type))
    for name, value in (equals or {}).items():
        rows = rows.where(F.col(name) == F.lit(value).cast(state.schema[name].dataType))
    for name, (low, high) in (ranges or {}).items():
        dtype = state.schema[name].dataType
        if low is not None:
            rows = rows.where(F.col(name) >= _bound(low, dtype))
        if high is not None:
            rows = rows.where(F.col(name) < _bound(high, dtype))
    return shown(rows)


def _bound(value: Any, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return time_literal(value, dtype)
    return F.lit(value).cast(dtype)


def scan_joined(spark: SparkSession, path: str, other: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Rows of a chunked table joined with a few rows of another one, by equal columns that include hash dimensions.

    The hash bucket is a further join key. It is a folder column, so when the other side is filtered and small enough to be
    broadcast, Spark's dynamic partition pruning opens only the folders of the buckets it needs. ``how`` is inner or left_semi.
    """
    if how not in ("inner", "left_semi"):
        raise TableError("only inner and left_semi joins can leave out chunks of the table")
    table = Table.at(spark, path)
    state = table.state
    on = [on] if isinstance(on, str) else list(on)
    for name in on:
        if name not in state.schema.names:
            raise TableError(f"column {name!r} is not in {path}")
    found = []
    for number in sorted({layout for layout, _, _ in table.generations()}):
        dims = [(name, n) for name, n in state.layouts[number] if name in on]
        rows = _live_of_layout(table, number)
        buckets = {dim_column(name): hash_bucket(F.col(name).cast(state.schema[name].dataType), n) for name, n in dims}
        joined = rows.join(other.withColumns(buckets) if buckets else other, [*on, *buckets], how)
        found.append(visible(joined.drop(*[c for c in rows.columns if c not in state.schema.names])))
    if not found:
        return visible(spark.createDataFrame([], state.schema)).join(other, on, how)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _live_of_layout(table: Table, number: int) -> DataFrame:
    """The live rows of one layout, with their folder columns."""
    names = []
    for layout, gen, whole in table.generations():
        if layout == number and whole:
            names.append(table.generation(layout, gen))
        elif layout == number:
            rows = pick(table, (F.col("layout") == layout) & (F.col("gen") == gen))
            names += [table.chunk_folder(layout, gen, row) for row in rows]
    return read_folders(table, number, None, names)


def latest(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The ``n`` rows with the highest times, newest first; of equal times any.

    Running sums of row counts over the chunks, from the newest, tell the time behind which there are ``n`` rows; only
    chunks that reach behind it are opened. The driver sees one number, and the rows of the manifest that are picked.
    """
    table = Table.at(spark, path)
    time = table.state.spec.time
    if n <= 0:
        return scan(spark, path).limit(0)
    order = (F.col("min_time").desc(), F.col("lo").desc(), F.col("gen").desc(), F.to_json("buckets"))
    # Every chunk has a row at least, so no more than the n newest chunks count.
    known = table.chunks().where(F.col("rows") > 0).orderBy(*order).limit(n)
    known = known.withColumn("through", F.sum("rows").over(Window.orderBy(*order)))
    edge = known.where(F.col("through") >= n).agg(F.max("min_time")).first()[0]
    rows = read_live(table) if edge is None else read_picked(table, pick(table, F.col("max_time") >= edge))
    if table.state.rollup is not None:
        rows = visible(rows)
    return rows.orderBy(F.col(time).desc()).limit(n)


def count_in_range(spark: SparkSession, path: str, start: Any = None, end: Any = None) -> DataFrame:
    """One row: rows, first_time and last_time of a table with ``start <= time < end``.

    Chunks that lie inside the range as a whole are answered from the manifest; rows are read only from chunks at its edges.
    """
    table = Table.at(spark, path)
    state = table.state
    lo = None if start is None else as_instant(start)
    hi = None if end is None else as_instant(end)
    inside = F.lit(True)
    if lo is not None:
        inside = inside & (F.col("min_time") >= lo)
    if hi is not None:
        inside = inside & (F.col("max_time") < hi)
    chunks = table.chunks().where(F.col("rows") > 0)
    known = chunks.where(inside).agg(F.sum("rows").alias("rows"), F.min("min_time").alias("low"), F.max("max_time").alias("high"))
    edges = read_picked(table, pick(table, overlapping(lo, hi, "min_time", "max_time") & ~inside & (F.col("rows") > 0)))
    time = F.col(state.spec.time)
    if lo is not None:
        edges = edges.where(time >= time_literal(lo, state.time_type))
    if hi is not None:
        edges = edges.where(time < time_literal(hi, state.time_type))
    at = position(state.spec.time, state.time_type)
    read = edges.agg(F.count("*").alias("rows"), F.min(at).alias("low"), F.max(at).alias("high"))
    both = known.unionByName(read).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
    times = (from_position(F.col(c), state.time_type).alias(name) for c, name in (("low", "first_time"), ("high", "last_time")))
    return both.select("rows", *times)


def layout(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk: its range, hash buckets, rows, first and last time, files, bytes and whether it is compressed.

    Read from the manifest, whose figures were counted from the files when they were written.
    """
    table = Table.at(spark, path)
    dtype = table.state.time_type
    chunks = table.chunks().withColumn("hash_buckets", F.to_json("buckets"))
    found = chunks.groupBy("lo", "hi", "hash_buckets").agg(
        F.sum("rows").alias("rows"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
        F.sum("files").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.every("compressed").alias("compressed"),
    )
    times = ("chunk_start", "lo"), ("chunk_end", "hi"), ("min_time", "min_time"), ("max_time", "max_time")
    as_time = {alias: from_position(F.col(name), dtype).alias(alias) for alias, name in times}
    return found.select(
        as_time["chunk_start"],
        as_time["chunk_end"],
        "hash_buckets",
        "rows",
        as_time["min_time"],
        as_time["max_time"],
        "files",
        "bytes",
        "compressed",
    )


def describe(spark: SparkSession, path: str) -> TableSpec:
    """The table's spec as it is in force now."""
    return Table.at(spark, path).state.spec
