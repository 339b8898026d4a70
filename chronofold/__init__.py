"""Time-series analytics on PySpark: time buckets, gap filling, chunked tables, stored rollups."""

from chronofold.functions import (
    first_by,
    generate_uuid7,
    histogram,
    last_by,
    register,
    time_bucket,
    time_bucket_date,
    time_bucket_int,
    to_uuid7,
    typed_bucket,
    uuid7_between,
    uuid7_timestamp,
    with_uuid7,
)
from chronofold.maintenance import (
    alter,
    checksum,
    compress_chunks,
    convert,
    decompress,
    disable_chunk_skipping,
    drop_chunks,
    enable_chunk_skipping,
    purge,
    rebuild,
    reorder,
    to_plain,
)
from chronofold.operators import bucket_by, gapfill, histogram_by, order_columns, ordered
from chronofold.plans import RebuildRefused, RollupSpec, SpecError, TableSpec, plan_change
from chronofold.rollups import (
    create_rollup,
    dependents_of,
    drop_rollups,
    read_rollup,
    redefine,
    refresh,
    refresh_tree,
    run_refresh_policy,
)
from chronofold.sources import TableError, append, count_in_range, create_hypertable, describe, latest, layout, scan, scan_joined
from chronofold.streaming import stream_rollup

__all__ = [
    "RebuildRefused",
    "RollupSpec",
    "SpecError",
    "TableError",
    "TableSpec",
    "alter",
    "append",
    "bucket_by",
    "checksum",
    "compress_chunks",
    "convert",
    "count_in_range",
    "create_hypertable",
    "create_rollup",
    "decompress",
    "dependents_of",
    "describe",
    "disable_chunk_skipping",
    "drop_chunks",
    "drop_rollups",
    "enable_chunk_skipping",
    "first_by",
    "gapfill",
    "generate_uuid7",
    "histogram",
    "histogram_by",
    "last_by",
    "latest",
    "layout",
    "order_columns",
    "ordered",
    "plan_change",
    "purge",
    "read_rollup",
    "rebuild",
    "redefine",
    "refresh",
    "refresh_tree",
    "register",
    "reorder",
    "run_refresh_policy",
    "scan",
    "scan_joined",
    "stream_rollup",
    "time_bucket",
    "time_bucket_date",
    "time_bucket_int",
    "to_plain",
    "to_uuid7",
    "typed_bucket",
    "uuid7_between",
    "uuid7_timestamp",
    "with_uuid7",
]
