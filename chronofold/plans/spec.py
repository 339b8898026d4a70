"""What a chunked table and a rollup look like, and the checks on it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any

from pyspark.sql import types as T

from chronofold.functions.buckets import INTEGER_TYPES, TIME_TYPES, check_width
from chronofold.functions.widths import DEFAULT_CHUNK, parse_width, width_text
from chronofold.operators.ordering import parse_order

# Chunk skipping keeps exact smallest and largest values, so no floating point and no text.
SKIP_TYPES = TIME_TYPES
RESERVED = ("_chunk", "_until", "_gen", "_run", "_h_")


class SpecError(ValueError):
    """A spec that contradicts itself or the table's columns."""


def _need(condition: bool, message: str) -> None:
    if not condition:
        raise SpecError(message)


def _text(value: Any) -> Any:
    return None if value is None else width_text(value)


@dataclass(frozen=True)
class TableSpec:
    """A table cut into chunks by ``time``, and further by the hash of each column in ``dims``.

    ``chunk``            width of a chunk; a plain integer for integer time columns
    ``dims``             column -> number of hash partitions
    ``columnstore``      chunks may be compressed; implied by ``segment_by`` and ``order_by``
    ``segment_by``       columns that compressed rows are grouped by
    ``order_by``         order inside a segment, e.g. ``["time DESC"]``
    ``merge_up_to``      compressed neighbours are merged into chunks of this width
    ``compress_after``   age at which :func:`chronofold.compress_chunks` takes a chunk
    ``drop_after``       age at which :func:`chronofold.drop_chunks` drops a chunk
    ``reorder_by``       columns that :func:`chronofold.reorder` clusters a chunk by
    ``skip_columns``     columns whose smallest and largest value is kept per compressed chunk
    ``unique_keys``      column lists that are unique in the data; each must contain ``time``
    ``migrate_data``     converting a table moves its rows; if false only an empty table can be converted
    ``rebuild_data``     changes that must copy every row are allowed
    ``auto_decompress``  switching the columnstore off decompresses chunks first
    """

    time: str
    chunk: Any = None
    dims: Mapping[str, int] = field(default_factory=dict)
    columnstore: bool = False
    segment_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    merge_up_to: Any = None
    compress_after: Any = None
    drop_after: Any = None
    reorder_by: tuple[str, ...] = ()
    skip_columns: tuple[str, ...] = ()
    unique_keys: tuple[tuple[str, ...], ...] = ()
    migrate_data: bool = True
    rebuild_data: bool = True
    auto_decompress: bool = True

    def __post_init__(self) -> None:
        _need(isinstance(self.time, str), "a table has exactly one time column")
        put = lambda name, value: object.__setattr__(self, name, value)
        put("dims", dict(self.dims))
        for name in ("segment_by", "order_by", "reorder_by", "skip_columns"):
            value = getattr(self, name)
            put(name, (value,) if isinstance(value, str) else tuple(value))
        put("unique_keys", tuple(tuple(key) for key in self.unique_keys))
        for name in ("chunk", "merge_up_to", "compress_after", "drop_after"):
            put(name, _text(getattr(self, name)))
        put("columnstore", bool(self.columnstore or self.segment_by or self.order_by))

    def resolved(self, schema: T.StructType) -> TableSpec:
        """Checked against the table's columns, with the default chunk width filled in."""
        names = set(schema.names)
        _need(self.time in names, f"time column {self.time!r} is not in the table")
        dtype = schema[self.time].dataType
        _need(isinstance(dtype, TIME_TYPES), f"a {dtype.simpleString()} column cannot be the time column")
        integer = isinstance(dtype, INTEGER_TYPES)
        _need(not (integer and self.chunk is None), "an integer time column needs an integer chunk width")
        spec = self if self.chunk is not None else replace(self, chunk=DEFAULT_CHUNK)
        for name in ("chunk", "merge_up_to", "compress_after", "drop_after"):
            value = getattr(spec, name)
            if value is not None:
                try:
                    check_width(parse_width(value, allow_zero=name == "compress_after"), dtype)
                except (TypeError, ValueError) as wrong:
                    raise SpecError(f"{name}: {wrong}") from wrong
        for name in names:
            _need(not name.startswith(RESERVED), f"column name {name!r} is reserved")
        used = {*spec.dims, *spec.segment_by, *spec.reorder_by, *spec.skip_columns}
        ordered = [parse_order(order)[0] for order in spec.order_by]
        for name in used | set(ordered) | {c for key in spec.unique_keys for c in key}:
            _need(name in names, f"column {name!r} is not in the table")
        for name, partitions in spec.dims.items():
            _need(name != spec.time, "the time column cannot be a hash dimension")
            _need(isinstance(partitions, int) and partitions > 0, f"{name!r} needs at least one hash partition")
        for key in spec.unique_keys:
            _need(spec.time in key, f"unique key {key} must contain the time column")
        _need(not set(spec.segment_by) & set(ordered), "a column is either in segment_by or in order_by")
        _need(len(set(ordered)) == len(ordered), "a column appears twice in order_by")
        _need(spec.columnstore or spec.compress_after is None, "compress_after needs the columnstore")
        _need(spec.columnstore or spec.merge_up_to is None, "merge_up_to needs the columnstore")
        for name in spec.skip_columns:
            check_skip_column(name, schema)
        return spec

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: Mapping[str, Any]) -> TableSpec:
        return cls(**data)


def check_skip_column(name: str, schema: T.StructType) -> None:
    dtype = schema[name].dataType
    _need(isinstance(dtype, SKIP_TYPES), f"chunk skipping does not support {dtype.simpleString()} ({name})")


@dataclass(frozen=True)
class RollupSpec:
    """A stored aggregate per time bucket and keys of a chunked table, or of another rollup.

    ``source``             folder of the source table or rollup
    ``time``               the source's time column
    ``width``              bucket width
    ``aggs``               name -> aggregate as Spark SQL text, e.g. ``{"average": "avg(value)"}``
    ``keys``               further group columns
    ``where``              row filter as Spark SQL text
    ``chunk``              chunk width of the stored rollup (integer time: a raw number; default 1000 buckets)
    ``start_offset``, ``end_offset``   the window of a policy refresh, as ages; both or neither
    ``materialized_only``  false: reads add the rows that are not materialized yet
    """

    source: str
    time: str
    width: Any
    aggs: Mapping[str, str]
    keys: tuple[str, ...] = ()
    where: str | None = None
    bucket: str = "bucket"
    chunk: Any = None
    start_offset: Any = None
    end_offset: Any = None
    materialized_only: bool = True
    segment_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    compress_after: Any = None
    drop_after: Any = None

    def __post_init__(self) -> None:
        put = lambda name, value: object.__setattr__(self, name, value)
        put("aggs", dict(self.aggs))
        for name in ("keys", "segment_by", "order_by"):
            value = getattr(self, name)
            put(name, (value,) if isinstance(value, str) else tuple(value))
        for name in ("width", "chunk", "start_offset", "end_offset", "compress_after", "drop_after"):
            put(name, _text(getattr(self, name)))
        _need(self.width is not None, "a rollup groups by a time bucket, so it needs a width")
        parse_width(self.width)
        _need(bool(self.aggs), "a rollup needs at least one aggregate")
        _need((self.start_offset is None) == (self.end_offset is None), "a refresh policy needs both offsets")
        taken = [self.bucket, *self.keys, *self.aggs]
        _need(len(set(taken)) == len(taken), "bucket, keys and aggregates need different names")

    def table_spec(self) -> TableSpec:
        """The chunked table that stores this rollup."""
        chunk = self.chunk
        if chunk is None and isinstance(self.width, int):
            chunk = self.width * 1000
        return TableSpec(
            time=self.bucket,
            chunk=chunk,
            segment_by=self.segment_by,
            order_by=self.order_by,
            columnstore=self.compress_after is not None,
            compress_after=self.compress_after,
            drop_after=self.drop_after,
        )

    def same_rows(self, other: RollupSpec) -> bool:
        """True when both store the same rows in the same layout, so that nothing has to be rebuilt."""
        defining = ("source", "time", "width", "aggs", "keys", "where", "bucket", "chunk")
        return all(getattr(self, name) == getattr(other, name) for name in defining)

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, data: Mapping[str, Any]) -> RollupSpec:
        return cls(**data)


SPEC_FIELDS = tuple(f.name for f in fields(TableSpec))
