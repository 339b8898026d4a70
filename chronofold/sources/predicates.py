"""Which chunks a condition can be true in.

Spark parses, resolves and types the condition; what comes out of its analyzer is read as far as it compares one column
with constants (``=``, ``<``, ``BETWEEN``, ``IN``), joined by ``AND`` and ``OR``. Every other part holds for all chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofold.functions.widths import MICROS_PER_DAY
from chronofold.sources.manifest import Table

FLIPPED = {
    "EqualTo": "EqualTo",
    "EqualNullSafe": "EqualNullSafe",
    "LessThan": "GreaterThan",
    "LessThanOrEqual": "GreaterThanOrEqual",
    "GreaterThan": "LessThan",
    "GreaterThanOrEqual": "LessThanOrEqual",
}
# Integer types in the order of their range.
WIDER = ("byte", "short", "integer", "long")


def _children(node: Any) -> list[Any]:
    found = node.children()
    return [found.apply(k) for k in range(found.size())]


def _constant(node: Any) -> tuple[Any] | None:
    """The value of a constant expression, None inside for null; text as text, times as microseconds or days."""
    if not node.foldable():
        return None
    value = node.eval(None)
    return (value if value is None or isinstance(value, (int, float, bool, str)) else value.toString(),)


def _column_name(node: Any, shared: dict[str, Any]) -> str | None:
    """The name of a bare column, which may stand for a shared expression or be widened to a larger integer."""
    if node.getClass().getSimpleName() == "CommonExpressionRef":
        node = shared.get(node.id().toString(), node)
    if node.getClass().getSimpleName() == "Cast":
        child = _children(node)[0]
        to, of = (n.dataType().typeName() for n in (node, child))
        if to == of or (to in WIDER and of in WIDER[: WIDER.index(to)]):
            node = child
    return node.name() if node.getClass().getSimpleName() == "AttributeReference" else None


def _comparison(node: Any, shared: dict[str, Any]) -> tuple[str, str, list[Any]] | None:
    """(operator, column, constants) of a comparison of a bare column."""
    name, children = node.getClass().getSimpleName(), _children(node)
    if name == "In":
        values, column = [_constant(c) for c in children[1:]], _column_name(children[0], shared)
        return None if column is None or None in values else (name, column, [v[0] for v in values])
    if name not in FLIPPED:
        return None
    left, right = children
    if _column_name(right, shared) is not None:
        left, right, name = right, left, FLIPPED[name]
    column, value = _column_name(left, shared), _constant(right)
    return None if column is None or value is None else (name, column, [value[0]])


def _within(operator: str, low: Column, high: Column, values: Sequence[int]) -> Column:
    """Whether a range [low, high] can hold a value that compares like this."""
    if operator == "LessThan":
        return low < values[0]
    if operator == "LessThanOrEqual":
        return low <= values[0]
    if operator == "GreaterThan":
        return high > values[0]
    if operator == "GreaterThanOrEqual":
        return high >= values[0]
    return reduce(Column.__or__, ((low <= v) & (high >= v) for v in values), F.lit(False))


def chunk_condition(table: Table, condition: str | Column, bucket_of: Callable[[Column, int], Column]) -> Column:
    """A condition on rows as a condition on chunks: true for every chunk that may hold a row it is true for."""
    state = table.state
    filtered = table.spark.createDataFrame([], state.schema).where(condition)
    node = filtered._jdf.queryExecution().analyzed().condition()
    anything = F.lit(True)

    def leaf(operator: str, name: str, values: list[Any]) -> Column:
        if name not in state.schema.names:
            return anything
        known = [v for v in values if v is not None]
        if not known:  # a comparison with null is true for no row, but for <=>
            return anything if operator == "EqualNullSafe" else F.lit(False)
        dtype = state.schema[name].dataType
        found = anything
        if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            unit = MICROS_PER_DAY if isinstance(dtype, T.DateType) else 1
            places = [int(v) * unit for v in known]
            if name == state.spec.time:
                found = _within(operator, F.col("min_time"), F.col("max_time"), places)
            else:
                kept = F.element_at("stats", F.lit(name))
                missing = kept.isNull() | kept["lo"].isNull()
                found = missing | _within(operator, kept["lo"], kept["hi"], places)
        if operator in ("EqualTo", "EqualNullSafe", "In") and isinstance(dtype, (T.StringType, T.ShortType, T.IntegerType, T.LongType)):
            for size in sorted({n for dims in state.layouts for d, n in dims if d == name}):
                layouts = [k for k, dims in enumerate(state.layouts) if (name, size) in dims]
                own = F.element_at("buckets", F.lit(name))
                one_of = reduce(Column.__or__, (own == bucket_of(F.lit(v).cast(dtype), size) for v in known))
                found = found & (~F.col("layout").isin(layouts) | one_of)
        return found

    def walk(node: Any, shared: dict[str, Any]) -> Column:
        name = node.getClass().getSimpleName()
        if name == "Between":  # Spark puts two comparisons of a shared expression in its place
            node = node.replacement()
            name = node.getClass().getSimpleName()
        if name == "With":
            defs = node.defs()
            own = {d.id().toString(): d.child() for d in (defs.apply(k) for k in range(defs.size()))}
            return walk(node.child(), shared | own)
        if name in ("And", "Or"):
            left, right = (walk(child, shared) for child in _children(node))
            return left & right if name == "And" else left | right
        found = _comparison(node, shared)
        return anything if found is None else leaf(*found)

    return walk(node, {})
