"""What has to run when a table's spec changes."""

from __future__ import annotations

from chronofold.plans.spec import SPEC_FIELDS, TableSpec


class RebuildRefused(RuntimeError):
    """A change that copies every row, on a table whose spec forbids it."""


REBUILD = "rebuild"
DECOMPRESS = "decompress"
SET_SPEC = "set_spec"


def plan_change(old: TableSpec, new: TableSpec) -> list[str]:
    """Steps, in order. A new chunk width, an added dimension and new columnstore settings leave stored rows alone.

    Another time column, or a dimension that is dropped or resized, copies every row.
    """
    resized = any(new.dims.get(name) != partitions for name, partitions in old.dims.items())
    if old.time != new.time or resized:
        if not new.rebuild_data:
            raise RebuildRefused("this change copies every row, and rebuild_data is off")
        return [REBUILD]
    if old.columnstore and not new.columnstore:
        return [DECOMPRESS, SET_SPEC]
    return [] if all(getattr(old, f) == getattr(new, f) for f in SPEC_FIELDS) else [SET_SPEC]
