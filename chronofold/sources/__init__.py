from chronofold.sources.hypertable import append, count_in_range, create_hypertable, describe, latest, layout, scan, scan_joined
from chronofold.sources.manifest import Table, TableError

__all__ = [
    "Table",
    "TableError",
    "append",
    "count_in_range",
    "create_hypertable",
    "describe",
    "latest",
    "layout",
    "scan",
    "scan_joined",
]
