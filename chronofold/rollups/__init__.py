from chronofold.rollups.rollup import (
    create_rollup,
    dependents_of,
    drop_rollups,
    read_rollup,
    redefine,
    refresh,
    refresh_tree,
    run_refresh_policy,
)

__all__ = [
    "create_rollup",
    "dependents_of",
    "drop_rollups",
    "read_rollup",
    "redefine",
    "refresh",
    "refresh_tree",
    "run_refresh_policy",
]
