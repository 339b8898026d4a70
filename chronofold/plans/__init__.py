from chronofold.plans.changes import RebuildRefused, plan_change
from chronofold.plans.spec import RollupSpec, SpecError, TableSpec

__all__ = ["RebuildRefused", "RollupSpec", "SpecError", "TableSpec", "plan_change"]
