from chronofold.operators.bucketing import bucket_by, histogram_by
from chronofold.operators.gapfill import gapfill
from chronofold.operators.ordering import order_columns, ordered

__all__ = ["bucket_by", "gapfill", "histogram_by", "order_columns", "ordered"]
