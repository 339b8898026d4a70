from chronofold.functions.aggregates import first_by, histogram, last_by
from chronofold.functions.buckets import time_bucket, time_bucket_date, time_bucket_int, typed_bucket
from chronofold.functions.ids import generate_uuid7, to_uuid7, uuid7_between, uuid7_timestamp, with_uuid7
from chronofold.functions.sql import register
from chronofold.functions.widths import parse_width, width_text

__all__ = [
    "first_by",
    "generate_uuid7",
    "histogram",
    "last_by",
    "parse_width",
    "register",
    "time_bucket",
    "time_bucket_date",
    "time_bucket_int",
    "to_uuid7",
    "typed_bucket",
    "uuid7_between",
    "uuid7_timestamp",
    "width_text",
    "with_uuid7",
]
