import pytest
from pyspark.sql import types as T

from chronofold import RebuildRefused, RollupSpec, SpecError, TableSpec, plan_change
from chronofold.plans.changes import DECOMPRESS, REBUILD, SET_SPEC
from chronofold.rollups.rollup import order_by_source

SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("other_time", T.TimestampNTZType()),
        T.StructField("n", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def test_defaults():
    spec = TableSpec("time").resolved(SCHEMA)
    assert spec.chunk == "7 days"
    assert spec.migrate_data and spec.rebuild_data and spec.auto_decompress
    assert not spec.columnstore
    assert TableSpec("time", segment_by="device").columnstore


def test_a_stored_spec_reads_back_the_same():
    spec = TableSpec("time", chunk=(1, "month"), dims={"device": 4}, order_by=["time DESC"], compress_after=(7, "day"))
    assert TableSpec.from_dict(spec.to_dict()) == spec
    rollup = RollupSpec("/a", "time", "1 hour", {"v": "avg(value)"}, keys=["device"])
    assert RollupSpec.from_dict(rollup.to_dict()) == rollup


@pytest.mark.parametrize(
    "wrong",
    [
        {"time": "missing"},
        {"time": "value"},
        {"time": "device"},
        {"time": "n"},
        {"time": "n", "chunk": "1 day"},
        {"time": "time", "chunk": 5},
        {"time": "time", "dims": {"time": 2}},
        {"time": "time", "dims": {"device": 0}},
        {"time": "time", "dims": {"missing": 2}},
        {"time": "time", "compress_after": "7 days"},
        {"time": "time", "merge_up_to": "7 days"},
        {"time": "time", "drop_after": "0 days"},
        {"time": "time", "drop_after": 5},
        {"time": "time", "segment_by": ["device"], "order_by": ["device DESC"]},
        {"time": "time", "order_by": ["time", "time DESC"]},
        {"time": "time", "skip_columns": ["value"]},
        {"time": "time", "skip_columns": ["device"]},
        {"time": "time", "unique_keys": [["n"]]},
        {"time": "time", "reorder_by": ["missing"]},
    ],
)
def test_contradictions(wrong):
    with pytest.raises(SpecError):
        TableSpec(**wrong).resolved(SCHEMA)


def test_one_time_column():
    with pytest.raises(SpecError):
        TableSpec(["time", "other_time"])


def test_reserved_column_names():
    with pytest.raises(SpecError):
        TableSpec("time").resolved(T.StructType([*SCHEMA.fields, T.StructField("_chunk", T.LongType())]))


@pytest.mark.parametrize("kind", [T.ShortType(), T.IntegerType(), T.LongType()])
def test_integer_time(kind):
    schema = T.StructType([T.StructField("tick", kind)])
    assert TableSpec("tick", chunk=100, drop_after=500).resolved(schema).chunk == 100


@pytest.mark.parametrize(
    "wrong",
    [
        {"aggs": {}},
        {"width": "0 days"},
        {"width": None},
        {"start_offset": "3 days"},
        {"end_offset": "1 hour"},
        {"aggs": {"bucket": "count(*)"}},
    ],
)
def test_rollup_contradictions(wrong):
    with pytest.raises(ValueError):
        RollupSpec(**{"source": "/a", "time": "time", "width": "1 hour", "aggs": {"v": "avg(value)"}, **wrong})


BASE = TableSpec("time", chunk="1 day", dims={"device": 4}, segment_by=["device"])


@pytest.mark.parametrize(
    ("change", "steps"),
    [
        ({}, []),
        ({"chunk": "7 days"}, [SET_SPEC]),
        ({"dims": {"device": 4, "n": 2}}, [SET_SPEC]),
        ({"segment_by": ["n"]}, [SET_SPEC]),
        ({"segment_by": [], "columnstore": False}, [DECOMPRESS, SET_SPEC]),
        ({"dims": {"device": 2}}, [REBUILD]),
        ({"dims": {}}, [REBUILD]),
        ({"time": "other_time"}, [REBUILD]),
    ],
)
def test_what_a_change_needs(change, steps):
    assert plan_change(BASE, TableSpec(**{**BASE.to_dict(), **change})) == steps


def test_rebuilds_can_be_forbidden():
    with pytest.raises(RebuildRefused):
        plan_change(BASE, TableSpec(**{**BASE.to_dict(), "dims": {}, "rebuild_data": False}))
    assert plan_change(BASE, TableSpec(**{**BASE.to_dict(), "chunk": "2 days", "rebuild_data": False})) == [SET_SPEC]


def test_rollups_are_ordered_by_source():
    assert order_by_source({"c": "b", "b": "a", "a": "raw"}) == ["a", "b", "c"]
    with pytest.raises(SpecError):
        order_by_source({"a": "b", "b": "a"})
