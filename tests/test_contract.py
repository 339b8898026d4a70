"""Every registered query against its SQL on DuckDB, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, differences

NAMES = [query.__name__ for query in contract.QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(contract.queries()[name](spark, sf_dir), connect(sf_dir), contract.oracle_sql()[name]) is None


EXPRESSIONS = NAMES[: NAMES.index("scan_time_range")]


@pytest.mark.parametrize("name", EXPRESSIONS)
def test_plans_stay_in_the_jvm(spark, sf_dir, name):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("name", ["bucket_hourly_ohlc", "bucket_by_key", "histogram_value", "bucket_month"])
def test_aggregates_combine_before_the_one_shuffle(spark, sf_dir, name):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan and "partial_" in plan
    assert "props" not in plan
