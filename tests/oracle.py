"""Runs every query next to its SQL on DuckDB and compares rows, types and values.

Usage: python tests/oracle.py [scale factor folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides have the same columns, types and rows."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    theirs = Counter(tuple(_plain(v) for _, v in sorted(zip(names, row))) for row in found.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    kinds = {"bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER", "string": "VARCHAR"}
    types = {d[0]: str(d[1]) for d in found.description}
    for name, kind in spark_df.dtypes:
        if kind in kinds and types[name] != kinds[kind]:
            return f"{name} is {kind} against {types[name]}"
    order = sorted(spark_df.columns)
    ours = Counter(tuple(_plain(row[c]) for c in order) for row in spark_df.collect())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).elements()), list((theirs - ours).elements())
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" {len(extra)} only here: {extra[:3]}; {len(missing)} only there: {missing[:3]}"
    )


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    oracle = contract.oracle_sql()
    wrong = 0
    for name, query in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            problem = differences(query(session, sf_dir), connect(sf_dir), oracle[name])
        except Exception as failure:  # noqa: BLE001
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {time.time() - started:6.2f} s  {problem or ''}", flush=True)
    print(f"{wrong} wrong")
