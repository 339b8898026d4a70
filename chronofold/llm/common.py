"""What several operators share: materialised intermediate tables, words, id order, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.sources.files import Folder, scratch_folder

# The white space of every contract here, as regular expressions.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ROOT = str(Path(__file__).resolve().parents[2])

# Rows and bytes that one Arrow batch may hold on its way to a Python worker.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def materialized(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder: later readers don't compute them again, nor does a lost executor."""
    path = scratch_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one run of an operator, in one shared folder that goes when its result is written elsewhere."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder, self.count = spark, scratch_folder(spark, name), 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """As `materialized`, until `delete`."""
        self.count += 1
        path = f"{self.folder}/{self.count:04d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        """Nothing that is still to be computed may read these tables."""
        Folder(self.spark, self.folder).delete()


def bounded_batches(df: DataFrame) -> DataFrame:
    """`df`, about to go to Python workers: batches of bounded size, so that memory doesn't depend on how long texts are.

    Workers look for this package where the driver has it, besides their own path.
    """
    paths = df.sparkSession.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), ROOT]))
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def whole_text(text: str | Column) -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def order_key(value) -> tuple:
    """Ids in ascending order, a missing one after all others."""
    return (value is None, value if value is not None else 0)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


def row_key(id_col: str | Column, content: Column) -> Column:
    """One string for an id, null or not, and a content that is not null."""
    name = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.sha2(F.concat(F.coalesce(F.concat(name.cast("string"), F.lit("|")), F.lit("")), content), 256)


def rows_of_keys(df: DataFrame, key: Column, kept: DataFrame) -> DataFrame:
    """The rows of `df` whose key is among `kept.key`, one of each key. One shuffle of `df`: both steps use its key."""
    return df.withColumn("__key", key).join(kept.select(F.col("key").alias("__key")), "__key", "left_semi").dropDuplicates(["__key"]).select(*df.columns)
