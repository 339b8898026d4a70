"""A rollup kept up to date by Structured Streaming."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronofold.functions.buckets import TIMESTAMP_TYPES
from chronofold.functions.widths import FIXED_ORIGIN, parse_width
from chronofold.operators.bucketing import named, time_type
from chronofold.plans.spec import SpecError
from chronofold.rollups.rollup import _rollup_at, add_batch, upsert_buckets


def windowed(stream: DataFrame, spec: Any) -> DataFrame:
    """The rollup as a streaming aggregate: a bucket comes out once, when the watermark has passed its end."""
    width = parse_width(spec.width)
    if width.kind != "micros" or not isinstance(time_type(stream, spec.time), TIMESTAMP_TYPES):
        raise SpecError("only fixed widths over timestamps can be streamed; use refresh for others")
    delay = parse_width(spec.end_offset, allow_zero=True) if spec.end_offset is not None else width
    if delay.kind != "micros":
        raise SpecError("the end offset of a streamed rollup must be a fixed width")
    if spec.where is not None:
        stream = stream.where(spec.where)
    # Watermarks need TIMESTAMP; in a UTC session the cast keeps the instant, and upsert_buckets casts back.
    stream = stream.withColumn(spec.time, F.col(spec.time).cast("timestamp"))
    window = F.window(
        spec.time,
        f"{width.size} microseconds",
        startTime=f"{FIXED_ORIGIN % width.size} microseconds",
    )
    closed = (
        stream.withWatermark(spec.time, f"{delay.size} microseconds")
        .groupBy(window.alias("window"), *spec.keys)
        .agg(*named(spec.aggs))
    )
    return closed.select(F.col("window.start").alias(spec.bucket), *spec.keys, *spec.aggs)


def stream_rollup(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict[str, Any] | None = None, deltas: bool = False
) -> StreamingQuery:
    """Start a query that keeps an existing rollup up to date from a stream of source rows.

    By default every closed bucket is put into the rollup. The watermark is the spec's ``end_offset``; rows that come later
    than that are left to the next windowed refresh. A batch that is replayed after a failure replaces the buckets it wrote.

    With ``deltas`` the states of every batch are added as small files of their own, which reading merges and
    ``compress_chunks`` folds in. There is no watermark and no state: open buckets are there at once, late rows are counted,
    and no file of the rollup is written again unless a batch is replayed, which replaces its own part. It takes
    aggregates whose states merge (sum, count, min, max, avg, min_by, max_by), over any width.

    Either way a refresh computes buckets from the source table, so the rows of the stream have to go there too.
    ``checkpoint`` must lie in storage that all executors share; it also names the stream. The default trigger processes
    what is there and stops.
    """
    spark = stream.sparkSession
    _, spec = _rollup_at(spark, path)

    def put(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            upsert_buckets(batch.sparkSession, path, batch)
        finally:
            batch.unpersist()

    def add(batch: DataFrame, number: int) -> None:
        add_batch(batch.sparkSession, path, batch, checkpoint.rstrip("/"), number)

    return (
        (stream if deltas else windowed(stream, spec))
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(add if deltas else put)
        .start()
    )
