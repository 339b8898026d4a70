"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from chronofold.llm.common import Scratch, bounded_batches, materialized

STAR_LINKS = 1 << 20  # links that a task joins up at a time


def stars(links: DataFrame) -> DataFrame:
    """Links that connect the same nodes as `links` (a < b): what a task has at a time becomes stars around smallest nodes.

    Fewer links than nodes are left of each such portion, and a graph that fits into one is solved but for its labels.
    """
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    arrow = to_arrow_schema(schema)

    def joined(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
        low, high = places[: len(a)], places[len(a) :]
        top = np.arange(len(nodes))
        while True:
            # Every root hooks to the smallest root that a link leads to, then pointers are jumped to their ends.
            x, y = top[low], top[high]
            if (x == y).all():
                break
            np.minimum.at(top, np.maximum(x, y), np.minimum(x, y))
            while (top != top[top]).any():
                top = top[top]
        leaves = np.flatnonzero(top != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[top[leaves]]), pa.array(nodes[leaves])], schema=arrow)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in stream:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(a) for a, _ in held) >= STAR_LINKS:
                yield joined(*map(np.concatenate, zip(*held)))
                held = []
        if held:
            yield joined(*map(np.concatenate, zip(*held)))

    return bounded_batches(links.select("a", "b")).mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of `links` (a, b: longs).

    A link with a null end is no link; links of a node with itself, repeated links and both directions of one are the same
    as without them; other columns are not read; without links there are no nodes.

    In each round tasks turn the links they have into stars. Then every node hooks to the first one among it and its
    neighbours, and links are replaced by links between the nodes hooked to, until none is left. First is the smallest node
    in even rounds, which takes stars at once, and in odd rounds that of a random order drawn anew, so that what no node hooks
    to is gone on a path as well: the expected number of rounds is logarithmic in the nodes whatever their ids. A hub is a
    key of joins, whose other side has one row, and of minima, which are taken before the shuffle. The written tables of
    the rounds are deleted at the end.
    """
    labels, _ = components_and_rounds(links)
    return labels


def components_and_rounds(links: DataFrame) -> tuple[DataFrame, int]:
    """`components`, and how many rounds they took."""
    scratch = Scratch(links.sparkSession, "components")
    apart = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = scratch.table(stars(apart).distinct(), "links")
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        drawn = len(hooks) % 2 == 1
        order = F.struct((F.xxhash64("other", F.lit(len(hooks))) if drawn else F.col("other")).alias("rank"), "other")
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(left.select("b", "a"))
        both = both.select("node", order.alias("other"))
        own = F.struct((F.xxhash64("node", F.lit(len(hooks))) if drawn else F.col("node")).alias("rank"), F.col("node").alias("other"))
        first = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least(own, "low")["other"].alias("hook"))
        hooks.append(scratch.table(first, "hooks"))
        to_a = hooks[-1].select(F.col("node").alias("a"), F.col("hook").alias("x"))
        to_b = hooks[-1].select(F.col("node").alias("b"), F.col("hook").alias("y"))
        moved = left.join(to_a, "a").join(to_b, "b").where("x <> y")
        left = scratch.table(stars(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct(), "links")
    if not hooks:
        roots = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    else:
        # From the last round, which has the fewest nodes, to the first.
        roots = hooks[-1].withColumnRenamed("hook", "root")
        for earlier in reversed(hooks[:-1]):
            later = roots.select(F.col("node").alias("hook"), "root")
            roots = scratch.table(earlier.join(later, "hook", "left").select("node", F.coalesce("root", "hook").alias("root")), "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("label"))
    labels = materialized(roots.join(least, "root").select("node", "label"), "labels")
    scratch.delete()
    return labels, len(hooks)
