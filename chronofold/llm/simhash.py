"""Near duplicates by SimHash, searched with Gray-order hierarchical indexes.

Equal fingerprints are one row from the start. Two fingerprints that differ in at most `radius` bits agree on one of
`radius + 1` blocks of bits, so each goes to one bucket per block; every bucket has an index of its own. A bucket with more
than `bucket` fingerprints is dealt out again by the bits it doesn't agree on yet, and so on: with every level fewer bits
are open, and a bucket with n open bits has at most 2**n fingerprints. No link is lost on the way.

The index sorts fingerprints by Gray rank and joins neighbours into groups. A node keeps the bits that all below share, less
those its parent has; a search adds up the differences on its way down and leaves whole groups once they exceed the radius.
A bucket returns a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chronofold.llm.common import batches, bounded_batches, materialized, row_key, rows_of_keys, whole_text
from chronofold.llm.graph import components

WORDS, SEED, RADIUS = 4, 42, 4
BUCKET = 1 << 14
FAN = 8
ALL = (1 << 64) - 1
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """The bits that are set in over half the hashes of all shingles; 0 without words."""
    parts = text.translate(LOWER).split()  # bytes split at 0x20 and 0x09 to 0x0D
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    last = ends[-n:].tolist()
    shingles = map(joined.__getitem__, map(slice, starts[:n].tolist(), last))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << int(b) for b in np.flatnonzero(counts * 2 > n))


def fingerprints(df: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, key (of the id and the whole text), fp (the fingerprint as a long) for every row."""
    schema = StructType([StructField("doc_id", df.schema[id_col].dataType), StructField("key", StringType()), StructField("fp", LongType())])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            made = np.fromiter((fingerprint(t.as_py(), words, seed) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made.view(np.int64))], schema=arrow)

    whole = whole_text(text)
    return bounded_batches(df.select(F.col(id_col), row_key(id_col, whole), whole.cast("binary"))).mapInArrow(run, schema)


def blocks(known: int, count: int) -> list[int]:
    """The bits outside `known` as `count` masks of about equally many bits, each with the known ones."""
    open_bits = [b for b in range(64) if not known >> b & 1]
    return [known | sum(1 << b for b in part) for part in (open_bits[k * len(open_bits) // count : (k + 1) * len(open_bits) // count] for k in range(count))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class GrayIndex:
    """Distinct 64-bit fingerprints in Gray order below nodes of `FAN` children."""

    def __init__(self, values: np.ndarray) -> None:
        rank = values.copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        self.order = np.argsort(rank)  # the places of the values as they came
        self.values = values[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []  # pattern, own bits, leaves below; the leaves last
        some = every = self.values
        shared = [(self.values, np.full(len(values), ALL, np.uint64), 1)]
        while len(some) > 1:
            heads = np.arange(0, len(some), FAN)
            some, every = np.bitwise_or.reduceat(some, heads), np.bitwise_and.reduceat(every, heads)
            shared.append((every, ~(some ^ every), shared[-1][2] * FAN))
        above = None
        for pattern, mask, leaves in reversed(shared):
            inherited = 0 if above is None else np.repeat(above, FAN)[: len(mask)]
            self.levels.append((pattern, mask & ~np.asarray(inherited, np.uint64), leaves))
            above = mask

    def links(self, radius: int, block: int = 128, searching: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places (low, high) of fingerprints within `radius`, for one block of searches after the other.

        With `searching` (a flag for each place) only those search, for all others: pairs (search, found), in both directions.
        """
        searches = np.arange(len(self.values)) if searching is None else np.flatnonzero(searching)
        for at in range(0, len(searches), block):
            query = searches[at : at + block]
            node, off = np.zeros(len(query), np.int64), np.zeros(len(query), np.uint8)
            for depth, (pattern, own, leaves) in enumerate(self.levels):
                off = off + np.bitwise_count((self.values[query] ^ pattern[node]) & own[node])
                alive = off <= radius
                if searching is None:
                    alive &= (node + 1) * leaves - 1 > query  # of each pair, the lower place searches
                elif leaves == 1:
                    alive &= node != query
                query, node, off = query[alive], node[alive], off[alive]
                if depth + 1 < len(self.levels):
                    query, off = np.repeat(query, FAN), np.repeat(off, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    inside = node < len(self.levels[depth + 1][0])
                    query, node, off = query[inside], node[inside], off[inside]
            yield query, node


def forest(values: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what lies within the radius: fewer than there are fingerprints."""
    index = GrayIndex(values)
    top = np.arange(len(values))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for low, high in index.links(radius):
        differ = top[low] != top[high]
        for a, b in zip(low[differ].tolist(), high[differ].tolist()):
            a, b = root(a), root(b)
            if a != b:
                top[max(a, b)] = min(a, b)
                yield int(index.values[a]), int(index.values[b])
        top = top[top]


def near_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between the distinct fingerprints `fps.fp`, enough to connect all that are linked."""
    schema = StructType([StructField("fp", LongType()), StructField("mask", LongType()), StructField("part", LongType())])
    arrow = to_arrow_schema(schema)

    def deal(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            fp, known = (c.to_numpy().view(np.uint64) for c in batch.columns)
            for mask in np.unique(known):
                own = fp[known == mask]
                for finer in blocks(int(mask), radius + 1):
                    part = own & np.uint64(finer)
                    columns = (own, np.full(len(own), finer, np.uint64), part)
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], schema=arrow)

    link_schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    link_arrow = to_arrow_schema(link_schema)

    def search(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            held, run = [], None
            for batch in stream:
                fp, mask, part = (c.to_numpy() for c in batch.columns)
                edges = np.flatnonzero(np.concatenate(([True], (mask[1:] != mask[:-1]) | (part[1:] != part[:-1]))))
                for start, end in zip(edges, [*edges[1:], len(fp)]):
                    if (own := (mask[start], part[start])) != run:
                        if sum(map(len, held)) > 1:
                            yield from forest(np.concatenate(held).view(np.uint64), radius)
                        held, run = [], own
                    held.append(fp[start:end])
            if sum(map(len, held)) > 1:
                yield from forest(np.concatenate(held).view(np.uint64), radius)

        return batches(((signed(a), signed(b)) for a, b in found()), link_arrow)

    def searched(dealt: DataFrame) -> DataFrame:
        return dealt.repartition("mask", "part").sortWithinPartitions("mask", "part").mapInArrow(search, link_schema)

    dealt = materialized(bounded_batches(fps.select("fp", F.lit(0).cast("long").alias("mask"))).mapInArrow(deal, schema), "simhash-buckets")
    links = None
    while True:
        large = dealt.groupBy("mask", "part").count().where(F.col("count") > bucket).select("mask", "part")
        large = materialized(large, "simhash-large")
        more = not large.isEmpty()
        small = dealt.join(large, ["mask", "part"], "left_anti").select("fp", "mask", "part") if more else dealt
        links = searched(small) if links is None else links.union(searched(small))
        if not more:
            return links
        again = dealt.join(large, ["mask", "part"], "left_semi").select("fp", "mask")
        dealt = materialized(again.mapInArrow(deal, schema), "simhash-buckets")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    words: int = WORDS,
    seed: int = SEED,
    radius: int = RADIUS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of `df`: doc_id, fingerprint (16 hex digits), component_id, and key and component for `drop_near`.

    Null and wordless texts have the fingerprint zero, which is linked like any other. component_id is the smallest id that
    links reach, null where all are null. Repeated rows are rows of their own. Other columns of `df` are not read. An empty
    table stays empty.
    """
    made = materialized(fingerprints(df, text, id_col, words, seed), "simhash")
    fps = materialized(made.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    labels = components(near_links(fps, radius, bucket))
    known = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    known = materialized(known.select("fp", "least_id", F.coalesce("label", "fp").alias("component")), "simhash-components")
    least = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return made.join(known.join(least, "component").select("fp", "component", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "key", "component"
    )


def drop_near(df: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `df` with the smallest id of their component (a null id last), one of each, with all columns of `df`."""
    found = near_duplicates(df, text, id_col, **options)
    first = F.row_number().over(Window.partitionBy("component").orderBy(F.col("doc_id").asc_nulls_last(), "key"))
    return rows_of_keys(df, row_key(id_col, whole_text(text)), found.withColumn("__place", first).where("__place = 1").select("key"))
