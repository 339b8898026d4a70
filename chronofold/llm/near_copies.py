"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Sets get a SimHash fingerprint, `BANDS` hashes of `ROWS` minima each and an odd sketch: the parities of how many of their
`KEPT` smallest hashes fall on each of `PARITIES` places. A pair of similarity 0.8 shares a band with a probability of
1 - 3e-6, and its fingerprints differ in 10 bits on average, in more than `RADIUS` for one pair in 500. Sketches differ in at
most as many places as the hashes they are of, so that of sets of up to `KEPT` shingles, and of these no pair of similarity 0.8
is taken for an unlike one; of larger sets the hashes are a sample, whose error has `SPARE` standard deviations of room. Sets
that share a band are a bucket. Buckets are first compared with a few of their own members, then searched by the Gray-order
index of `simhash` for pairs within the radius that are not connected yet. Sketches are held against each other where the
bucket is, so pairs of unlike sets are never written; every pair that is left is compared by all its shingles before it counts.
A round takes the `NEAREST` pairs of each text, the next one sixteen times as many, until no untried pair of unconnected texts
is left: the round that leaves out none is the last. Of the buckets that two sets share, one alone makes their pair, in one
direction. So no text has a limit on its partners, and in a group of copies few pairs are ever made. A bucket of more than
`BUCKET` sets is dealt out again by its further hashes; a pair of similarity 0.8 shares two of them with a probability of
0.99995, three with 0.9995.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from chronofold.llm.common import Scratch, bounded_batches, materialized, row_key, rows_of_keys, whole_text
from chronofold.llm.graph import components
from chronofold.llm.simhash import BUCKET, LOWER, SEED, GrayIndex

WORDS, BANDS, ROWS, RADIUS, HUBS, NEAREST = 5, 24, 4, 18, 3, 16
KEPT, PARITIES, SPARE = 2048, 4096, 5
SLOTS = 1 << 20  # of keys; what is broadcast has no more rows
AT_ONCE = 1 << 14  # pairs whose sketches are in memory at a time
MIXED = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier that mixes 64 bits
_DRAWN = np.random.default_rng(SEED)
FACTORS = _DRAWN.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _DRAWN.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
PATH = (1 << BANDS) - 1  # the bits of a bucket that say which bands it stands for


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of all shingles in ascending order; none without words."""
    parts = text.translate(LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    pieces = map(joined.__getitem__, map(slice, starts[:n].tolist(), ends[-n:].tolist()))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in pieces), np.uint64, n))


def minima(found: np.ndarray) -> np.ndarray:
    return np.fromiter(((found * a + b).min() for a, b in zip(FACTORS, SHIFTS)), np.uint64, len(FACTORS)) if len(found) else found


def band_hashes(least: np.ndarray) -> np.ndarray:
    """One hash per band of minima; none for an empty set, which equals no other kind of set."""
    rows = least.reshape(-1, ROWS)
    return np.fromiter((xxhash.xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)), np.uint64, len(rows))


def odd_sketch(found: np.ndarray) -> bytes:
    """The parities of the places that the `KEPT` smallest hashes of a set fall on."""
    places = (found[:KEPT] * MIXED) >> np.uint64(64 - PARITIES.bit_length() + 1)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=PARITIES) & 1).tobytes()


def most_odd(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """In how many places sketches of sets of `n` and `m` shingles may differ at a similarity of 0.8."""
    larger = np.maximum(n, m)
    common = (n + m) * 4 / (9 * larger)  # of the larger set, at least
    room = np.where(larger > KEPT, SPARE * np.sqrt(KEPT * common * (1 - common)), 0)
    return np.minimum(n, KEPT) + np.minimum(m, KEPT) - 2 * (common * np.minimum(larger, KEPT) - room) + 1e-6


def alike(n: np.ndarray, odd: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For places `a` and `b` of sets: how far their sketches differ, 1 being the most at a similarity of 0.8; above 1 for others."""
    off = np.full(len(a), 2.0)
    sized = np.flatnonzero(np.minimum(n[a], n[b]) * 5 >= np.maximum(n[a], n[b]) * 4)
    for at in range(0, len(sized), AT_ONCE):
        some = sized[at : at + AT_ONCE]
        differ = np.bitwise_count(odd[a[some]] ^ odd[b[some]]).sum(axis=1, dtype=np.int64)
        off[some] = differ / most_odd(n[a[some]], n[b[some]])
    return off


def set_fingerprint(found: np.ndarray) -> int:
    """The bits that are set in over half the hashes of a set."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 14):
        bits = np.unpackbits(found[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << int(b) for b in np.flatnonzero(counts * 2 > len(found)))


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))).cast(kind)


def node_of(found: np.ndarray) -> int:
    """The name of a set: equal sets are one node."""
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


LONGS = ArrayType(LongType(), False)
TRAITS = ("n", "fp", "odd")  # what tells unlike sets apart without their shingles


def sketches(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """doc_id, key, node, n (shingles), fp (the fingerprint), odd (the odd sketch) and bands for every row.

    These are some 800 bytes, however long the text.
    """
    longs = [StructField(n, LongType()) for n in ("node", "n", "fp")]
    names = [StructField("doc_id", df.schema[id_col].dataType), StructField("key", StringType())]
    schema = StructType([*names, *longs, StructField("odd", BinaryType()), StructField("bands", LONGS)])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            made, odd, bands = [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py())
                made.append((node_of(found), len(found), set_fingerprint(found)))
                odd.append(odd_sketch(found))
                bands.append(band_hashes(minima(found)))
            columns = [*(pa.array(np.array(c, np.uint64).view(np.int64)) for c in zip(*made)), pa.array(odd, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, lists(bands, arrow.field("bands").type)], schema=arrow)

    whole = whole_text(text)
    return bounded_batches(df.select(F.col(id_col), row_key(id_col, whole), whole.cast("binary"))).mapInArrow(run, schema)


def sets_of(df: DataFrame, text: str, id_col: str, keys: DataFrame) -> DataFrame:
    """node and shingles of the rows whose key is among `keys.key`: their texts are read again."""
    schema = StructType([StructField("node", LongType()), StructField("shingles", LONGS)])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, 200):
                sets = [shingles(t.as_py()) for t in batch.column(0).slice(at, 200)]
                nodes = np.fromiter(map(node_of, sets), np.uint64, len(sets))
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), lists(sets, arrow.field(1).type)], schema=arrow)

    whole = whole_text(text)
    slot = F.pmod(F.xxhash64("key"), F.lit(SLOTS))
    # Most texts that aren't asked for stay where they are: only those of a slot that a key has are shuffled to the keys.
    slots = F.broadcast(keys.select(slot.alias("slot")).distinct())
    rows = df.select(row_key(id_col, whole).alias("key"), whole.cast("binary").alias("content")).withColumn("slot", slot)
    chosen = rows.join(slots, "slot", "left_semi").join(keys, "key", "left_semi")
    return bounded_batches(chosen.select("content")).mapInArrow(run, schema).dropDuplicates(["node"])


def buckets_of(nodes: DataFrame, scratch: Scratch, bucket: int) -> DataFrame:
    """bucket and node: nodes by shared hashes, large buckets dealt out again; no bucket has a single node.

    The last `BANDS` bits of a bucket are its path: a bit for each band whose hash all its nodes share by way of dealing.
    """

    def named(hashed: Column, path: Column) -> Column:
        return hashed.bitwiseAND(F.lit(~PATH)).bitwiseOR(path)

    def several(dealt: DataFrame) -> DataFrame:
        size = F.count("*").over(Window.partitionBy("bucket"))
        return scratch.table(dealt.withColumn("size", size).where("size > 1"), "buckets")

    # `last` is the number of the last band that a bucket stands for; dealing goes on with those behind it.
    exploded = nodes.select("node", F.posexplode("bands").alias("last", "band"))
    dealt = several(exploded.select(named(F.xxhash64("last", "band"), F.expr("shiftleft(1L, last)")).alias("bucket"), "node", "last"))
    settled = dealt.where(F.col("size") <= bucket)
    for _ in range(2):
        large = dealt.where(F.col("size") > bucket)
        if large.isEmpty():
            return settled.select("bucket", "node")
        bands = large.select("bucket", "last", "node").join(nodes.select("node", "bands"), "node")
        finer = bands.select("bucket", "last", "node", F.posexplode("bands").alias("next", "band")).where("next > last")
        path = F.col("bucket").bitwiseAND(F.lit(PATH)).bitwiseOR(F.expr("shiftleft(1L, next)"))
        dealt = several(finer.select(named(F.xxhash64("bucket", "next", "band"), path).alias("bucket"), "node", F.col("next").alias("last")))
        settled = settled.unionByName(dealt.where(F.col("size") <= bucket))
    return settled.unionByName(dealt.where(F.col("size") > bucket)).select("bucket", "node")


def first_shared(path: int, bands: np.ndarray, settled: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bucket of this path is the first of those that have both nodes; `settled`: the paths of one band a node is in.

    Buckets of one band come first, by the number of the band; nodes without such a bucket in common meet in the bucket of the
    first bands that they share.
    """
    shared = (bands[a] == bands[b]) @ (1 << np.arange(BANDS))
    alone = shared & settled[a] & settled[b]
    if path.bit_count() == 1:
        return alone & -alone == path
    first = np.zeros_like(shared)
    for _ in range(path.bit_count()):
        first |= (least := shared & -shared)
        shared ^= least
    return (alone == 0) & (first == path)


def close_pairs(members: DataFrame, nodes: DataFrame, nearest: int | None) -> DataFrame:
    """Pairs a, b of unconnected nodes of a bucket (`members`: bucket, node, component) whose traits in `nodes` are close.

    The `nearest` pairs of each node within the radius, and rows of nulls where a node has more; without a number the pairs
    with `HUBS` members, which are the same in all buckets that they are in. No pair comes twice.
    """
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])
    arrow = to_arrow_schema(schema)

    def pairs(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pair = np.stack((node[a], node[b]))
        return pa.RecordBatch.from_arrays([pa.array(pair.min(axis=0)), pa.array(pair.max(axis=0))], schema=arrow)

    def with_hubs(node: np.ndarray, n: np.ndarray, odd: np.ndarray) -> Iterator[pa.RecordBatch]:
        for hub in {int((node.view(np.uint64) * FACTORS[k] + SHIFTS[k]).argmin()) for k in range(HUBS)}:
            others = np.delete(np.arange(len(node)), hub)
            close = others[alike(n, odd, np.full(len(others), hub), others) <= 1]
            yield pairs(node, np.full(len(close), hub), close)

    def search(bucket: int, node: np.ndarray, component: np.ndarray, n: np.ndarray, fp: np.ndarray, odd: np.ndarray, *dealt: np.ndarray) -> Iterator[pa.RecordBatch]:
        odd = np.frombuffer(b"".join(odd), np.uint64).reshape(len(node), -1)
        if nearest is None:
            yield from with_hubs(node, n, odd)
            return
        names, counts = np.unique(component, return_counts=True)
        if len(names) < 2:
            return
        index = GrayIndex(fp.view(np.uint64))
        node, component, n, odd, settled, bands = (c[index.order] for c in (node, component, n, odd, dealt[0], np.stack(dealt[1])))
        truncated = False
        # The largest component is found, it doesn't search; of two nodes that search, the lower place does.
        searching = component != names[counts.argmax()]
        for low, high in index.links(RADIUS, searching=searching):
            open_ = (component[low] != component[high]) & (~searching[high] | (low < high))
            low, high = low[open_], high[open_]
            off = alike(n, odd, low, high)
            low, high, off = (c[off <= 1] for c in (low, high, off))
            here = first_shared(bucket & PATH, bands, settled, low, high)
            low, high, off = (c[here] for c in (low, high, off))
            if not len(low):
                continue
            order = np.lexsort((node[high], off, low))
            low, high = low[order], high[order]
            begins = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
            rank = np.arange(len(low)) - np.repeat(begins, np.diff(np.append(begins, len(low))))
            truncated |= bool((rank >= nearest).any())
            yield pairs(node, low[rank < nearest], high[rank < nearest])
        if truncated:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], schema=arrow)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        run_of = None
        for batch in stream:
            bucket, *columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            for start, end in zip(edges, [*edges[1:], len(bucket)]):
                if bucket[start] != run_of:
                    if held:
                        yield from search(int(run_of), *map(np.concatenate, zip(*held)))
                    held, run_of = [], bucket[start]
                held.append(tuple(c[start:end] for c in columns))
        if held:
            yield from search(int(run_of), *map(np.concatenate, zip(*held)))

    if nearest is None:
        rows = members.join(nodes.select("node", *TRAITS), "node").select("bucket", "node", "component", *TRAITS)
    else:
        path = F.col("bucket").bitwiseAND(F.lit(PATH))
        alone = F.coalesce(F.bit_or(F.when(F.bit_count(path) == 1, path)).over(Window.partitionBy("node")), F.lit(0).cast("long"))
        rows = members.withColumn("settled", alone).join(nodes.select("node", *TRAITS, "bands"), "node")
        rows = rows.select("bucket", "node", "component", *TRAITS, "settled", "bands")
    made = bounded_batches(rows.repartition("bucket").sortWithinPartitions("bucket")).mapInArrow(run, schema)
    return made.distinct() if nearest is None else made


def near_copy_links(made: DataFrame, read_sets: Callable[[DataFrame], DataFrame], scratch: Scratch, bucket: int = BUCKET, nearest: int = NEAREST) -> DataFrame:
    """node, label for every node of `made` (sketches) that is linked to another: connected components of similarity 0.8.

    `read_sets` gives node and shingles for a table of keys. It is asked for each node once, in the round that first compares it.
    Links are whole after a round that made all pairs left: what it found can only connect more.
    """
    nodes = made.where("n > 0").groupBy("node").agg(*(F.first(c).alias(c) for c in (*TRAITS, "bands")), F.min("key").alias("key"))
    nodes = scratch.table(nodes, "nodes")
    members = scratch.table(buckets_of(nodes, scratch, bucket), "members")
    pairs = close_pairs(members.withColumn("component", F.col("node")), nodes, None)

    sets = links = tried = labels = None
    searched = False
    while True:
        pairs = scratch.table(pairs, "pairs")
        more, pairs = not pairs.where("a IS NULL").isEmpty(), pairs.where("a IS NOT NULL")
        if tried is not None:
            pairs = scratch.table(pairs.join(tried, ["a", "b"], "left_anti"), "untried")
        if labels is None or not pairs.isEmpty():
            met = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            missing = met if sets is None else met.join(sets, "node", "left_anti")
            asked = scratch.table(nodes.join(missing, "node", "left_semi").select("key"), "asked")
            if sets is None or not asked.isEmpty():
                new = scratch.table(read_sets(asked), "sets")
                sets = new if sets is None else sets.union(new)
            of_a, of_b = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
            both = F.size(F.array_intersect("of_a", "of_b"))
            judged = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", (both * 9 >= (F.size("of_a") + F.size("of_b")) * 4).alias("near"))
            judged = scratch.table(judged, "judged")
            tried = judged.select("a", "b") if tried is None else tried.union(judged.select("a", "b"))
            near = judged.where("near").select("a", "b")
            links = near if links is None else links.union(near)
            labels = scratch.table(components(links), "labels")
        if searched and not more:
            return labels
        # Buckets whose nodes are all connected are done.
        known = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("component"))
        spread = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        pairs = close_pairs(known.join(spread, "bucket", "left_semi"), nodes, nearest)
        nearest, searched = nearest * 16, True


def drop_near_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id", bucket: int = BUCKET, nearest: int = NEAREST) -> DataFrame:
    """The rows of `df` with the smallest id among those that links reach (a null id last), one of each, with all columns.

    A null text is empty. Texts without words are copies of each other and of no other text; texts of fewer than five words
    have one shingle, the whole sequence, so they are copies when their words are equal. Of rows that repeat id and text one
    stays. Extra columns are carried along under any name that does not begin with two underscores. An empty table stays empty.
    """
    scratch = Scratch(df.sparkSession, "near")
    made = scratch.table(sketches(df, text, id_col), "sketches")
    labels = near_copy_links(made, lambda keys: sets_of(df, text, id_col, keys), scratch, bucket, nearest).withColumnRenamed("node", "of")
    known = made.select("doc_id", "key", "node").join(labels, F.col("node") == F.col("of"), "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    kept = known.groupBy(F.coalesce("label", "node").alias("component")).agg(F.min_by("key", order).alias("key"))
    kept = materialized(kept.select("key"), "near-kept")
    scratch.delete()
    return rows_of_keys(df, row_key(id_col, whole_text(text)), kept)
