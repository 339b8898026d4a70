"""Repeated byte strings, found with run-length compressed Burrows-Wheeler indexes.

Equal strings of `length` bytes must meet in one index, without comparing everything with everything:

1. Every window of `length` bytes has an anchor, its run of `K` bytes with the smallest hash (the leftmost of equal ones).
   Equal windows have equal anchors. Anchors that only one text has are of no use and go.
2. Consecutive windows with the same anchor form a segment. The segments of an anchor that several texts share are put into one index:
   the Burrows-Wheeler transform of all segments as runs, with the position in the text at each run's end. Matching
   statistics are streamed backwards through the runs, all segments side by side; where at least `length` bytes match, the rows
   of the index that share them form an interval, which knows its smallest document. That marks the windows of the others.
3. The marks of a document are joined with its text, and the bytes that they cover are cut out.

Equal texts are one text up to the end. An anchor in more than `common` texts has a segment for each window instead, dealt by its
content, so no index grows with the number of documents; copies of a segment are joined before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from chronofold.llm.common import batches, bounded_batches, materialized, whole_text

LENGTH, K = 50, 20
COMMON = 1 << 14
BLOCK = 1 << 18  # windows of a long text that are looked at together
INDEX_BYTES = 1 << 18  # an index that stays in a core's cache
LAST_ID = (1 << 63) - 1  # a missing id comes after all others
# Odd multipliers that mix 64 bits.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def run_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k bytes, by doubling their length."""
    base = MULTIPLIERS[0]
    have, size = data.astype(np.uint64) + np.uint64(1), 1
    powers = {1: have}
    while size * 2 <= k:
        have = have[:-size] * np.uint64(pow(base, size, 1 << 64)) + have[size:]
        size *= 2
        powers[size] = have
    out, done = None, 0
    count = len(data) - k + 1
    for size in sorted(powers, reverse=True):
        if k - done >= size:
            part = powers[size][done : done + count]
            out = part.copy() if out is None else out * np.uint64(pow(base, size, 1 << 64)) + part
            done += size
    for multiplier, shift in zip(MULTIPLIERS[1:], (32, 29)):
        out *= np.uint64(multiplier)
        out ^= out >> np.uint64(shift)
    return out


def segments(text: bytes, length: int = LENGTH, k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, first window, windows) of all segments of a text, for a block of windows at a time."""
    span = length - k + 1  # runs of k bytes in a window
    for begin in range(0, len(text) - length + 1, BLOCK):
        data = np.frombuffer(text, np.uint8)[begin : begin + BLOCK + length - 1]
        hashes = run_hashes(data, k)
        low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        size = 1
        while size * 2 <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        yield hashes[place[first]].view(np.int64), first + begin, np.diff(np.append(first, len(place)))


class RunLengthIndex:
    """The Burrows-Wheeler transform of distinct segments as runs. Separators sort before all bytes, in the order of the segments."""

    def __init__(self, parts: list[bytes], length: int = LENGTH) -> None:
        self.sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        count = len(parts)
        data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
        ends = np.cumsum(self.sizes + 1) - 1
        symbols = data.astype(np.int64) + 1
        symbols[ends] = 0
        owner = np.repeat(np.arange(count), self.sizes + 1)
        left = np.repeat(ends, self.sizes + 1) - np.arange(len(symbols))  # bytes up to the separator
        order, half = self._sorted(symbols, owner, left, length)
        before = symbols[order - 1]
        self.starts = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        self.heads = before[self.starts]
        self.samples = order[np.append(self.starts[1:], len(order)) - 1]
        widths = np.diff(np.append(self.starts, len(order)))
        by_head = np.argsort(self.heads, kind="stable")
        self.targets = np.empty(len(widths), np.int64)  # where the first row of each run leads
        self.targets[by_head] = np.cumsum(widths[by_head]) - widths[by_head]
        # Intervals of rows that share `length` bytes.
        depth, rank = half
        here, there = rank[order], rank[np.minimum(order + length - depth, len(order) - 1)]
        same = (here[1:] == here[:-1]) & (there[1:] == there[:-1]) & (left[order[1:]] >= length) & (left[order[:-1]] >= length)
        self.intervals = np.flatnonzero(np.concatenate(([True], ~same)))

    @staticmethod
    def _sorted(symbols, owner, left, length):
        """The order of all suffixes up to their separators, and ranks by a beginning of at most `length` and over half of it."""
        n = len(symbols)
        depth = min(7, length)
        key = np.zeros(n, np.int64)
        for k in range(depth):
            key <<= 9
            key[: n - k] |= np.where(left[: n - k] >= k, symbols[k:], 0)
        # Suffixes that end within `depth` are told apart by their segments, which a stable sort keeps in order.
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([True], (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < depth)))
        rank, rows = np.empty(n, np.int64), np.arange(n)
        while True:
            # A group of equal beginnings is ranked by its first row; only groups of several suffixes are sorted further.
            first = np.flatnonzero(fresh)
            rank[order[rows]] = np.repeat(rows[first], np.diff(np.append(first, len(rows))))
            if depth <= length:
                half = (depth, rank.copy())
            rows = rows[~(fresh & np.append(fresh[1:], True))]
            if not len(rows):
                return order, half
            open_ = order[rows]
            key = rank[open_] * n + rank[open_ + depth]
            by_key = np.argsort(key)
            order[rows], key = open_[by_key], key[by_key]
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            depth *= 2

    def step(self, rows: np.ndarray) -> np.ndarray:
        """From the rows of suffixes to those of the suffixes one byte longer."""
        run = np.searchsorted(self.starts, rows, side="right") - 1
        return self.targets[run] + rows - self.starts[run]

    def stream(self, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(segments, first bytes, intervals) for every `length` bytes of every segment, from the last ones backwards."""
        rows = np.arange(len(self.sizes))
        active = np.arange(len(self.sizes))
        for matched in range(1, int(self.sizes.max()) + 1):
            rows, active = rows[self.sizes[active] >= matched], active[self.sizes[active] >= matched]
            rows = self.step(rows)
            if matched >= length:
                yield active, self.sizes[active] - matched, np.searchsorted(self.intervals, rows, side="right") - 1


def smaller_owners(parts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each distinct segment, bit p set if its window at p is also in a segment of a smaller owner."""
    index = RunLengthIndex(parts, length)
    streamed = list(index.stream(length))
    least = np.full(len(index.intervals), LAST_ID, np.int64)
    for part, _, interval in streamed:
        np.minimum.at(least, interval, owners[part])
    marks = np.zeros(len(parts), np.int64)
    for part, first, interval in streamed:
        hit = least[interval] < owners[part]
        marks[part[hit]] |= np.left_shift(np.int64(1), first[hit])
    return marks


def cut_out(text: bytes, starts: np.ndarray, windows: np.ndarray, bits: np.ndarray, length: int) -> tuple[int, int, str]:
    """Bytes removed, spans and the SHA-256 of the rest. A mark is a start, windows and bits (-1: all of them)."""
    if not len(starts):
        return 0, 0, hashlib.sha256(text).hexdigest()
    begun = np.zeros(len(text) + 1, np.int32)
    whole = bits == -1
    np.add.at(begun, starts[whole], 1)
    np.add.at(begun, np.minimum(starts[whole] + windows[whole] + length - 1, len(text)), -1)
    starts, windows, bits = starts[~whole], windows[~whole], bits[~whole]
    if len(starts):
        places = np.arange(int(windows.max()))
        firsts = (starts[:, None] + places)[(bits[:, None] >> places & 1 == 1) & (places < windows[:, None])]
        np.add.at(begun, firsts, 1)
        np.add.at(begun, firsts + length, -1)
    gone = np.cumsum(begun[:-1]) > 0
    spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()


def remove_repeats(df: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH, k_run: int = K, common: int = COMMON) -> DataFrame:
    """One row per row of `df`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of `length` bytes that covers it is also in a text with a smaller id; strings are judged on the
    input. Ids are integral, a null one counts as the largest; rows with the same id don't remove one another's bytes. A null
    text is empty, texts shorter than `length` stay whole. Other columns are not read. An empty table gives an empty result.
    """
    content = whole_text(text)
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    # A text is named by its id and a hash, so rows that share an id are told apart.
    docs = df.select(F.col(id_col).alias("doc_id"), ident.alias("id"), F.xxhash64(content).alias("unit"), content.cast("binary").alias("text"))
    light = docs.select("id", "unit", F.sha2("text", 256).alias("sha"))
    owners = materialized(light.groupBy("sha", "unit").agg(F.min("id").alias("own_id")), "repeat-owners")
    copies = light.join(owners.drop("unit"), "sha").where("id > own_id").select("id", "unit").distinct()

    # 1. Anchors that more than one text has, as a list for each text.
    # Texts of a batch that share one are one row: even an anchor of most texts is a row per batch when it is counted.
    anchor_schema = StructType([StructField("anchor", LongType()), StructField("unit", LongType()), StructField("others", ArrayType(LongType(), False))])
    anchor_arrow = to_arrow_schema(anchor_schema)

    def anchors(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in stream:
            units, found = [], []
            for unit, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                if unit not in seen:
                    seen.add(unit)
                    parts = [part for part, _, _ in segments(content.as_py(), length, k_run)]
                    if parts:
                        found.append(np.unique(np.concatenate(parts)))
                        units.append(np.full(len(found[-1]), unit))
            if found:
                yield _grouped(np.concatenate(found), np.concatenate(units), anchor_arrow)

    pairs = bounded_batches(docs.select("unit", "text")).mapInArrow(anchors, anchor_schema)
    texts = Window.partitionBy("anchor")
    least, most = F.least("unit", F.array_min("others")), F.greatest("unit", F.array_max("others"))
    count = F.sum(F.when(F.col("others").isNull(), 1).otherwise(F.size("others") + 1))
    counted = pairs.select("unit", "others", "anchor", *(f.over(texts).alias(n) for n, f in (("low", F.min(least)), ("high", F.max(most)), ("n", count))))
    counted = counted.where("low <> high").select("anchor", "low", "high", "n", F.explode(F.concat(F.array("unit"), F.coalesce("others", F.array().cast("array<bigint>")))).alias("unit"))
    shared = counted.groupBy("unit").agg(
        F.collect_set(F.when(F.col("n") <= common, F.col("anchor"))).alias("some"),
        F.collect_set(F.when(F.col("n") > common, F.col("anchor"))).alias("many"),
    )
    lists = shared.join(owners, "unit").select(F.col("own_id").alias("id"), "unit", "some", "many")
    lists = materialized(lists, "repeat-anchors")

    # 2. Their segments, indexed by anchor. Segments that a batch has several times are one row.
    part_schema = StructType([StructField(c, LongType()) for c in ("anchor", "least_id", "most_id")] + [StructField("segment", BinaryType())])
    place_schema = StructType([StructField(c, LongType()) for c in ("id", "unit", "anchor", "content", "start", "windows")])
    part_arrow, place_arrow = to_arrow_schema(part_schema), to_arrow_schema(place_schema)

    def cut(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
        """id, unit, anchors, starts, windows and segments of shared anchors, for a block of a text at a time."""
        some, many = (batch.column(c) for c in ("some", "many"))
        names = zip(batch.column("id").to_pylist(), batch.column("unit").to_pylist(), batch.column("text"))
        for k, (ident, unit, content) in enumerate(names):
            content = content.as_py()
            whole_set, split_set = (np.sort(c[k].values.to_numpy(zero_copy_only=False)) for c in (some, many))
            for found, first, windows in segments(content, length, k_run):
                whole, split = (_among(found, c) for c in (whole_set, split_set))
                starts, counts, anchor = first[whole], windows[whole], found[whole]
                parts = [content[a : a + n + length - 1] for a, n in zip(starts.tolist(), counts.tolist())]
                if split.any():
                    singles = _unfolded(first[split], windows[split])
                    more = [content[a : a + length] for a in singles.tolist()]
                    anchor = np.concatenate((anchor, np.fromiter(map(_content_hash, more), np.int64, len(more))))
                    starts, counts = np.concatenate((starts, singles)), np.concatenate((counts, np.ones(len(more), np.int64)))
                    parts += more
                yield ident, unit, anchor, starts, counts, parts

    def parts_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            held: dict[tuple[int, bytes], list[int]] = {}
            for ident, _, anchor, _, _, parts in cut(batch):
                for key in zip(anchor.tolist(), parts):
                    ids = held.setdefault(key, [ident, ident])
                    if ident != ids[0]:
                        ids[0], ids[1] = min(ids[0], ident), max(ids[1], ident)
            yield from batches(((a, *ids, part) for (a, part), ids in held.items()), part_arrow, 20_000)

    def places_of(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for ident, unit, anchor, starts, counts, parts in cut(batch):
                n = len(parts)
                own = np.fromiter(map(_content_hash, parts), np.int64, n)
                columns = (np.full(n, ident), np.full(n, unit), anchor, own, starts, counts)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=place_arrow)

    # Every reader takes the same columns, so the texts are shuffled once.
    dealt = docs.repartition("id", "unit")
    chosen = dealt.join(lists, ["id", "unit"])
    mark_schema = StructType([StructField(c, LongType()) for c in ("anchor", "content", "least_id", "bits")])
    mark_arrow = to_arrow_schema(mark_schema)

    def index(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            """(anchor, its distinct segments with their smallest and largest id)."""
            run, group = None, {}
            for batch in stream:
                for anchor, least, most, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if anchor != run:
                        if group:
                            yield run, group
                        run, group = anchor, {}
                    ids = group.setdefault(part, [least, most])
                    ids[0], ids[1] = min(ids[0], least), max(ids[1], most)
            if group:
                yield run, group

        def marked():
            held: dict[tuple[int, bytes], list[int]] = {}
            size = 0
            for anchor, group in groups():
                if len(group) == 1:  # all texts have the same segment, so there is none to match it with
                    for part, ids in group.items():
                        if ids[0] < ids[1]:
                            yield anchor, _content_hash(part), ids[0], 0
                    continue
                held.update(((anchor, part), ids) for part, ids in group.items())
                size += sum(map(len, group))
                if size > INDEX_BYTES:
                    yield from _marks(held, length)
                    held, size = {}, 0
            yield from _marks(held, length)

        return batches(marked(), mark_arrow, 20_000)

    parts = chosen.mapInArrow(parts_of, part_schema).repartition("anchor").sortWithinPartitions("anchor")
    marks = parts.mapInArrow(index, mark_schema)

    # 3. Marks back to their documents. Texts that have a smaller copy go whole.
    bits = F.when(F.col("id") > F.col("least_id"), -1).otherwise(F.col("bits")).cast("long").alias("bits")
    found = chosen.mapInArrow(places_of, place_schema).join(marks, ["anchor", "content"]).select("id", "unit", "start", "windows", bits)
    whole = {"start": 0, "windows": LAST_ID >> 1, "bits": -1}
    found = found.where("bits <> 0").unionByName(copies.select("id", "unit", *(F.lit(v).cast("long").alias(c) for c, v in whole.items())))
    by_text = found.groupBy("id", "unit").agg(F.collect_list(F.struct("start", "windows", "bits")).alias("marks"))
    numbers = [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    out_schema = StructType([StructField("doc_id", df.schema[id_col].dataType), *numbers, StructField("kept_sha256", StringType())])
    out_arrow = to_arrow_schema(out_schema)

    def rest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            marks = batch.column("marks")
            edges = marks.offsets.to_numpy()
            fields = [marks.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "windows", "bits")]

            def rows():
                for k, (ident, content) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text"))):
                    content = content.as_py()
                    own = slice(edges[k], edges[k + 1] if len(content) >= length else edges[k])
                    yield ident, len(content), *cut_out(content, *(f[own] for f in fields), length)

            yield from batches(rows(), out_arrow)

    joined = dealt.join(by_text, ["id", "unit"], "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(rest, out_schema)


def _grouped(anchors: np.ndarray, units: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """A row for each anchor with the first of its units and a list of the others, null without any."""
    order = np.lexsort((units, anchors))
    anchors, units = anchors[order], units[order]
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    more = np.diff(np.append(first, len(anchors))) - 1
    rest = np.ones(len(anchors), bool)
    rest[first] = False
    offsets = np.concatenate(([0], np.cumsum(more))).astype(np.int32)
    others = pa.ListArray.from_arrays(pa.array(offsets), pa.array(units[rest]), mask=pa.array(more == 0))
    return pa.RecordBatch.from_arrays([pa.array(anchors[first]), pa.array(units[first]), others.cast(schema.field(2).type)], schema=schema)


def _unfolded(first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.cumsum(windows) + windows, windows) + np.arange(int(windows.sum()))


def _among(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of `found` are in the sorted `known`."""
    if not len(known):
        return np.zeros(len(found), bool)
    return known[np.searchsorted(known, found).clip(max=len(known) - 1)] == found


def _content_hash(part: bytes) -> int:
    h = xxhash.xxh64_intdigest(part)
    return h - (1 << 64) if h >> 63 else h


def _marks(held: dict[tuple[int, bytes], list[int]], length: int) -> Iterator[tuple]:
    """(anchor, content, smallest id, bits) of segments that have something to remove."""
    if held:
        least = np.fromiter((ids[0] for ids in held.values()), np.int64, len(held))
        bits = smaller_owners([part for _, part in held], least, length)
        for ((anchor, part), ids), own in zip(held.items(), bits.tolist()):
            if own or ids[0] < ids[1]:
                yield anchor, _content_hash(part), ids[0], own
