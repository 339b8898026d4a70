"""Best-fit packing by bin completion.

Pieces of equal length are interchangeable, so the search runs on the counts of the lengths: at most `capacity` numbers,
whatever the corpus holds. It yields fillings with their multiplicities; pieces then look up their sequence and offset by
their rank among the pieces of their length. Ranks are counted in hash ranges, so a length that a third of all pieces
share is dealt over as many windows as any other set of rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from chronofold.llm.common import batches, bounded_batches, materialized, whole_text

CAPACITY = 1024
END_TOKEN = 2
BRANCHES, NODES = 3, 2500  # fillings tried at a node, nodes visited in all


# --- the search over counts ---------------------------------------------------------------------------------------


def fillings(counts: np.ndarray, room: int, limit: int) -> Iterator[tuple[int, ...]]:
    """Up to `limit` undominated fillings of `room` with the lengths that are left, least waste first.

    A filling is dominated when another of no more waste puts one longer piece in the place of several, which is easier
    to do without later. So each sum is filled with one piece if that goes, else with two, else with three. Which sums
    can be had at all is a set of bits, made by shifting.
    """
    lengths = np.flatnonzero(counts[: room + 1])[::-1]
    if not len(lengths):
        yield ()
        return
    within = (1 << (room + 1)) - 1
    own = [int(n) for n in lengths]
    one = sum(1 << n for n in own)
    two = three = 0
    for n in own:
        two |= one << n
    two &= within
    for n in own:
        three |= two << n
    sums, found = (one | two | three) & within, 0
    while sums and found < limit:
        want = sums.bit_length() - 1
        sums ^= 1 << want
        filling = None
        if counts[want] > 0:
            filling = (want,)
        elif two >> want & 1:
            filling = _pair(counts, lengths, want)
        if filling is None and three >> want & 1:
            filling = _triple(counts, lengths, want)
        if filling is not None:
            yield filling
            found += 1


def _pair(counts: np.ndarray, lengths: np.ndarray, want: int) -> tuple[int, int] | None:
    rest = want - lengths
    ok = (rest > 0) & (rest <= lengths)
    ok[ok] = counts[rest[ok]] > (rest[ok] == lengths[ok])
    hit = np.flatnonzero(ok)
    return (int(lengths[hit[0]]), int(rest[hit[0]])) if len(hit) else None


def _triple(counts: np.ndarray, lengths: np.ndarray, want: int) -> tuple[int, int, int] | None:
    for first in lengths[lengths < want]:
        left = counts.copy()
        left[first] -= 1
        shorter = lengths[(lengths <= first) & (left[lengths] > 0)]
        if pair := _pair(left, shorter, want - int(first)):
            return (int(first), *pair)
    return None


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The incumbent: the longest piece with the best fitting pieces around it, as often as the counts allow."""
    counts, plan = counts.copy(), []
    while counts.any():
        largest = int(np.flatnonzero(counts)[-1])
        plan.append(_applied(counts, _best_fitting(counts, largest, capacity)))
    return plan


def _best_fitting(counts: np.ndarray, largest: int, capacity: int) -> tuple[int, ...]:
    filling, left, room = [largest], counts.copy(), capacity - largest
    left[largest] -= 1
    while room > 0 and (fit := np.flatnonzero(left[: room + 1])).size:
        filling.append(int(fit[-1]))
        left[fit[-1]] -= 1
        room -= int(fit[-1])
    return tuple(filling)


def _applied(counts: np.ndarray, filling: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Takes a filling out of the counts as often as it goes; at least one length is used up, or nearly."""
    lengths, needs = np.unique(filling, return_counts=True)
    times = int((counts[lengths] // needs).min())
    counts[lengths] -= needs * times
    return filling, times


def pack_counts(counts: np.ndarray, capacity: int = CAPACITY, branches: int = BRANCHES, nodes: int = NODES):
    """(filling, times) pairs that hold every piece, in as few bins as the search finds.

    counts[n] is the number of pieces of length n. Depth first: the longest piece left is completed by every undominated
    filling, the least wasteful first; a branch ends when the space wasted so far leaves no plan better than the
    incumbent. The search ends at the lower bound, or after `nodes` nodes with the best plan found.
    """
    total = int((counts * np.arange(len(counts))).sum())
    best = best_fit(counts, capacity)
    fewest = sum(times for _, times in best)
    bound = -(-total // capacity)
    stack: list[tuple[np.ndarray, list, int, int]] = [(counts.copy(), [], 0, 0)]
    visited = 0
    while stack and fewest > bound and visited < nodes:
        left, plan, bins, waste = stack.pop()
        visited += 1
        if not left.any():
            if bins < fewest:
                best, fewest = plan, bins
            continue
        if -(-(total + waste) // capacity) >= fewest:  # what is wasted cannot be won back
            continue
        largest = int(np.flatnonzero(left)[-1])
        others = left.copy()
        others[largest] -= 1
        options = []
        for filling in fillings(others, capacity - largest, branches):
            rest = _completed(others, filling, capacity - largest - sum(filling))
            after = left.copy()
            used, times = _applied(after, (largest, *filling, *rest))
            options.append((after, [*plan, (used, times)], bins + times, waste + times * (capacity - sum(used))))
        stack += options[::-1]
    return best


def _completed(counts: np.ndarray, filling: tuple[int, ...], room: int) -> tuple[int, ...]:
    """Pieces that still fit beside a filling, the longest first: leaving them out would be dominated."""
    left, more = counts.copy(), []
    for length in filling:
        left[length] -= 1
    while room > 0 and (fit := np.flatnonzero(left[: room + 1])).size:
        more.append(int(fit[-1]))
        left[fit[-1]] -= 1
        room -= int(fit[-1])
    return tuple(more)


def seats(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[tuple[int, int, tuple[int, ...]]]]]:
    """For each length, the ranks at which its stretches begin, and (first rank, first sequence, offsets in a sequence)."""
    out: dict[int, tuple[list[int], list]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for filling, times in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in filling:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, places in offsets.items():
            starts, stretches = out.setdefault(length, ([], []))
            first = given.get(length, 0)
            starts.append(first)
            stretches.append((first, sequence, tuple(places)))
            given[length] = first + times * len(places)
        sequence += times
    return out


# --- tokens ----------------------------------------------------------------------------------------------------------


class Encoder:
    """Ids of the `tokenizers` file at `path`; a `.tiktoken` file of the same vocabulary, if given, makes them faster.

    Texts in which a special token is spelled out go to `tokenizers`, which is the only one to give it its own id.
    """

    _held: dict[tuple, Encoder] = {}

    def __init__(self, path: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("fast", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    @classmethod
    def of(cls, *key) -> Encoder:
        if key not in cls._held:
            cls._held[key] = cls(*key)
        return cls._held[key]

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def token_pieces(
    df: DataFrame,
    tokenizer: str,
    text: str = "text",
    id_col: str = "doc_id",
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    ranks: str | None = None,
    pattern: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents as tokens, longer ones cut with the odd piece first."""
    schema = StructType(
        [
            StructField("doc_id", df.schema[id_col].dataType),
            StructField("piece", IntegerType()),
            StructField("start", LongType()),
            StructField("length", LongType()),
            StructField("ids_crc32", LongType()),
        ]
        + [StructField("ids", BinaryType())] * with_ids
    )
    arrow = to_arrow_schema(schema)

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, ranks, pattern)

        def rows():
            for batch in stream:
                for doc_id, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = np.array([*encoder.ids(content), end_token], "<u4")
                    first = (len(ids) - 1) % capacity + 1
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for piece, (start, end) in enumerate(zip(edges, edges[1:])):
                        raw = ids[start:end].tobytes()
                        yield (doc_id, piece, start, end - start, zlib.crc32(raw), *([raw] * with_ids))

        return batches(rows(), arrow)

    return bounded_batches(df.select(F.col(id_col), whole_text(text).alias("text"))).mapInArrow(encode, schema)


# --- packing ---------------------------------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int = CAPACITY, branches: int = BRANCHES, nodes: int = NODES) -> DataFrame:
    """`pieces` (rows with a `length` from 1 to `capacity`, and any other columns) with sequence_id and offset.

    Rows are ranked within their length by a hash of doc_id and piece. Only the counts of the lengths reach the driver:
    at most `capacity` rows. Equal rows are pieces of their own. An empty table stays empty.
    """
    spark = pieces.sparkSession
    hashed = pieces.withColumn("__hash", F.xxhash64("doc_id", "piece")).withColumn("__range", F.shiftright("__hash", 56))
    ranges = hashed.groupBy("length", "__range").agg(F.count("*").alias("__n"))
    found = ranges.groupBy("length").agg(F.sum("__n").alias("n")).limit(capacity + 1).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(seats(pack_counts(counts, capacity, branches, nodes)))

    running = Window.partitionBy("length").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("length", "__range", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy("length", "__range").orderBy("__hash", "doc_id", "piece")) - 1
    ranked = hashed.withColumn("__inside", inside).join(starts, ["length", "__range"])
    ranked = ranked.withColumn("__rank", F.col("__start") + F.col("__inside")).select(*pieces.columns, "__rank")
    seat_schema = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])
    schema = StructType([*pieces.schema.fields, *seat_schema.fields])

    def seated(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = plan.value
        arrow = to_arrow_schema(schema)
        for batch in stream:
            table = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            sequences, offsets = [], []
            for length, rank in zip(table["length"].to_pylist(), table["__rank"].to_pylist(), strict=True):
                begins, stretches = places[length]
                first, sequence, own = stretches[bisect_right(begins, rank) - 1]
                copy, place = divmod(rank - first, len(own))
                sequences.append(sequence + copy)
                offsets.append(own[place])
            columns = [table[name] for name in batch.schema.names if name != "__rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())], schema=arrow)

    return ranked.mapInArrow(seated, schema)


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, branches: int = BRANCHES, nodes: int = NODES, **options) -> DataFrame:
    """Every document of `df` as pieces in sequences of at most `capacity` tokens: one row per piece.

    A null text is empty: its only token is the end token. Repeated rows and null or repeated ids are documents of their
    own. Columns besides id and text are not read. `options` are those of `token_pieces`. Tokens are made once and kept in the shared folder.
    """
    return pack(materialized(token_pieces(df, tokenizer, capacity=capacity, **options), "pack-pieces"), capacity, branches, nodes)
