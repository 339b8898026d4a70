"""Cheapest repair of conversations by block tables after the Four Russians.

The roles of a sound conversation are nothing, or an optional system turn and then pairs of user and assistant. Edits keep,
rerole or delete a row, or insert an empty one. What the rest of a conversation costs from each of the four states of that
pattern is a vector; less its minimum there are only a few of them, since one state reaches another by a few edits. So a
table holds, for every such vector and every block of `BLOCK` symbols (a row's role, and whether it is cut short or has to
go), the vector in front of the block and what the minimum grew by. Conversations are read from the end, a lookup a block;
then each block is expanded backward from the vector behind it, and traced forward by the least letter that keeps the cost.

Rows are sorted over all tasks by conversation and turn and cut into segments of at most `SEGMENT_ROWS` rows, so a long
conversation is many segments. A segment that may be a part is summed up: for every vector behind it, the one in front
and the states it ends in. One task chains the sums of a conversation, about 300 bytes for 4096 rows, less than its audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from chronofold.llm.common import batches, bounded_batches, materialized

BLOCK = 4
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 4 << 20
BLANKS = " \t\n\x0b\f\r"

# The edits and what they cost; a row that is kept or reroled though it is cut short costs CUT more.
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
CUT = 3
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after the system turn, after a user turn, after an assistant turn. Where each role leads from each.
STATES = range(4)
STEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
WANTED = tuple("u" if STEPS["u"][q] is not None else "a" for q in STATES)
MADE = tuple(STEPS[WANTED[q]][q] for q in STATES)
NAMES = {"u": "user", "a": "assistant"}

# Symbols: 0 has to go; then each role, whole and cut short. Roles other than s, u and a cannot be kept.
ROLES = "sua?"
GO = 0
SYMBOLS = 1 + 2 * len(ROLES)


def symbol(role: str, cut: bool) -> int:
    return 1 + 2 * ROLES.index(role[0] if role and role[0] in "sua" else "?") + cut


# --- vectors and tables -------------------------------------------------------------------------------------------


def with_inserts(costs: list) -> tuple:
    """What the rest costs when empty rows may come first."""
    for _ in range(3):
        costs = [min(costs[q], COST[INSERT] + costs[MADE[q]]) for q in STATES]
    return tuple(costs)


def edits_of(x: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row of symbol `x` in state `q`, letters in ascending order."""
    yield DELETE, COST[DELETE], q
    if x == GO:
        return
    role, more = ROLES[(x - 1) // 2], CUT * ((x - 1) % 2)
    kept = STEPS[role][q] if role in STEPS else None
    if kept is not None:
        yield KEEP, COST[KEEP] + more, kept
    yield REROLE, COST[REROLE] + more, MADE[q]


def one_back(x: int, behind: tuple) -> tuple:
    """The vector in front of a row, from the one behind it."""
    return with_inserts([min(cost + behind[to] for _, cost, to in edits_of(x, q)) for q in STATES])


END = with_inserts([0, 1 << 20, 1 << 20, 0])


def less_minimum(costs: tuple) -> tuple[tuple, int]:
    low = min(costs)
    return tuple(c - low for c in costs), low


@cache
def vectors() -> tuple[list[tuple], list[list[tuple[int, int]]]]:
    """All vectors less their minimum, that at the end first; for each and every symbol, (vector in front, growth)."""
    found, steps = [less_minimum(END)[0]], []
    for v in found:
        steps.append([])
        for x in range(SYMBOLS):
            ahead, growth = less_minimum(one_back(x, v))
            if ahead not in found:
                found.append(ahead)
            steps[-1].append((found.index(ahead), growth))
    return found, steps


@cache
def blocks() -> dict[bytes, list[tuple[int, int]]]:
    """For every block of symbols and every vector behind it: (vector in front, growth)."""
    found, steps = vectors()
    table: dict[bytes, list[tuple[int, int]]] = {b"": [(v, 0) for v in range(len(found))]}
    for size in range(1, BLOCK + 1):
        for block in product(range(SYMBOLS), repeat=size):
            behind = table[bytes(block[1:])]
            table[bytes(block)] = [(steps[v][block[0]][0], growth + steps[v][block[0]][1]) for v, growth in behind]
    return table


@cache
def traced(block: bytes, behind: int, state: int) -> tuple[str, int]:
    """The edits of a block in a state, given the vector behind it, and the state they lead to."""
    ahead = [vectors()[0][behind]]
    for x in reversed(block):
        ahead.append(one_back(x, ahead[-1]))
    letters = []
    for k, x in enumerate(block):
        now, then = ahead[len(block) - k], ahead[len(block) - k - 1]
        while True:
            options = [(letter, to) for letter, cost, to in edits_of(x, state) if cost + then[to] == now[state]]
            if options and options[0][0] == DELETE or COST[INSERT] + now[MADE[state]] != now[state]:
                break
            letters.append(INSERT)
            state = MADE[state]
        letters.append(options[0][0])
        state = options[0][1]
    return "".join(letters), state


def boundaries(symbols: bytes, behind: int = 0) -> tuple[list[int], int]:
    """The vectors at the edges of the blocks, the first in front of all, and what the minimum grew by."""
    table, found, total = blocks(), [behind], 0
    for at in range((len(symbols) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        behind, growth = table[symbols[at : at + BLOCK]][behind]
        found.append(behind)
        total += growth
    return found[::-1], total


def trace(symbols: bytes, behind: int, state: int, last: bool) -> tuple[str, int]:
    """The least of the cheapest edits of some rows in a state, given the vector behind them, and the state they lead to."""
    edges, _ = boundaries(symbols, behind)
    parts = []
    for k, at in enumerate(range(0, len(symbols), BLOCK)):
        part, state = traced(symbols[at : at + BLOCK], edges[k + 1], state)
        parts.append(part)
    while last and END[state]:
        parts.append(INSERT)
        state = MADE[state]
    return "".join(parts), state


def cost_of(edits: str, symbols: bytes) -> int:
    total, rows = 0, iter(symbols)
    for letter in edits:
        total += COST[letter]
        if letter != INSERT:
            x = next(rows)
            total += CUT * (letter != DELETE and x != GO and (x - 1) % 2)
    return total


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """The roles and texts that edits leave."""
    kept_roles, kept_texts, k = [], [], 0
    for letter in edits:
        if letter in (INSERT, REROLE):
            kept_roles.append(NAMES[WANTED[state]])
            kept_texts.append("" if letter == INSERT else texts[k])
            state = MADE[state]
        elif letter == KEEP:
            kept_roles.append(roles[k])
            kept_texts.append(texts[k])
            state = STEPS[roles[k][0]][state]
        k += letter != INSERT
    return kept_roles, kept_texts


# --- segments -------------------------------------------------------------------------------------------------------


def sorted_rows(df: DataFrame, conv: str, turn: str, role: str, text: str, absent: Column | None) -> DataFrame:
    """conv, turn, role, text, fault (0 blank, 1 cut short, 2 none; null for absent rows), sorted over all partitions.

    Rows of one turn are in the order of role and the XXH64 of the text; equal rows are dealt over partitions by a number of
    their own.
    """
    content = F.coalesce(F.col(text), F.lit(" "))
    rest = F.rtrim(content, F.lit(BLANKS))
    fault = F.when(rest == "", 0).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), 1).otherwise(2)
    here = F.lit(True) if absent is None else ~F.coalesce(absent, F.lit(False))
    rows = df.select(
        F.col(conv).alias("conv"),
        F.when(here, F.col(turn)).cast("long").alias("turn"),
        F.when(here, F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(here, content).alias("text"),
        F.when(here, fault).alias("fault"),
    )
    rows = rows.withColumns({"hash": F.xxhash64("text"), "own": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "hash")]
    rows = rows.repartitionByRange(*order, "own").sortWithinPartitions(*order, F.col("text").asc_nulls_first(), "own")
    return rows.select("conv", "turn", "role", "text", "fault")


class Segment:
    """Rows of a conversation that follow each other."""

    def __init__(self, conv) -> None:
        self.conv, self.size = conv, 0
        self.roles, self.texts, self.symbols, self.digests = [], [], bytearray(), []
        self.counts = [0, 0, 0]  # blank, duplicate, truncated
        self.illegal, self.turns, self.low, self.high = 0, 0, None, None
        self.seen: set[bytes] = set()

    def add(self, turn: int | None, role: str | None, text: str, fault: int | None) -> None:
        if fault is None:
            return
        digest = None
        if fault == 0:
            self.counts[0] += 1
        else:
            digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            if digest in self.seen:
                self.counts[1] += 1
                digest = None
            else:
                self.seen.add(digest)
                self.counts[2] += fault == 1
        if self.roles:
            self.illegal += self.roles[-1][:1] + role[:1] not in LEGAL
        self.symbols.append(GO if digest is None else symbol(role, fault == 1))
        self.digests.append(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.size >= SEGMENT_BYTES

    def row(self, number: int, part: bool) -> tuple:
        """`part`: whether other segments may belong to the same conversation. Only then are digests kept."""
        digests = self.digests if part else []
        return (self.conv, number, part, self.roles, self.texts, bytes(self.symbols), digests, *self.counts, self.illegal, self.turns, self.low, self.high)


def segments(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Sorted rows as segments, numbered in their order; a conversation inside a partition is one whole segment."""
    long = LongType()
    schema = StructType(
        [StructField("conv", rows.schema["conv"].dataType), StructField("seg", long), StructField("part", BooleanType())]
        + [StructField(n, ArrayType(StringType())) for n in ("roles", "texts")]
        + [StructField("symbols", BinaryType()), StructField("digests", ArrayType(BinaryType()))]
        + [StructField(n, long) for n in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")]
    )
    arrow = to_arrow_schema(schema)

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 32
        segment, part = None, True  # the first and the last conversation of a partition may go on in others
        for batch in stream:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if segment is not None and (conv != segment.conv or segment.full(segment_rows)):
                    goes_on = conv == segment.conv
                    yield segment.row(number, part or goes_on)
                    number, part, segment = number + 1, goes_on or (part and conv == segment.conv), None
                if segment is None:
                    segment = Segment(conv)
                segment.add(*row)
        if segment is not None:
            yield segment.row(number, True)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches(cut(stream), arrow, 256)

    return bounded_batches(rows).mapInArrow(run, schema)


def seen_before(parts: DataFrame) -> DataFrame:
    """seg, late: digests of rows that an earlier segment of the same conversation has as well."""

    single = parts.select("conv", "seg", F.explode(F.filter("digests", lambda d: d.isNotNull())).alias("digest"))
    place = F.row_number().over(Window.partitionBy("conv", "digest").orderBy("seg"))
    again = single.withColumn("place", place).where("place > 1")
    return again.groupBy("seg").agg(F.collect_list("digest").alias("late"))


def without_late(symbols: bytes, digests: list, late: list | None) -> tuple[bytes, int, int]:
    """The symbols when late rows have to go, how many those are, and how many of them are cut short."""
    if not late:
        return symbols, 0, 0
    known, out = set(late), bytearray(symbols)
    places = [k for k, d in enumerate(digests) if d in known]
    short = sum((symbols[k] - 1) % 2 for k in places)
    for k in places:
        out[k] = GO
    return bytes(out), len(places), short


def chained(parts: DataFrame) -> DataFrame:
    """seg, behind, state, last, shared, seam: where each segment stands in its conversation.

    `shared` is 1 if its first turn is the last one of the segment before, `seam` 1 if the two roles where they meet are illegal.
    """
    listed = ArrayType(IntegerType())
    kept = [StructField(n, parts.schema[n].dataType) for n in ("conv", "seg", "low", "high")]
    schema = StructType([*kept, StructField("first", StringType()), StructField("final", StringType()), StructField("ahead", listed), StructField("ends", listed)])
    arrow = to_arrow_schema(schema)

    def sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in stream:
                for conv, seg, low, high, first, final, symbols, digests, late in zip(*(c.to_pylist() for c in batch.columns)):
                    symbols, _, _ = without_late(symbols, digests, late)
                    count = len(vectors()[0])
                    ahead = [boundaries(symbols, v)[0][0] for v in range(count)]
                    ends = [trace(symbols, v, q, False)[1] for v in range(count) for q in STATES]
                    yield conv, seg, low, high, first, final, ahead, ends

        return batches(rows(), arrow, 256)

    initials = [F.when(F.size("roles") > 0, F.substring(F.element_at("roles", k), 1, 1)) for k in (1, -1)]
    summed = bounded_batches(parts.select("conv", "seg", "low", "high", *initials, "symbols", "digests", "late")).mapInArrow(sums, schema)
    found = StructType([StructField(n, LongType()) for n in ("seg", "behind", "state")] + [StructField("last", BooleanType())] + [StructField(n, LongType()) for n in ("shared", "seam")])

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("seg")
        rows = table.to_pylist()
        behind = [0] * len(rows)
        for k in range(len(rows) - 1, 0, -1):
            behind[k - 1] = rows[k]["ahead"][behind[k]]
        state, high, final, out = 0, None, None, []
        for k, row in enumerate(rows):
            shared = row["low"] is not None and row["low"] == high
            seam = final is not None and row["first"] is not None and final + row["first"] not in LEGAL
            out.append((row["seg"], behind[k], state, k == len(rows) - 1, int(shared), int(seam)))
            state = row["ends"][behind[k] * len(STATES) + state]
            high = row["high"] if row["high"] is not None else high
            final = row["final"] if row["first"] is not None else final
        return pa.Table.from_pylist([dict(zip(found.names, r)) for r in out], schema=to_arrow_schema(found))

    return summed.groupBy("conv").applyInArrow(chain, found)


def repair(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    absent: Column | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Conversations repaired by the cheapest edits: their segments, one for nearly every conversation.

    conv, seg (ascending in a conversation), part, roles and texts (those that the edits leave), audit (the letters of
    the edits: D delete, I insert, K keep, R rerole; of equally cheap ones the least in ASCII), cost, blank, duplicate,
    truncated, illegal, turns, low, high: counts of this segment, and its different turns with the lowest and highest.

    Rows are taken by turn, those without one first; rows of one turn by role and XXH64 of the text. A null role or text is one
    space; a null conversation is one of its own. A role that begins with none of s, u and a, or is empty, can't be kept.
    Rows for which `absent` holds only name their conversation. Repeated rows are duplicates. Other columns are not read,
    so their names don't matter; an empty table has no segments. One row's text is held whole, never a conversation.
    """
    made = materialized(segments(sorted_rows(df, conv, turn, role, text, absent), segment_rows), "conversation-segments")
    parts = made.where("part")
    parts = parts.join(seen_before(parts), "seg", "left")
    placed = parts.join(chained(parts), "seg")
    whole = made.where("NOT part").withColumns(
        {"late": F.lit(None).cast("array<binary>"), "behind": F.lit(0).cast("long"), "state": F.lit(0).cast("long"), "last": F.lit(True)}
        | {n: F.lit(0).cast("long") for n in ("shared", "seam")}
    )
    fields = ["conv", "seg", "part", "roles", "texts", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
    schema = StructType([*(made.schema[n] for n in fields), StructField("audit", StringType()), StructField("cost", LongType())])
    arrow = to_arrow_schema(schema)
    taken = [*made.columns, "late", "behind", "state", "last", "shared", "seam"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in stream:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    r = dict(zip(taken, row))
                    symbols, late, short = without_late(r["symbols"], r["digests"], r["late"])
                    edits, _ = trace(symbols, r["behind"], r["state"], r["last"])
                    roles, texts = apply_edits(edits, r["state"], r["roles"], r["texts"])
                    counts = r["blank"], r["duplicate"] + late, r["truncated"] - short, r["illegal"] + r["seam"]
                    span = r["turns"] - r["shared"], r["low"], r["high"]
                    yield r["conv"], r["seg"], r["part"], roles, texts, *counts, *span, edits, cost_of(edits, symbols)

        return batches(rows(), arrow, 64)

    return bounded_batches(whole.select(*taken).unionByName(placed.select(*taken))).mapInArrow(run, schema)


def repaired_rows(found: DataFrame) -> DataFrame:
    """conv, seg, place, role, text: the rows of `repair`ed conversations, in the order of seg and place."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")
    return found.select("conv", "seg", both).select("conv", "seg", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


def report(found: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every conversation of `repair`.

    gaps: turns missing between the lowest and the highest, 0 without any. The hash is that of the lines `role:text`, and of
    an empty string without lines. A conversation in parts is hashed as a stream, in one task, since a hash is a sequence.
    """
    lines = F.array_join(F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    columns = ["conv", gaps, *counts, "audit", "repaired_sha256"]
    found = materialized(found.withColumns({"lines": lines, "filled": F.size("roles") > 0}).drop("roles", "texts"), "conversation-repairs")
    whole = found.where("NOT part").withColumn("repaired_sha256", F.sha2("lines", 256)).select(*columns)
    parts = found.where("part")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda s: s["audit"]), "").alias("audit")
    summed = parts.groupBy("conv").agg(*(F.sum(c).alias(c) for c in (*counts, "turns")), F.min("low").alias("low"), F.max("high").alias("high"), audit)
    hashed = StructType([parts.schema["conv"], StructField("repaired_sha256", StringType())])
    arrow = to_arrow_schema(hashed)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            conv = state = None
            for batch in stream:
                for name, text, filled in zip(*(c.to_pylist() for c in batch.columns)):
                    if state is None or name != conv:
                        if state is not None:
                            yield conv, state.hexdigest()
                        conv, state, begun = name, hashlib.sha256(), False
                    if filled:
                        state.update((b"\n" if begun else b"") + text.encode())
                        begun = True
            if state is not None:
                yield conv, state.hexdigest()

        return batches(rows(), arrow)

    in_order = parts.select("conv", "lines", "filled", "seg").repartition("conv").sortWithinPartitions("conv", "seg")
    hashes = bounded_batches(in_order.select("conv", "lines", "filled")).mapInArrow(run, hashed)
    joined = summed.join(hashes.withColumnRenamed("conv", "name"), F.col("conv").eqNullSafe(F.col("name"))).select(*columns)
    return whole.unionByName(joined)


def damaged(df: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations damaged by the CRC-32 of `conv_id:turn` modulo 20, and which of the rows it drops.

    0 drops the row, 1 empties its text, 2 removes the marks that end sentences, 3 repeats it, 4 makes it the user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    number = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    times = F.explode(F.when(number == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    changed = df.select(
        "conv_id",
        "turn",
        F.when(number == 4, "user").otherwise(role).alias("role"),
        F.when(number == 1, "").when(number == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (number == 0).alias("dropped"),
        times.alias("time"),
    )
    return changed.drop("time"), F.col("dropped")
