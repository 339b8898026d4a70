"""Exact duplicates by Patricia-trie owners.

Two levels of compressed radix tries over full byte strings decide which texts are equal:

1. Every input partition inserts its normalised texts into one trie. A terminal stands for one text; its rows never leave
   the partition. A group of copies that holds a third of all rows thus becomes one row per partition.
2. One row per text and partition goes to the partition of its length and content hash, where a trie per (length, hash)
   joins the terminals and keeps the smallest identifier.

The rows then look up the owner of their terminal. A trie of the first level that outgrows its budget spills its heaviest
subtree: the terminals below are passed on and forgotten, and the second level joins what comes later. A trie of the
second level holds only the strings of one length and hash, which is one text unless hashes collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, BinaryType, StructField, StructType

from chronofold.llm.common import SPACES, batches, bounded_batches, materialized, order_key, row_key, rows_of_keys, whole_text

TRIE_BYTES = 48 << 20  # label bytes that a trie of the first level may hold
NODE_BYTES = 300  # what a node costs besides its label


class Node:
    __slots__ = ("label", "below", "terminal")

    def __init__(self, label: bytes, terminal=None) -> None:
        self.label, self.below, self.terminal = label, {}, terminal


class PatriciaTrie:
    """A compressed radix trie of byte strings; a terminal is whatever `make()` returned when its string first came."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.bytes = 0

    def at(self, key: bytes, make):
        """The terminal of `key`, made by `make()` if the key is new."""
        node, done = self.root, 0
        while done < len(key):
            child = node.below.get(key[done])
            if child is None:
                leaf = node.below[key[done]] = Node(key[done:])
                self.bytes += len(leaf.label) + NODE_BYTES
                node = leaf
                break
            if not key.startswith(child.label, done):
                child = self._split(node, child, _shared(child.label, key, done))
            node, done = child, done + len(child.label)
        if node.terminal is None:
            node.terminal = make()
        return node.terminal

    def _split(self, parent: Node, child: Node, length: int) -> Node:
        upper = Node(child.label[:length])
        child.label = child.label[length:]
        upper.below[child.label[0]] = child
        parent.below[upper.label[0]] = upper
        self.bytes += NODE_BYTES
        return upper

    def items(self) -> Iterator[tuple[bytes, object]]:
        return _items(self.root, b"")

    def spill(self) -> Iterator[tuple[bytes, object]]:
        """Cuts off the heaviest subtree below the root and yields its strings with their terminals."""
        node, prefix = self.root, b""
        while len(node.below) == 1 and node.terminal is None:  # a common beginning is no reason to spill everything
            (child,) = node.below.values()
            if not child.below:
                break
            node, prefix = child, prefix + child.label
        if node.below:
            first = max(node.below, key=lambda k: _weight(node.below[k]))
            cut = node.below.pop(first)
            self.bytes -= _weight(cut)
            yield from _items(cut, prefix)


def _shared(label: bytes, key: bytes, start: int) -> int:
    """Length of the common beginning, by bisection on slices."""
    low, high = 0, min(len(label), len(key) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _weight(top: Node) -> int:
    total, stack = 0, [top]
    while stack:
        node = stack.pop()
        total += len(node.label) + NODE_BYTES
        stack += node.below.values()
    return total


def _items(top: Node, prefix: bytes) -> Iterator[tuple[bytes, object]]:
    stack = [(top, prefix)]
    while stack:
        node, before = stack.pop()
        text = before + node.label
        if node.terminal is not None:
            yield text, node.terminal
        stack += [(child, text) for child in node.below.values()]


class Terminal:
    """One text: its smallest identifier with the row that carries it, and the rows seen."""

    __slots__ = ("rep", "owner", "row", "rows", "reps", "hash")

    def __init__(self, rep: int, hash_: int = 0) -> None:
        self.rep, self.owner, self.row, self.rows, self.reps, self.hash = rep, None, -1, 0, [], hash_

    def take(self, owner, row: int, rows: int) -> None:
        if self.rows == 0 or (order_key(owner), row) < (order_key(self.owner), self.row):
            self.owner, self.row = owner, row
        self.rows += rows


def duplicate_owners(df: DataFrame, text: str = "text", id_col: str = "doc_id", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of `df`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of white space became one space. A null text is empty. Of
    equal texts the row with the smallest id stays, a null id counting as the largest; of repeated rows with that id one
    stays. Other columns of `df` are not read. An empty table gives an empty result.
    """
    id_type = df.schema[id_col].dataType
    normal = F.regexp_replace(whole_text(text), SPACES, " ")
    texts = df.select(F.col(id_col).alias("id"), normal.alias("text")).select(
        "id", F.col("text").cast("binary").alias("text"), F.sha2("text", 256).alias("sha"), F.xxhash64("text").alias("hash")
    )
    # Rows of documents have a sha, rows of texts have the text.
    level_one = StructType(
        [
            StructField("id", id_type),
            StructField("row", LongType()),
            StructField("rep", LongType()),
            StructField("rows", LongType()),
            StructField("sha", StringType()),
            StructField("hash", LongType()),
            StructField("text", BinaryType()),
        ]
    )
    arrow_one = to_arrow_schema(level_one)

    def local_tries(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        trie = PatriciaTrie()
        for batch in stream:
            members = []
            for owner, content, sha, hash_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                terminal = trie.at(content, lambda row=row, hash_=hash_: Terminal(row, hash_))
                terminal.take(owner, row, 1)
                members.append((owner, row, terminal.rep, None, sha, None, None))
                row += 1
            yield from batches(members, arrow_one)
            while trie.bytes > trie_bytes:
                yield from batches(_texts(trie.spill()), arrow_one, 200)
        yield from batches(_texts(trie.items()), arrow_one, 200)

    owner_schema = StructType(
        [
            StructField("rep", LongType()),
            StructField("keep_id", id_type),
            StructField("keep_row", LongType()),
            StructField("group_size", LongType()),
        ]
    )
    arrow_owner = to_arrow_schema(owner_schema)

    def owners(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            trie, run = PatriciaTrie(), None
            for batch in stream:
                columns = (batch.column(c).to_pylist() for c in ("length", "hash", "text", "rep", "id", "row", "rows"))
                for length, hash_, content, rep, owner, row, count in zip(*columns, strict=True):
                    if (length, hash_) != run:
                        yield from _owned(trie)
                        trie, run = PatriciaTrie(), (length, hash_)
                    terminal = trie.at(content, lambda rep=rep: Terminal(rep))
                    terminal.take(owner, row, count)
                    terminal.reps.append(rep)
            yield from _owned(trie)

        return batches(rows(), arrow_owner)

    parts = materialized(bounded_batches(texts).mapInArrow(local_tries, level_one), "exact-dedup")
    keyed = parts.where(F.col("text").isNotNull()).withColumn("length", F.length("text"))
    found = keyed.select("length", "hash", "text", "rep", "id", "row", "rows").repartition("length", "hash")
    found = found.sortWithinPartitions("length", "hash").mapInArrow(owners, owner_schema)
    members = parts.where(F.col("sha").isNotNull()).select("id", "row", "rep", "sha")
    return members.join(found, "rep").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _texts(items) -> Iterator[tuple]:
    for content, t in items:
        yield t.owner, t.row, t.rep, t.rows, None, t.hash, content


def _owned(trie: PatriciaTrie) -> Iterator[tuple]:
    for _, t in trie.items():
        for rep in t.reps:
            yield rep, t.owner, t.row, t.rows


def drop_duplicates(df: DataFrame, text: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `df` whose text is the first of its kind, with all columns of `df`; one of rows that are repeated whole."""
    kept = duplicate_owners(df, text, id_col, **options).where("kept")
    normal = F.sha2(F.regexp_replace(whole_text(text), SPACES, " "), 256)
    return rows_of_keys(df, row_key(id_col, normal), kept.select(row_key("doc_id", F.col("text_sha256")).alias("key")))
