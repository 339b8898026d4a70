"""Byte-level BPE by a segment tree over the ranks of adjacent pairs.

The leaf of a position holds the rank of the pair that begins there, made one number with the position; inner nodes hold
the smaller of their children, so the root is the leftmost pair of the lowest rank. A merge changes three leaves (its own,
that of the token it swallows and that of the token before), each with one path to the root; it ends when the root is empty.

Words of up to `WIDEST` bytes are merged side by side, as rows of trees of one size in numpy; longer ones one by one, in
time n log n and memory n. A worker remembers the words it has seen, up to `HELD` bytes of them, since words repeat.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from chronofold.llm.common import bounded_batches, whole_text

# How byte-level vocabularies cut a text into words, and which bytes they write as themselves.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SELVES = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Beyond these, versions of Unicode differ in what is a letter; such texts are cut by the tokenizers library's own tables.
SETTLED = re.compile(r"[^\x00-\u0557]")

WIDEST = 64
HELD = 6 << 20
STEP_CHARS = 1 << 20  # texts that are encoded together
EMPTY = np.int32((1 << 31) - 1)


class Numbers(dict):
    """Word -> number, in order of first sight; `fresh` are those not merged yet."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = len(self)
        return len(self) - 1


class Vocabulary:
    """The merges of a byte-level `tokenizers` file, and the words met so far."""

    _held: dict[str, Vocabulary] = {}

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, cut = data["model"], data["pre_tokenizer"] or {}
        plain = not any(data.get(k) for k in ("normalizer", "truncation", "padding"))
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not plain or odd:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        others = [b for b in range(256) if b not in set(SELVES)]
        shown = {b: chr(b) for b in SELVES} | {b: chr(256 + k) for k, b in enumerate(others)}
        known = model["vocab"]
        self.byte_ids = np.array([known[shown[b]] for b in range(256)], np.int32)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        keys = np.array([known[a] << 32 | known[b] for a, b in pairs], np.int64)
        made = np.array([known[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        hidden = {c: b for b, c in shown.items()}
        self.bytes_of = {number: bytes(hidden[c] for c in token) for token, number in known.items()}
        self.added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        if any(t[k] for t in data.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        self.bytes_of |= {number: token.encode() for token, number in self.added.items()}
        spelled = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.special = re.compile(f"({spelled})") if spelled else None
        self._cutter = None
        self._forget()

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def _forget(self) -> None:
        self.numbers, self.size = Numbers(), 0
        self.starts, self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    # --- words ---

    def words(self, text: str) -> list[str]:
        """The words of a text; a spelled-out added token is a word of its own."""
        if self.special is None or not self.special.search(text):
            return self._cut(text)
        parts = self.special.split(text)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self._cut(part))]

    def _cut(self, text: str) -> list[str]:
        if text.isascii() or not SETTLED.search(text):
            return WORDS.findall(text)
        if self._cutter is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self._cutter = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self._cutter.pre_tokenize_str(text)]

    # --- merges ---

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 for none. A token of -1 is no token."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge_rows(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all their ids) for words of up to `width` + 1 bytes; `width` is a power of two."""
        n, bits = len(words), width.bit_length() - 1
        sizes = np.fromiter(map(len, words), np.int64, n)
        places = np.arange(width + 2)
        tokens = np.full((n, width + 2), -1, np.int32)
        tokens[places < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        left, right = np.tile(places - 1, (n, 1)), np.tile(places + 1, (n, 1))

        def leaf(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
            return np.where(rank >= 0, rank << bits | place, EMPTY).astype(np.int32)

        tree = np.full((n, 2 * width), EMPTY, np.int32)
        tree[:, width:] = leaf(self._rank(tokens[:, :width], tokens[:, 1 : width + 1]), places[:width])
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < EMPTY)
        while len(live):
            root = tree[live, 1]
            at, token = root & (width - 1), self.made[root >> bits]
            swallowed = right[live, at]
            after, before = right[live, swallowed], left[live, at]
            tokens[live, at], tokens[live, swallowed] = token, -1
            right[live, at], left[live, after] = after, at
            own = leaf(self._rank(token, tokens[live, after]), at)
            first = before < 0
            ahead = np.where(first, own, leaf(self._rank(np.where(first, -1, tokens[live, before]), token), before))
            last = swallowed >= width  # the last token of a full row begins no pair, so it has no leaf
            nodes = np.concatenate((at, np.where(first, at, before), np.where(last, at, swallowed))) + width
            rows = np.tile(live, 3)
            tree[rows, nodes] = np.concatenate((own, ahead, np.where(last, own, EMPTY)))
            for _ in range(bits):
                nodes >>= 1
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
            live = live[tree[live, 1] < EMPTY]
        there = tokens >= 0
        return there.sum(axis=1), tokens[there]

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one word of any length."""
        tokens = array("q", self.byte_ids[np.frombuffer(word, np.uint8)].tolist())
        n, ranks, made = len(tokens), self.rank_of, self.made.tolist()
        width = 1 << max(n - 2, 0).bit_length()
        bits, none = width.bit_length() - 1, 1 << 62
        tree = array("q", [none]) * (2 * width)
        for k in range(n - 1):
            rank = ranks.get(tokens[k] << 32 | tokens[k + 1])
            if rank is not None:
                tree[width + k] = rank << bits | k
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        left, right = array("q", range(-1, n)), array("q", range(1, n + 2))

        def put(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            while node > 1:
                node >>= 1
                smaller = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == smaller:
                    break  # nothing changes above
                tree[node] = smaller

        while n > 1 and (root := tree[1]) < none:
            at = root & (width - 1)
            token, swallowed = made[root >> bits], right[at]
            after, before = right[swallowed], left[at]
            tokens[at], tokens[swallowed] = token, -1
            right[at], left[after] = after, at
            if swallowed < n - 1 or swallowed < width:
                put(swallowed, none)
            rank = ranks.get(token << 32 | tokens[after]) if after < n else None
            put(at, none if rank is None else rank << bits | at)
            if before >= 0:
                rank = ranks.get(tokens[before] << 32 | token)
                put(before, none if rank is None else rank << bits | before)
        found = np.frombuffer(tokens, np.int64)
        return found[found >= 0].astype(np.int32)

    def _learn(self) -> None:
        """Merge the words that were met for the first time."""
        fresh = self.numbers.fresh
        if not fresh:
            return
        raw = [w.encode() for w in fresh]
        groups: dict[int, list[int]] = {}
        found: list[np.ndarray | None] = [None] * len(raw)
        for k, word in enumerate(raw):
            if fresh[k] in self.added:
                found[k] = np.array([self.added[fresh[k]]], np.int32)
            elif len(word) > WIDEST:
                found[k] = self.merge_long(word)
            else:
                groups.setdefault(1 << max(len(word) - 2, 0).bit_length(), []).append(k)
        for width, members in groups.items():
            counts, ids = self.merge_rows([raw[k] for k in members], width)
            for k, part in zip(members, np.split(ids, np.cumsum(counts)[:-1])):
                found[k] = part
        counts = np.fromiter(map(len, found), np.int64, len(found))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, *found))
        self.size += sum(map(len, raw))
        self.numbers.fresh = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all their ids)."""
        if self.size > HELD:
            self._forget()
        cut = [self.words(t) for t in texts]
        used = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        self._learn()
        counts = self.counts[used]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[used] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        stops = np.concatenate(([0], ends))[np.cumsum([0, *map(len, cut)])]
        return np.diff(stops), ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, ids that are in no vocabulary nothing."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids]).decode("utf-8", "replace")


def encode_documents(df: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id and ids (an array) for every row of `df`, as the tokenizers library makes them without special tokens.

    `tokenizer` is a byte-level vocabulary file that workers can read. A null or empty text has no ids. Repeated rows and
    null ids are rows of their own; other columns are not read; an empty table stays empty.
    """
    schema = StructType([StructField("doc_id", df.schema[id_col].dataType), StructField("ids", ArrayType(IntegerType(), False))])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(tokenizer)
        for batch in stream:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            begin = held = 0
            for k, content in enumerate(texts):
                held += len(content)
                if held >= STEP_CHARS or k == len(texts) - 1:
                    counts, ids = vocabulary.encode(texts[begin : k + 1])
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)).cast(arrow.field(1).type)
                    yield pa.RecordBatch.from_arrays([names.slice(begin, len(counts)).cast(arrow.field(0).type), lists], schema=arrow)
                    begin, held = k + 1, 0

    return bounded_batches(df.select(F.col(id_col), whole_text(text).alias("text"))).mapInArrow(run, schema)


def decode_documents(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows of `df` with the text of their ids in a further column. Null ids, like none, give an empty text."""
    if out in df.columns:
        raise ValueError(f"there is a column {out!r} already")
    place = df.columns.index(ids)
    schema = StructType([*df.schema.fields, StructField(out, StringType())])
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(tokenizer)
        for batch in stream:
            texts = [vocabulary.decode(row.values.to_pylist() if row.is_valid else []) for row in batch.column(place)]
            columns = [*batch.columns, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return bounded_batches(df).mapInArrow(run, schema)
