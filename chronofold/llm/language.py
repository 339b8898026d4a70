"""Language by cross-parsing entropy.

Each language has the suffix automaton of a bounded sample of labelled text. A text is parsed with every automaton: each
phrase is the longest match with the sample from where the last one ended. Phrases times the logarithm of the sample's
length, by the length of the text, estimate the bits per letter; the language that needs fewest wins.

Automata are tables of transitions, and thousands of stretches of whole texts are parsed side by side in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from chronofold.llm.common import bounded_batches, materialized, whole_text

# Bounds of the sample of each language: documents, characters of one document, letters in all.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LETTERS = 96, 1500, 40_000
LETTERS = 60  # letters with a column in the tables of transitions; those of other letters are looked up by key
STRETCH = 256
NEW = 1 << 30  # marks a transition that begins a phrase
NO_LETTER = "und"


def letters(text):
    """Lower case, with one space for every run of anything else: column in, column out."""
    return F.trim(F.lower(F.regexp_replace(whole_text(text), r"[^\p{L}]+", " ")))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start. The usual online construction."""
    go, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        state = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = state
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return go


class Parser:
    """What is learned: a symbol for every letter of the samples and, for each language, its automaton with its bits per phrase.

    Transitions by the most frequent letters are a table, which a script with few letters fits into as a whole. The others
    are sorted keys of state and symbol. Letters that no sample has share a symbol without transitions: each is a phrase.
    """

    def __init__(self, samples: dict[str, str]) -> None:
        common = [c for c, _ in Counter("".join(samples.values())).most_common()]
        order = np.argsort(np.array([ord(c) for c in common], np.uint32))
        self.points, self.numbers = np.array([ord(c) for c in common], np.uint32)[order], order
        self.dense = min(len(common), LETTERS)
        self.fill = len(common) + 1  # fills up stretches; the symbol before it is that of unseen letters
        self.width = self.dense + 1  # columns of the table; the last one keeps the state
        self.languages = sorted(samples)
        self.tables, self.sparse, self.bits = [], [], []
        for language in self.languages:
            symbols = self.symbols(samples[language]).tolist()
            go = suffix_automaton(symbols)
            start = np.full(self.width, NEW, np.int32)
            for c, state in go[0].items():
                if c < self.dense:
                    start[c] = NEW | state
            table = np.tile(start, (len(go), 1))
            table[:, -1] = np.arange(len(go))
            keys = {}
            for state, edges in enumerate(go):
                for c, to in edges.items():
                    if c < self.dense:
                        table[state, c] = to
                    else:
                        keys[state << 32 | c] = to
            self.tables.append(table.ravel())
            found = np.array(sorted(keys), np.int64)
            self.sparse.append((found, np.array([keys[k] for k in found.tolist()], np.int32)))
            self.bits.append(float(np.log2(len(symbols) + 2)))

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.searchsorted(self.points, points).clip(max=len(self.points) - 1)
        return np.where(self.points[place] == points, self.numbers[place], len(self.points)).astype(np.int32)

    @staticmethod
    def _by_key(keys: np.ndarray, goals: np.ndarray, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where rare letters lead: on, or into a new phrase that begins with them, or with nothing known after them."""
        out = np.full(len(state), NEW, np.int32)
        if len(keys):
            for begin, mark in ((np.zeros_like(state), NEW), (state, 0)):
                wanted = begin.astype(np.int64) << 32 | symbols
                at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
                hit = keys[at] == wanted
                out[hit] = goals[at[hit]] | mark
        return out

    def needs(self, texts: list[str]) -> np.ndarray:
        """Bits that each language needs for each whole text: texts by languages."""
        coded = self.symbols("".join(texts))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        stretches = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), stretches)
        ends = np.cumsum(stretches)
        grid = np.full(len(owner) * STRETCH, self.fill, np.int32)
        first = np.repeat((ends - stretches) * STRETCH, sizes)
        grid[first + np.arange(len(coded)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = coded
        columns = np.ascontiguousarray(grid.reshape(-1, STRETCH).T)
        others = (columns >= self.dense) & (columns < self.fill)
        rare = [np.flatnonzero(row) if any_ else None for row, any_ in zip(others, others.any(axis=1))]
        # In the table, letters that are looked up by key take the column that keeps the state.
        tabled = np.minimum(columns, self.dense)
        out = np.zeros((len(texts), len(self.tables)))
        for k, (table, (keys, goals), bits) in enumerate(zip(self.tables, self.sparse, self.bits)):
            state = np.zeros(len(owner), np.int32)
            phrases = np.ones(len(owner), np.int32)
            for symbols, seldom, full in zip(tabled, rare, columns):
                kept = None if seldom is None else state[seldom]
                state *= self.width
                state += symbols
                step = table[state]
                if kept is not None:
                    step[seldom] = self._by_key(keys, goals, kept, full[seldom])
                phrases += step >> 30
                state = step & (NEW - 1)
            out[:, k] = np.bincount(owner, phrases, len(texts)) * bits
        return out


def learn(df: DataFrame, text: str, id_col: str, lang: str, docs: int, chars: int, total: int) -> Parser | None:
    """Fits on at most `docs` rows of each language, those with the smallest hashes of their ids, and a stretch of `chars` of each."""
    order = F.xxhash64(id_col)
    first = F.row_number().over(Window.partitionBy(lang).orderBy("__order", id_col))
    chosen = df.where(F.col(lang).isNotNull()).select(id_col, lang, order.alias("__order")).withColumn("__place", first)
    chosen = materialized(chosen.where(F.col("__place") <= docs).select(F.col(id_col).alias("__id"), "__order"), "language-sample")
    start = 1 + F.pmod("__order", F.greatest(F.length(text) - chars + 1, F.lit(1)))
    piece = F.substring(F.col(text), start.cast("int"), F.lit(chars))
    sample = df.where(F.col(lang).isNotNull()).join(chosen, F.col(id_col) == F.col("__id"))
    held: dict[str, list[str]] = {}
    for row in sorted(sample.select(F.col(lang).alias("lang"), "__order", letters(piece).alias("text")).collect()):
        held.setdefault(row["lang"], []).append(row["text"])
    samples = {k: " ".join(v)[:total] for k, v in held.items() if any(v)}
    return Parser(samples) if samples else None


def identify(
    df: DataFrame,
    train: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    lang: str = "lang",
    docs: int = SAMPLE_DOCS,
    chars: int = SAMPLE_CHARS,
    total: int = SAMPLE_LETTERS,
) -> DataFrame:
    """doc_id, lang_pred, score for every row of `df`; only its id and text are read.

    `train` has labelled rows; the sample per language is bounded by `docs`, `chars` and `total`. `und` with score 0 if a
    text is null or without letters, or if nothing could be learned. Parsing begins anew every `STRETCH` = 256 letters, so a
    longest match ends there and a text has a phrase more per stretch, in every language alike. Score: the share of the winner if every 8 bits
    fewer make a language twice as likely. Rows without an id are not learned
    from. Repeated rows are rows of their own, ties go to the first language by name. An empty table stays empty.
    """
    schema = StructType([StructField("doc_id", df.schema[id_col].dataType), StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    parser = learn(train, text, id_col, lang, docs, chars, total)
    if parser is None:
        return df.select(F.col(id_col).alias("doc_id"), F.lit(NO_LETTER).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = df.sparkSession.sparkContext.broadcast(parser)
    arrow = to_arrow_schema(schema)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in stream:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            bits = model.needs(texts)
            best = bits.argmin(axis=1)
            share = 1 / np.exp2((bits.min(axis=1)[:, None] - bits).clip(-8000, 0) / 8).sum(axis=1)
            known = np.fromiter(map(bool, texts), bool, len(texts))
            names = [model.languages[k] if ok else NO_LETTER for k, ok in zip(best, known)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))], schema=arrow)

    return bounded_batches(df.select(F.col(id_col), letters(text))).mapInArrow(run, schema)
