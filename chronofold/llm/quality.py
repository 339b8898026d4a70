"""A quality classifier: a byte-level convolutional network in numpy.

Learned filters run over the bytes of a whole document. Overlapping chunks of 256 bytes, one every 128, each keep the largest
response of every filter; what the chunks kept is averaged, passes a hidden layer, and becomes one probability. A filter
over six bytes is a sum of six table entries, so the tables are joined in pairs of bytes: three look-ups for all filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from chronofold.llm.common import bounded_batches, materialized, whole_text

# Bounds of learning: labelled rows, stretches of each row that a step looks at, rows of a step, steps.
SAMPLE_ROWS, STRETCHES, STEP_ROWS, STEPS = 3200, 6, 64, 320
CHUNK, STRIDE, WIDTH, FILTERS, HIDDEN = 256, 128, 6, 24, 12
THRESHOLD = 0.7
AT_ONCE = 1 << 15  # bytes whose responses are held at a time


class ByteNetwork:
    """Parameters: tables (byte position, byte value, filter), bias of filters, hidden layer, output layer."""

    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.p = {
            "tables": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }
        self.pairs: list[np.ndarray] = []

    # --- scoring --------------------------------------------------------------------------------------------------

    def join_pairs(self) -> None:
        """The tables by pairs of bytes; the index is the first byte plus 256 times the second."""
        t = self.p["tables"]
        self.pairs = [(t[k][None, :, :] + t[k + 1][:, None, :]).reshape(1 << 16, FILTERS) for k in range(0, WIDTH, 2)]
        self.pairs[0] = self.pairs[0] + self.p["bias"]

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of label 1. Documents lie one after the other, filled up with zero bytes to whole strides."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        blocks = (sizes + WIDTH - 1) // STRIDE + 1
        first = np.cumsum(blocks) - blocks
        data = np.zeros(int(blocks.sum()) * STRIDE + WIDTH, np.uint8)
        for text, at in zip(texts, (first * STRIDE).tolist()):
            data[at : at + len(text)] = np.frombuffer(text, np.uint8)
        pair = data[:-1].astype(np.uint16)
        pair |= data[1:].astype(np.uint16) << np.uint16(8)
        total = int(blocks.sum())
        most = np.empty((total, FILTERS), np.float32)
        real = np.maximum(sizes, 1)  # an empty document has one response, to zero bytes
        fill = np.ones(total * STRIDE, bool)
        for at, size, count in zip((first * STRIDE).tolist(), real.tolist(), blocks.tolist()):
            fill[at : at + size] = False
        step = AT_ONCE // STRIDE
        for block in range(0, total, step):
            count = min(step, total - block)
            begin, n = block * STRIDE, count * STRIDE
            sums = self.pairs[0].take(pair[begin : begin + n], axis=0)
            for k in range(1, len(self.pairs)):
                sums += self.pairs[k].take(pair[begin + 2 * k : begin + 2 * k + n], axis=0)
            sums[fill[begin : begin + n]] = -1e9
            most[block : block + count] = sums.reshape(count, STRIDE, FILTERS).max(axis=1)
        used = np.maximum(-(-real // STRIDE), 1)  # strides that hold a byte of the document
        chunks = np.maximum(used - 1, 1)
        both = np.maximum(most, np.concatenate((most[1:], most[-1:])))
        both = np.where(np.isin(np.arange(total), first[used == 1])[:, None], most, both)
        owner = np.repeat(np.arange(len(texts)), chunks)
        rows = np.repeat(first - np.cumsum(chunks) + chunks, chunks) + np.arange(len(owner))
        pooled = np.maximum(both[rows], 0)
        mean = np.add.reduceat(pooled, np.cumsum(chunks) - chunks, axis=0, dtype=np.float64) / chunks[:, None] if len(texts) else pooled
        return self._head(mean)[1]

    def _head(self, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(mean @ self.p["hidden"] + self.p["hidden_bias"])
        return hidden, 1 / (1 + np.exp(-np.clip(hidden @ self.p["out"] + self.p["out_bias"], -30, 30)))

    # --- learning -------------------------------------------------------------------------------------------------

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 1) -> None:
        """Adam on the logistic loss. A step sees stretches from all over its documents; only the largest responses have gradients."""
        rng = np.random.default_rng(seed)
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        waiting: list[int] = []
        for t in range(1, steps + 1):
            while len(waiting) < STEP_ROWS:
                waiting += rng.permutation(len(texts)).tolist()
            rows, waiting = np.array(waiting[:STEP_ROWS]), waiting[STEP_ROWS:]
            rate = 0.02 * (1 - t / (steps + 1))
            for k, g in self._gradients([texts[r] for r in rows], labels[rows], rng).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                self.p[k] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)

    def _gradients(self, texts: list[bytes], labels: np.ndarray, rng) -> dict[str, np.ndarray]:
        windows, owner = [], []
        for k, text in enumerate(texts):
            places = -(-len(text) // STRIDE) - 1
            starts = np.arange(places) if places <= STRETCHES else rng.choice(places, STRETCHES, replace=False)
            for start in starts if places > 0 else [0]:
                part = text[start * STRIDE : start * STRIDE + CHUNK + WIDTH - 1]
                windows.append((part + bytes(CHUNK + WIDTH - 1 - len(part)), min(CHUNK, max(1, len(text) - start * STRIDE))))
                owner.append(k)
        owner = np.array(owner)
        data = np.frombuffer(b"".join(w for w, _ in windows), np.uint8).reshape(len(windows), -1)
        sums = np.zeros((len(windows), CHUNK, FILTERS), np.float32) + self.p["bias"]
        for k in range(WIDTH):
            sums += self.p["tables"][k].take(data[:, k : k + CHUNK], axis=0)
        sums[np.arange(CHUNK)[None, :] >= np.array([n for _, n in windows])[:, None]] = -1e9
        best = sums.argmax(axis=1)
        top = np.take_along_axis(sums, best[:, None, :], axis=1)[:, 0, :]
        counts = np.bincount(owner, minlength=len(texts))
        mean = np.add.reduceat(np.maximum(top, 0), np.cumsum(counts) - counts, axis=0) / counts[:, None]
        hidden, chance = self._head(mean)
        error = ((chance - labels) / len(texts)).astype(np.float32)
        back = error[:, None] * self.p["out"] * (1 - hidden**2)
        to_top = (back @ self.p["hidden"].T / counts[:, None])[owner] * (top > 0)
        tables = np.zeros_like(self.p["tables"])
        filters = np.broadcast_to(np.arange(FILTERS), best.shape)
        for k in range(WIDTH):
            np.add.at(tables[k], (np.take_along_axis(data, best + k, axis=1), filters), to_top)
        grads = {
            "tables": tables,
            "bias": to_top.sum(axis=0),
            "hidden": mean.T @ back,
            "hidden_bias": back.sum(axis=0),
            "out": hidden.T @ error,
            "out_bias": error.sum(keepdims=True),
        }
        decay = {"tables": 1e-5, "hidden": 1e-4, "out": 1e-4}
        return {k: (g + decay.get(k, 0) * self.p[k]).astype(np.float32) for k, g in grads.items()}


def learn(df: DataFrame, labels: DataFrame, text: str, id_col: str, label: str, rows: int, steps: int) -> ByteNetwork | None:
    """A network fitted on the `rows` labelled rows with the smallest hashes of their ids; None without labels."""
    named = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label).alias("__label"))
    chosen = materialized(named.orderBy(F.xxhash64("__id"), "__id").limit(rows), "quality-sample")
    sample = df.join(chosen, F.col(id_col) == F.col("__id")).select("__id", F.col("__label").cast("double"), whole_text(text).cast("binary"))
    found = sorted(tuple(r) for r in sample.collect())
    if not found:
        return None
    network = ByteNetwork()
    network.fit([bytes(t) for _, _, t in found], np.array([v for _, v, _ in found], np.float32), steps)
    return network


def score_quality(
    df: DataFrame,
    train: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    threshold: float = THRESHOLD,
    rows: int = SAMPLE_ROWS,
    steps: int = STEPS,
    keep: list[str] | None = None,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """doc_id and `names` (score, 0/1) for every row of `df`, or its columns `keep` with both. Scores depend on the text alone.

    `train` has the texts that may be learned from, `labels` their ids and labels; at most `rows` of them are used. A null text
    is empty and has a score as well. Without labels every score is 0.5. Repeated rows are rows of their own.
    """
    network = learn(train, labels, text, id_col, label, rows, steps)
    return scored(df, network, text, id_col, threshold, keep, names)


def scored(df: DataFrame, network: ByteNetwork | None, text: str, id_col: str, threshold: float, keep: list[str] | None, names: tuple[str, str]) -> DataFrame:
    """`score_quality` by a network."""
    kept = df.select(F.col(id_col).alias("doc_id")) if keep is None else df.select(*keep)
    if network is None:
        return kept.withColumns({names[0]: F.lit(0.5), names[1]: F.lit(int(threshold <= 0.5))})
    shared = df.sparkSession.sparkContext.broadcast(network.p)
    schema = StructType([*kept.schema.fields, StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    arrow = to_arrow_schema(schema)
    held = {}

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held["network"] = ByteNetwork()
            held["network"].p = shared.value
            held["network"].join_pairs()
        for batch in stream:
            scores = held["network"].score(batch.column(0).to_pylist())
            columns = [*batch.columns[1:], pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    content = whole_text(text).cast("binary").alias("__text")
    chosen = [F.col(id_col)] if keep is None else [F.col(c) for c in keep]
    return bounded_batches(df.select(content, *chosen)).mapInArrow(run, schema)


def drop_poor(
    df: DataFrame,
    train: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    label: str = "quality",
    threshold: float = THRESHOLD,
    rows: int = SAMPLE_ROWS,
    steps: int = STEPS,
) -> DataFrame:
    """The rows of `df` that reach the threshold, with all their columns. Without labels nothing is known and all stay.

    Null and empty texts are scored like others; repeated rows are rows of their own; an empty table stays empty.
    """
    network = learn(train, labels, text, id_col, label, rows, steps)
    if network is None:
        return df
    names = ("__score", "__predicted")
    return scored(df, network, text, id_col, threshold, df.columns, names).where(F.col(names[1]) == 1).select(*df.columns)
