"""Text quality by a factorisation machine.

Inputs are hashed words (the first 2**BITS coordinates, each of weight 1 / sqrt(distinct words)) and
one coordinate for the bin of each structure statistic and of the length metadata. Every coordinate
has a weight and RANK factors; pairs interact by the factors' products. The pair sum is taken in
linear time as (square of the sum - sum of the squares) / 2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.common import real_id, slices, texts_of, utf8
from kinfold.llm.toxicity import labelled, letters, sigmoid

BITS, RANK, BINS = 16, 8, 16
#: Labelled rows that are learnt from at the most, those of the smallest hash of doc_id.
TRAIN_ROWS = 8192
STATS = ("bytes", "words", "lines", "word_length", "line_length", "upper", "digits", "symbols", "bars", "stops", "repeated_words", "repeated_lines", "last_stop")
SIZE = (1 << BITS) + len(STATS) * BINS


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bins of a share between 0 and 1: 0, then ever wider steps."""
    x = part / np.maximum(whole, 1)
    return np.where(part <= 0, 0, np.clip(np.floor(np.log2(np.maximum(x, 1e-9)) + 10) + 2, 1, BINS - 1)).astype(np.int64)


def _length(x: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(np.log2(np.maximum(x, 0) + 1)), 0, BINS - 1).astype(np.int64)


def _repeats(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of each text's values repeat an earlier one of it."""
    at = np.concatenate(([0], np.cumsum(counts))).tolist()
    return np.array([b - a - len(np.unique(values[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)


def features(column: pa.Array):
    """Ranges of rows with coordinates and values of each text: (first row, last row, coordinates, values, offsets)."""
    data, at = utf8(column)
    for i, j in slices(at, 1 << 20):
        part, own = data[at[i] : at[j]], at[i : j + 1] - at[i]
        size = np.diff(own)

        def total(mark):
            sums = np.concatenate(([0], np.cumsum(mark)))
            return sums[own[1:]] - sums[own[:-1]]

        low = words.lowered(part)
        starts, ends, counts = words.spans(low, own, letters(low))
        w = words.hashes(low, starts, ends)
        line_starts, line_ends, lines = words.spans(part, own, part != 10)
        line = words.hashes(part, line_starts, line_ends)
        letter = total(letters(part))
        last = np.where(size > 0, part[np.maximum(own[1:] - 1, 0)] if len(part) else 0, 0)
        bins = np.stack([
            _length(size), _length(counts), _length(lines), _length(letter * 4 // np.maximum(counts, 1)), _length(size // np.maximum(lines, 1)),
            _share(total((part >= 65) & (part <= 90)), size), _share(total((part >= 48) & (part <= 57)), size),
            _share(total((part >= 33) & (part <= 43)), size), _share(total(part == 124), size), _share(total((part == 46) | (part == 44)), counts),
            _share(_repeats(w, counts), counts), _share(_repeats(line, lines), lines), np.isin(last, (33, 46, 63)).astype(np.int64),
        ])
        stats = (1 << BITS) + np.arange(len(STATS))[:, None] * BINS + bins
        idx = (w >> np.uint64(64 - BITS)).astype(np.int64)
        word_at = np.concatenate(([0], np.cumsum(counts))).tolist()
        coords, values = [], []
        for r, (a, b) in enumerate(zip(word_at[:-1], word_at[1:], strict=True)):
            own_words = np.unique(idx[a:b])
            coords += [own_words, stats[:, r]]
            values += [np.full(len(own_words), 1 / max(1, len(own_words)) ** 0.5), np.ones(len(STATS))]
        sizes = [len(c) for c in coords]
        yield i, j, np.concatenate(coords).astype(np.int32), np.concatenate(values).astype(np.float32), np.concatenate(([0], np.cumsum(sizes)[1::2]))


class Machine:
    """Weights, factors and offset, learnt by gradient steps with a rate for each number (AdaGrad)."""

    def __init__(self, rate: float = 0.1, decay: float = 1e-5, seed: int = 1):
        self.rate, self.decay = rate, decay
        self.w, self.v, self.w0 = np.zeros(SIZE), np.random.default_rng(seed).normal(0, 0.05, (SIZE, RANK)), 0.0
        self.gw, self.gv, self.g0 = np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6), 1e-6

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        vx = self.v[at] * x[:, None]
        s = vx.sum(0)
        return self.w0 + float(self.w[at] @ x) + 0.5 * float((s * s).sum() - (vx * vx).sum()), s, vx

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        y, s, vx = self.raw(at, x)
        g = float(sigmoid(y)) - label
        dw = g * x + self.decay * self.w[at]
        dv = g * x[:, None] * (s - vx) + self.decay * self.v[at]
        self.gw[at] += dw * dw
        self.gv[at] += dv * dv
        self.g0 += g * g
        self.w[at] -= self.rate * dw / np.sqrt(self.gw[at])
        self.v[at] -= self.rate * dv / np.sqrt(self.gv[at])
        self.w0 -= self.rate * g / self.g0**0.5


def train(docs: DataFrame, labels: DataFrame, learn_from=None, limit: int = TRAIN_ROWS, passes: int = 3) -> tuple[float, np.ndarray, np.ndarray]:
    """Offset, weights and factors, fitted on the driver to a bounded sample of labelled rows."""

    def encode(batches):
        for batch in batches:
            for i, j, at, x, ends in features(batch.column("text")):
                cols = [pa.array([a[ends[r] : ends[r + 1]].tobytes() for r in range(j - i)], pa.binary()) for a in (at, x)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("label").slice(i, j - i), *cols], names=["doc_id", "label", "at", "x"])

    found = labelled(docs, labels, "quality", learn_from, limit).mapInArrow(encode, "doc_id long, label int, at binary, x binary").toArrow()
    label = found.column("label").to_numpy()
    model = Machine()
    if len(set(label.tolist())) < 2:
        return float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1))), np.zeros(SIZE, np.float32), np.zeros((SIZE, RANK), np.float32)
    order = np.argsort(words.mix(found.column("doc_id").to_numpy().view(np.uint64) + np.uint64(3)), kind="stable")
    at, x = found.column("at"), found.column("x")
    for _ in range(passes):
        for r in order.tolist():
            model.learn(np.frombuffer(at[r].as_py(), np.int32), np.frombuffer(x[r].as_py(), np.float32).astype(np.float64), int(label[r]))
    return model.w0, model.w.astype(np.float32), model.v.astype(np.float32)


def score(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id and score of every row. The broadcast model holds SIZE * (RANK + 1) numbers, whatever the input's size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        w0, w, v = sent.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, j, at, x, ends in features(batch.column("text")):
                heads = ends[:-1]  # never empty: each text has its statistics
                vx = v[at] * x[:, None]
                s = np.add.reduceat(vx, heads, axis=0).astype(np.float64)
                squares = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), heads)
                out[i:j] = sigmoid(w0 + np.add.reduceat(w[at] * x, heads) + 0.5 * ((s * s).sum(1) - squares))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(apply, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Rows whose crc32(doc_id as text) modulo `mod` is `held` are never learnt from. Null texts score as
    empty ones, by their statistics; repeated rows score alike, and an id that is repeated is learnt from once; with
    labels of one class or none, every text gets that class's shrunken share. A null doc_id hashes as -2**63. Texts of
    any length are read whole. A score of exactly 0.5 predicts 1; rows are learnt in the order of a hash of the id, so
    there are no ties. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    bucket = F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod
    out = score(texts_of(docs), train(docs, labels, bucket != held))
    return out.select(real_id(), (bucket == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
