"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of letters and digits in lower case (A-Z only). Features are the distinct single
words and their beginnings of BEGINNINGS bytes (inflected languages vary the ends), hashed to 2**BITS
coordinates, and pairs of neighbours and pairs with one word between, hashed to as many others and of
value PAIR instead of 1. The learner keeps a rate for each coordinate and sets small ones to zero
(L1), so that the weights that are broadcast stay compact: 2 * 2**BITS + 1 numbers at the most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.common import NO_ID, lean, real_id, released, slices, texts_of, utf8

BITS = 18
BEGINNINGS = (3, 4, 5)
PAIR = 0.15
SIZE = (2 << BITS) + 1
#: Labelled rows that are learnt from at the most, those of the smallest hash of doc_id.
TRAIN_ROWS = 8192


def letters(data: np.ndarray) -> np.ndarray:
    """Marks ASCII letters and digits and all bytes of other characters."""
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table[data]


def features(column: pa.Array):
    """Ranges of rows with the distinct coordinates of each text: (first row, last row, flat, offsets)."""
    data, at = utf8(column)
    shift = np.uint64(64 - BITS)
    for i, j in slices(at, 1 << 20):
        part, own = words.lowered(data[at[i] : at[j]]), at[i : j + 1] - at[i]
        starts, ends, counts = words.spans(part, own, letters(part))
        w = words.hashes(part, starts, ends)
        heads = [words.hashes(part, starts, np.minimum(starts + n, ends)) + np.uint64(n << 56) for n in BEGINNINGS]
        pair = words.mix(w[:-1] * np.uint64(3) + w[1:])
        skip = words.mix(w[:-2] * np.uint64(5) + w[2:] + np.uint64(1))
        one, pair, skip, *heads = ((x >> shift).astype(np.int32) for x in (w, pair, skip, *(words.mix(h) for h in heads)))
        pair, skip = pair + (1 << BITS), skip + (1 << BITS)
        word_at = np.concatenate(([0], np.cumsum(counts)))
        parts = []
        for a, b in zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
            parts.append(np.unique(np.concatenate((one[a:b], pair[a : max(a, b - 1)], skip[a : max(a, b - 2)], *(h[a:b] for h in heads)))))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        yield i, j, flat, np.concatenate(([0], np.cumsum([len(p) for p in parts])))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """Per-coordinate rates alpha / (beta + sqrt(sum of squared gradients)), L1 and L2 in the proximal step."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 3.0, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SIZE), np.zeros(SIZE)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, SIZE - 1)  # the last coordinate is in every row
        x = np.where(at < 1 << BITS, 1.0, PAIR)
        x[-1] = 1.0
        w = self.weights(at)
        g = (float(sigmoid(w @ x)) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def labelled(docs: DataFrame, labels: DataFrame, column: str, learn_from, limit: int) -> DataFrame:
    """doc_id, text, label of at most `limit` labelled rows that learn_from accepts; null and other labels than 0 and 1 don't count."""
    rows = labels.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col(column).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isin(0, 1) & (F.lit(True) if learn_from is None else learn_from)).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = texts_of(docs).join(F.broadcast(rows), "doc_id")  # an id that is repeated counts once, by one of its texts
    return found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("r")).select("doc_id", "r.text", "r.label")


def train(docs: DataFrame, labels: DataFrame, learn_from=None, limit: int = TRAIN_ROWS, passes: int = 3) -> np.ndarray:
    """SIZE weights, those of pairs times PAIR, the last one the offset."""

    def encode(batches):
        for batch in batches:
            for i, j, flat, at in features(batch.column("text")):
                rows = [flat[at[r] : at[r + 1]].tobytes() for r in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), batch.column("label").slice(i, j - i), pa.array(rows, pa.binary())], names=["doc_id", "label", "at"])

    found = labelled(docs, labels, "toxic", learn_from, limit).mapInArrow(encode, "doc_id long, label int, at binary").toArrow()
    order = np.argsort(words.mix(found.column("doc_id").to_numpy().view(np.uint64) + np.uint64(7)), kind="stable")
    label = found.column("label").to_numpy()
    at = found.column("at")
    model = Ftrl()
    if len(set(label.tolist())) < 2:  # nothing to tell apart: the shrunken share of toxic rows
        out = np.zeros(SIZE, np.float32)
        out[-1] = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
        return out
    for _ in range(passes):
        for r in order.tolist():
            model.learn(np.frombuffer(at[r].as_py(), np.int32), int(label[r]))
    out = model.weights(np.arange(SIZE)).astype(np.float32)
    out[1 << BITS : -1] *= PAIR
    return out


def score(docs: DataFrame, weights: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default doc_id) of every row, with score; a null or empty text gets the offset's score."""
    kept = np.flatnonzero(weights)
    sent = docs.sparkSession.sparkContext.broadcast((kept.astype(np.int32), weights[kept]))
    keep = keep or ["doc_id"]
    lean(docs.sparkSession)

    def apply(batches):
        at, value = sent.value
        full = np.zeros(SIZE)
        full[at] = value
        for batch in batches:
            out = np.full(batch.num_rows, sigmoid(full[-1]))
            for i, j, flat, ends in features(batch.column("text")):
                sums = np.concatenate(([0.0], np.cumsum(full[flat])))
                out[i:j] = sigmoid(sums[ends[1:]] - sums[ends[:-1]] + full[-1])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(out)], names=[*keep, "score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(released(apply), schema + ", score double")


def toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Rows whose crc32(doc_id as text) modulo `mod` is `held` are never learnt from. Repeated rows are
    scored alike, and an id that is repeated is learnt from once; labels without a text, null labels and an empty
    labels table are harmless (with one class only, every text gets its shrunken share). A null doc_id hashes as
    -2**63. Null and empty texts get the offset's score; texts of any length are read whole. A score of exactly 0.5
    predicts 1; rows are learnt in the order of a hash of the id, so there are no ties. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    weights = train(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod != held)
    out = score(texts_of(docs), weights)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == held
    return out.select(real_id(), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
