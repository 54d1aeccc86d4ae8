"""Removal of word sequences that occur in an earlier document, by suffix automata of reference shards.

kinfold.llm.anchors deals the places where windows of words may repeat to shards of bounded size. Each
shard's places are its reference: a suffix automaton over their words knows for every state the smallest
document that holds it. All places of the shard are then streamed through the automaton; where the
matching statistics reach the window's length, the state tells whether a smaller document holds the window.

The corpus is its own reference and grows with itself, so its automata go to the documents that share
grams with them instead of to all executors. For a reference of bounded size, `against` broadcasts one
automaton and streams every document through it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.anchors import Windows, joined, key_of, keyed, repeats, word_units, word_values
from kinfold.llm.common import real_id, texts_of, utf8


class Automaton:
    """Suffix automaton of sequences of numbers; `low` has the smallest owner among the places of each state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.low = [-1], [0], [None]
        self.last = 0
        self.ends = 0

    def add(self, symbols: list[int], owner) -> None:
        """A sequence, parted from the others by a symbol that occurs nowhere else."""
        self.ends -= 1
        for c in (*symbols, self.ends):
            self._extend(c, owner)

    def _extend(self, c: int, owner) -> None:
        nxt, link, length, low = self.next, self.link, self.length, self.low
        cur, p = len(nxt), self.last
        nxt.append({})
        length.append(length[p] + 1)
        low.append(owner)
        link.append(0)
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nxt)
                nxt.append(nxt[q].copy())
                length.append(length[p] + 1)
                low.append(None)
                link.append(link[q])
                link[q] = link[cur] = copy
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = copy
                    p = link[p]
        self.last = cur

    def finish(self) -> Automaton:
        """Carries the smallest owners from the longer states to the shorter."""
        low, link = self.low, self.link
        for v in np.argsort(-np.array(self.length), kind="stable").tolist():
            p = link[v]
            if p > 0 and (low[p] is None or low[v] < low[p]):
                low[p] = low[v]
        return self

    def owners(self, symbols: list[int], least: int):
        """For each place the smallest owner of the `least` symbols that end there, or None: the matching statistics."""
        nxt, link, length, low = self.next, self.link, self.length, self.low
        v = size = 0
        for c in symbols:
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                size += 1
                while length[link[v]] >= least:
                    v = link[v]
                    size = length[v]
            yield low[v] if size >= least else None


def solve(texts: list[bytes], doc: np.ndarray, lo: np.ndarray, n: np.ndarray, onward: np.ndarray, spec: Windows):
    """The solver for anchors.repeats."""
    shard = Automaton()
    held = [np.frombuffer(t, np.uint64).tolist() for t in texts]
    owner = doc.tolist()
    for symbols, d in zip(held, owner, strict=True):
        shard.add(symbols, d)
    shard.finish()
    goes = set(onward.tolist())
    rows, starts, kept_rows, kept_starts, names = [], [], [], [], []
    skip = spec.length - 1
    for r, (symbols, d, first) in enumerate(zip(held, owner, lo.tolist(), strict=True)):
        for i, low in enumerate(shard.owners(symbols, spec.length)):
            if low is None:
                continue
            if low < d:
                rows.append(r)
                starts.append(first + i - skip)
            elif r in goes:
                kept_rows.append(r)
                kept_starts.append(first + i - skip)
                names.append(hashlib.blake2b(texts[r][8 * (i - skip) : 8 * (i + 1)], digest_size=15).digest() + b"\x01")
    numbers = (np.array(x, np.int64) for x in (rows, starts, kept_rows, kept_starts))
    rows, starts, kept_rows, kept_starts = numbers
    return (rows, starts), (kept_rows, kept_starts), names


def word_windows(length: int) -> Windows:
    return Windows(length, max(1, length // 2), word_units, word_values, within=False, chunk=1 << 21)


def _without(batch: pa.RecordBatch, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """The words of each text that no range holds, joined by one space."""
    data, at = utf8(batch.column("text"))
    starts, ends, counts = words.spans(data, at)
    word_at = np.concatenate(([0], np.cumsum(counts)))
    gone = np.zeros(len(starts) + 1, np.int64)
    hi = np.minimum(hi, counts[row])
    np.add.at(gone, word_at[row] + lo, 1)
    np.add.at(gone, word_at[row] + hi, -1)
    stays = np.cumsum(gone[:-1]) == 0
    raw = data.tobytes()
    kept, removed = [], []
    touched = np.zeros(batch.num_rows, bool)
    touched[row] = True
    for r, (a, b) in enumerate(zip(word_at[:-1].tolist(), word_at[1:].tolist(), strict=True)):
        text = raw[at[r] : at[r + 1]].split()
        if touched[r]:
            left = stays[a:b].tolist()
            text = [w for w, s in zip(text, left, strict=True) if s]
        kept.append(b" ".join(text))
        removed.append(b - a - len(text))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(counts), pa.array(removed, pa.int64())], names=["doc_id", "kept", "n_words", "n_removed"])


KEPT = "doc_id long, kept binary, n_words long, n_removed long"


def cut_out(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, kept (remaining words joined by one space, UTF-8), n_words, n_removed of every row.

    A word goes if a window of `length` words that covers it also starts in a smaller doc_id. Words are runs
    without ASCII white space, unchanged. Null and empty texts have none. A null doc_id is the smallest. Rows of one
    doc_id and different texts are documents one after the other, in the order of a hash of the text; exact repeats of
    a row are one document, and each of them keeps what it keeps. Windows that repeat within one document stay, so
    there are no ties. A text of any length is read whole. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    rows = keyed(texts_of(docs))
    found = repeats(rows, word_windows(length), solve)

    def apply(batches):
        for batch in batches:
            lists = batch.column("runs")
            count = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            lo, n = flat.field("lo").to_numpy(), flat.field("n").to_numpy()
            yield _without(batch, *joined(np.repeat(np.arange(batch.num_rows), count), lo, lo + n - 1 + length))

    return rows.join(found, key_of(rows), "left").mapInArrow(apply, KEPT)


def against(docs: DataFrame, reference: DataFrame, length: int = 50, limit: int = 2_000_000) -> DataFrame:
    """As cut_out, but a word goes if a window over it occurs in `reference` (column text).

    The reference's automaton is broadcast; a reference of more than `limit` words is refused, since a
    larger one would not fit the executors.
    """
    texts, total = [], 0
    for r in reference.select("text").filter("text IS NOT NULL").toLocalIterator():
        texts.append(r["text"])
        total += len(r["text"].split())
        if total > limit:
            raise ValueError(f"the reference has more than {limit} words: union it with the documents and use cut_out")
    units = [word_units(pa.array([t]))[0].tolist() for t in texts]
    sent = docs.sparkSession.sparkContext.broadcast([u for u in units if len(u) >= length])

    def apply(batches):
        shard = Automaton()
        for u in sent.value:
            shard.add(u, 0)
        shard.finish()
        for batch in batches:
            symbols, at = word_units(batch.column("text"))
            row, lo = [], []
            for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                for i, low in enumerate(shard.owners(symbols[a:b].tolist(), length)):
                    if low is not None:
                        row.append(r)
                        lo.append(i - length + 1)
            row, lo = np.array(row, np.int64), np.array(lo, np.int64)
            yield _without(batch, *joined(row, lo, lo + length))

    return texts_of(docs).mapInArrow(apply, KEPT)


def digest(docs: DataFrame, length: int = 50) -> DataFrame:
    return cut_out(docs, length).select(real_id(), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
