"""SentencePiece encoding and decoding of merge-type vocabularies by a score-ordered agenda.

Texts are cut where no piece of the vocabulary can reach across (before a run of spaces, around line
ends), each distinct segment of a batch is encoded once by the agenda of its adjacent symbol pairs
(kinfold.llm.bpe), and every newly met segment is checked against the sentencepiece library; a
difference raises an error. Texts are decoded by the library itself, in Arrow batches.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm import words
from kinfold.llm.bpe import Pairs, spread
from kinfold.llm.common import Memo, real_id, slices, texts_of, utf8

SPACE = "▁"
#: Bytes of segments that a worker keeps with their encodings, twice at the most.
ROOM = 80_000_000
_MODELS: dict = {}


class Model:
    """The vocabulary as a table of symbol pairs; symbols are ids, or CHARS + code point for characters without a piece."""

    CHARS = 1 << 20

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.piece = {sp.id_to_piece(i): i for i in normal}
        self.end = sp.eos_id()
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        rows = []
        for text, i in self.piece.items():
            for k in range(1, len(text)):
                left, right = self.symbol(text[:k]), self.symbol(text[k:])
                if left is not None and right is not None:
                    rows.append((left, right, -sp.get_score(i), i))
        left, right, cost, merged = (np.array(x) for x in zip(*rows, strict=True))
        self.pairs = Pairs(left, right, np.unique(cost, return_inverse=True)[1], merged)
        self.single = np.arange(self.CHARS, self.CHARS + 0x110000, dtype=np.int32)
        for text, i in self.piece.items():
            if len(text) == 1:
                self.single[ord(text)] = i
        self.reach = any(SPACE in p.strip(SPACE) or (p[:1] != SPACE and SPACE in p) or "\n" in p for p in self.piece)
        self.memo = Memo(ROOM)
        self.decimal = [str(i) for i in range(n)]

    def symbol(self, text: str) -> int | None:
        if text in self.piece:
            return self.piece[text]
        return self.CHARS + ord(text) if len(text) == 1 else None

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, in which spaces are already marks, end to end, and how many each has."""
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        flat, counts = self.pairs.merge(self.single[chars], np.fromiter(map(len, segments), np.int64, len(segments)))
        if not len(flat) or flat.max() < self.CHARS:
            return flat, counts
        spelled = [(s,) if s < self.CHARS else tuple(self.bytes[b] for b in chr(s - self.CHARS).encode()) for s in flat.tolist()]
        sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        at = np.concatenate(([0], np.cumsum(counts)))
        size_at = np.concatenate(([0], np.cumsum(sizes)))
        return np.fromiter(chain.from_iterable(spelled), np.int32, int(size_at[-1])), size_at[at[1:]] - size_at[at[:-1]]

    def encoded(self, segments: list[bytes]) -> list[tuple[bytes, str]]:
        """For each segment its ids as 32-bit numbers and as decimals joined by spaces, checked against the library."""
        texts = [s.decode("utf-8", "replace").replace(" ", SPACE) for s in segments]
        flat, counts = self.encode(texts)
        self.check(texts, flat, counts)
        raw, spelled = flat.astype(np.int32).tobytes(), list(map(self.decimal.__getitem__, flat.tolist()))
        stop = np.cumsum(counts).tolist()
        return [(raw[4 * a : 4 * b], " ".join(spelled[a:b])) for a, b in zip([0, *stop[:-1]], stop, strict=True)]

    def check(self, segments: list[str], flat: np.ndarray, counts: np.ndarray, group: int = 64) -> None:
        """Compares with the library, which encodes texts of `group` segments parted by line ends."""
        line = self.bytes[10]
        first = self.piece[SPACE]  # the library puts a mark before each text
        at = np.concatenate(([0], np.cumsum(counts)))
        texts = ["\n" + "\n".join(segments[i : i + group]).replace(SPACE, " ") for i in range(0, len(segments), group)]
        for g, ids in enumerate(self.library.encode(texts, num_threads=1)):
            i, j = g * group, min(len(segments), (g + 1) * group)
            own = np.insert(flat[at[i] : at[j]], at[i:j] - at[i], line)
            if len(ids) != len(own) + 1 or ids[0] != first or not np.array_equal(ids[1:], own):
                raise ValueError(f"the library and the agenda differ on one of {segments[i:j]!r}")


def model_of(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _segmented(model: Model, texts: list[bytes], whole: list[bool]):
    """Starts, ends and owners of the segments of texts that all begin with a space."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    if n and not model.reach:
        space, line = data == 32, data == 10
        cut = np.zeros(n, bool)
        cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
        for r in np.flatnonzero(whole).tolist():
            cut[at[r] : at[r + 1]] = False
        edge[:-1] |= cut
    starts = np.flatnonzero(edge[:-1])
    ends = np.append(starts[1:], n) if len(starts) else starts
    return data, starts, ends, np.searchsorted(starts, at)


def encoded(model: Model, texts: list[bytes]):
    """For each text its ids (without the end) and their decimals joined by spaces."""
    marked = SPACE.encode()
    led = [b" " + t if t else t for t in texts]
    data, starts, ends, own = _segmented(model, led, [marked in t for t in texts])
    if not len(starts):
        yield from (([], b"") for _ in texts)
        return
    _, at, back = np.unique(words.hashes(data, starts, ends), return_index=True, return_inverse=True)
    raw = data.tobytes()
    distinct = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
    packed, spelled = zip(*model.memo.find(distinct, model.encoded), strict=True)
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
    flat = np.frombuffer(b"".join(packed), np.int32)
    ids = flat[spread((np.cumsum(sizes) - sizes)[back], sizes[back])].tolist()
    stop = np.concatenate(([0], np.cumsum(sizes[back])))[own].tolist()
    words_of = list(map(spelled.__getitem__, back.tolist()))
    for r, (a, b) in enumerate(zip(own[:-1].tolist(), own[1:].tolist(), strict=True)):
        yield ids[stop[r] : stop[r + 1]], " ".join(words_of[a:b]).encode()


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: all ids with the end id, and their decoding.

    Null is the empty text, whose only id is the end. Repeated rows give equal rows; a null doc_id stays null; texts of any
    length are read whole, 4 MB of texts at a time; of pairs of equal score the leftmost merges first. An empty table gives
    an empty result; other columns are ignored, whatever their names. `path` names the vocabulary file, which every
    executor can read.
    """

    def apply(batches):
        model = model_of(path)
        for batch in batches:
            column = pc.cast(batch.column("text"), pa.binary()).fill_null(b"")
            _, at = utf8(column)
            for i, j in slices(at, 1 << 22):
                counts, names, back = [], [], []
                for ids, decimals in encoded(model, column.slice(i, j - i).to_pylist()):
                    ids.append(model.end)
                    counts.append(len(ids))
                    names.append(hashlib.sha256((decimals + b" " if decimals else b"") + b"%d" % model.end).hexdigest())
                    back.append(hashlib.sha256(model.library.decode(ids).encode("utf-8", "replace")).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(counts, pa.int64()), pa.array(names, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    out = texts_of(docs).mapInArrow(apply, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.select(real_id(), *[F.col(c) for c in out.columns[1:]])
