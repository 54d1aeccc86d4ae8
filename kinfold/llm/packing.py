"""Best-fit packing by a configuration linear program over the length histogram.

Texts are tokenised, an end id is added, and only what is longer than a sequence is cut. The lengths'
histogram (at most `capacity` numbers, whatever the input) goes to the driver. There a configuration
is a multiset of lengths that fits a sequence; the linear program "cover each length's count with as
few configurations as possible" is solved in whole numbers by multiplicative weights: each round prices
lengths by their weights, reads the dearest configurations off a knapsack dynamic program, uses them
and lowers the weights of what they cover, until the program has placed all but a hundredth of the
tokens. Best fit places the rest into the gaps that are left and then into new sequences. Pieces find
their places by their rank among those of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm import words
from kinfold.llm.bpe import Pairs
from kinfold.llm.common import Memo, cut, real_id, slices, texts_of, utf8

#: Bytes of words that a worker keeps with their ids, twice at the most.
ROOM = 30_000_000
#: First weights are sizes to this power: above 1 fills rooms by longer sizes first and keeps short ones for later gaps.
POWER = 1.3
#: More ranks than pieces of one length: a length and a rank are one number below 2**63.
RANKS = 1 << 48
_TOKENIZERS: dict = {}


class WordTokenizer:
    """A word-end BPE tokenizer file of the tokenizers library, encoding each distinct word once.

    Its words never hold white space, so a text's ids are those of its parts between ASCII white space.
    Plain parts are merged by kinfold.llm.bpe; parts that hold anything else than letters, digits and
    common marks go to the library.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.pairs = Pairs([vocab[a] for a, _ in merges], [vocab[b] for _, b in merges], np.arange(len(merges)), [vocab[a + b] for a, b in merges])
        end = spec["model"]["end_of_word_suffix"]
        printed = byte_characters()
        self.inner = np.array([vocab[printed[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[printed[b] + end] for b in range(256)], np.int32)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern + "|\n")
        self.odd = regex.compile(r"[^\n]*[^\na-zA-Z0-9À-ÖØ-öø-įı-ž!-;=?-~«»¿¡][^\n]*")
        self.memo = Memo(ROOM)

    def encode(self, parts: list[str]) -> list[bytes]:
        """The ids of each part (which holds no line end), as 32-bit little-endian numbers."""
        odd = {*self.odd.findall("\n".join(parts))}
        rest = [p for p in parts if p not in odd] if odd else parts
        out = self._merged(rest)
        if not odd:
            return out
        other = dict(zip(odd, (np.array(e.ids, np.uint32).tobytes() for e in self.library.encode_batch([*odd], add_special_tokens=False)), strict=True))
        plain = iter(out)
        return [other[p] if p in odd else next(plain) for p in parts]

    def _merged(self, parts: list[str]) -> list[bytes]:
        if not parts:
            return []
        tokens = self.pattern.findall("\n".join(parts).lower())
        coded = list(map(str.encode, tokens))
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        start = np.cumsum(size) - size
        line = (raw[start] == 10) if len(start) else np.zeros(0, bool)
        owner = np.cumsum(line)[~line]
        symbols = self.inner[raw]
        last = start + size - 1
        symbols[last] = self.final[raw[last]]
        flat, counts = self.pairs.merge(symbols[np.repeat(~line, size)], size[~line])
        total = np.bincount(owner, counts, len(parts)).astype(np.int64)
        data, stop = flat.astype("<u4").tobytes(), (4 * np.cumsum(total)).tolist()
        return [data[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)]

    def texts(self, data: np.ndarray, at: np.ndarray):
        """The ids of each text, as 32-bit little-endian numbers."""
        starts, ends, counts = words.spans(data, at)
        if not len(starts):
            yield from (b"" for _ in counts)
            return
        _, first, back = np.unique(words.hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        distinct = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        own = [v[0] for v in self.memo.find(distinct, lambda new: [(ids,) for ids in self.encode([w.decode("utf-8", "replace") for w in new])])]
        ids = list(map(own.__getitem__, back.tolist()))
        begin = 0
        for end in np.cumsum(counts).tolist():
            yield b"".join(ids[begin:end])
            begin = end


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies print for each byte: itself if visible, else the next from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def tokenizer_of(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""

    def apply(batches):
        tokens = tokenizer_of(path)
        tail = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for i, j in slices(at, 1 << 22):
                ids, cols = batch.column("doc_id").slice(i, j - i).to_pylist(), [[], [], [], [], []]
                for doc, own in zip(ids, tokens.texts(data[at[i] : at[j]], at[i : j + 1] - at[i]), strict=True):
                    own += tail
                    for k, s in enumerate(range(0, len(own), step)):
                        part = own[s : s + step]
                        for c, x in zip(cols, (doc, k, s // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(apply, "doc_id long, piece int, start long, length long, ids_crc32 long")


def priced(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room the highest price of what fits in it, and the index of a size to put there (-1: leave one place empty)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, np.int64)
    for room in range(int(sizes[0]), capacity + 1):  # sizes ascend
        fit = int(np.searchsorted(sizes, room, "right"))
        value = best[room - sizes[:fit]] + prices[:fit]
        k = int(value.argmax())
        if value[k] > best[room - 1]:
            best[room], choice[room] = value[k], k
        else:
            best[room] = best[room - 1]
    return best, choice


def dearest(k: int, table: tuple, prices: np.ndarray, sizes: np.ndarray, supply: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of the highest price that holds size k, as index of size -> count.

    It is read off the table. Where that would use more of a size than there is in supply, the dearest size that is left goes there.
    """
    best, choice = table
    found, room, least = {k: 1}, capacity - int(sizes[k]), int(sizes[0])
    while room >= least:
        c = int(choice[room])
        if c < 0:
            room -= 1
            continue
        if found.get(c, 0) >= supply[c]:
            fit = int(np.searchsorted(sizes, room, "right"))
            open_ = supply[:fit] > 0
            for j, n in found.items():
                if j < fit and n >= supply[j]:
                    open_[j] = False
            ids = np.flatnonzero(open_)
            if not len(ids):
                break
            c = int(ids[(best[room - sizes[ids]] + prices[ids]).argmax()])
        found[c] = found.get(c, 0) + 1
        room -= int(sizes[c])
    return found


def deal(sizes: np.ndarray, need: np.ndarray, capacity: int, tolerance: float, step: float, fresh: float = 0.03) -> tuple[dict[tuple, int], np.ndarray]:
    """Configurations -> how often, and what is left of each size: at most `tolerance` of the tokens.

    Longest first, every size is dealt in whole numbers by the dearest configurations that hold it. Whenever a share
    of `fresh` of what was left is dealt, the weights of the sizes fall by how far they are covered, and rooms are priced
    anew. A configuration uses up a size, so that the work is bounded by the sizes and not by the counts.
    """
    used: dict[tuple, int] = {}
    remain, enough = need.copy(), tolerance * int(sizes @ need)
    while (tokens := int(sizes @ remain)) > enough:
        live = np.flatnonzero(remain)
        own, supply = sizes[live], remain[live]
        prices = (own / capacity) ** POWER * np.exp(-step * (1 - supply / need[live]))
        table = priced(prices, own, capacity)
        for k in reversed(range(len(live))):
            while supply[k]:
                config = dearest(k, table, prices, own, supply, capacity)
                at, count = np.array(list(config)), np.array(list(config.values()))
                times = int((supply[at] // count).min())
                supply[at] -= times * count
                key = tuple(sorted((int(live[j]), c) for j, c in config.items()))
                used[key] = used.get(key, 0) + times
            if own @ supply <= max(enough, (1 - fresh) * tokens):
                break
        remain[live] = supply
    return used, remain


def least_sequences(histogram: dict[int, int], capacity: int) -> int:
    """A bound that no packing is under: sequences for all tokens, and one for each length above half a sequence.

    These are the program's dual values for prices in proportion to the sizes and for a price of one on long pieces.
    """
    return max(-(-sum(s * n for s, n in histogram.items()) // capacity), sum(n for s, n in histogram.items() if 2 * s > capacity))


def solve(histogram: dict[int, int], capacity: int, tolerances: tuple[float, ...] = (0.01, 0.3)) -> list[tuple[list[int], int]]:
    """Configurations (lengths, how often) that hold each length exactly as often as the histogram says.

    The program places all tokens but a share of a tolerance, whatever the number of lengths, and best fit the rest. Of the
    tolerances, and of best fit for all, the one of fewest sequences is taken: at least `least_sequences`, at most best fit's.
    """
    enough, best = least_sequences(histogram, capacity), None
    for tolerance in (*tolerances, 1.0):
        found = placed(histogram, capacity, tolerance)
        if best is None or sum(n for _, n in found) < sum(n for _, n in best):
            best = found
        if sum(n for _, n in best) <= enough:
            break
    return best


def placed(histogram: dict[int, int], capacity: int, tolerance: float, step: float = 0.5) -> list[tuple[list[int], int]]:
    """Configurations of the program for all tokens but a share of `tolerance`, filled up by best fit."""
    out: list[tuple[list[int], int]] = []
    left = {size: n for size, n in histogram.items() if n > 0}
    if capacity in left:
        out.append(([capacity], left.pop(capacity)))
    if not left:
        return out
    sizes = np.array(sorted(left), np.int64)
    used, remain = deal(sizes, np.array([left[s] for s in sizes.tolist()], np.int64), capacity, tolerance, step)
    open_bins: dict[int, list] = {}  # gap -> [lengths, times]
    for key, times in used.items():
        lengths = [int(sizes[k]) for k, c in key for _ in range(c)]
        open_bins.setdefault(capacity - sum(lengths), []).append([lengths, times])
    return out + best_fit({int(s): int(n) for s, n in zip(sizes, remain, strict=True) if n}, open_bins, capacity)


def best_fit(rest: dict[int, int], open_bins: dict[int, list], capacity: int) -> list[tuple[list[int], int]]:
    """Places the rest, longest first, each into the fullest sequence that has room, many equal ones at once."""
    gaps = sorted(open_bins)
    for size in sorted(rest, reverse=True):
        n = rest[size]
        while n:
            k = bisect_left(gaps, size)
            if k < len(gaps):
                gap = gaps[k]
                lengths, times = open_bins[gap].pop()
                if not open_bins[gap]:
                    del open_bins[gap]
                    gaps.pop(k)
                each = 1 if times > 1 and times * (gap // size) > n else min(gap // size, max(1, n // times))
                take = min(times, n // each)
                if times > take:
                    _open(open_bins, gaps, gap, [lengths, times - take])
                _open(open_bins, gaps, gap - each * size, [lengths + [size] * each, take])
                n -= take * each
            else:
                each = min(capacity // size, n)
                take = n // each
                _open(open_bins, gaps, capacity - each * size, [[size] * each, take])
                n -= take * each
    return [(lengths, times) for held in open_bins.values() for lengths, times in held]


def _open(open_bins: dict[int, list], gaps: list[int], gap: int, held: list) -> None:
    if gap not in open_bins:
        open_bins[gap] = []
        insort(gaps, gap)
    open_bins[gap].append(held)


def places(configs: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, offset): the slots of each length in order of rank."""
    out, rank, sequence = [], {}, 0
    for lengths, times in configs:
        offset = 0
        for size in lengths:
            at = rank.get(size, 0)
            out.append((size, at, at + times, sequence, offset))
            rank[size] = at + times
            offset += size
        sequence += times
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Null and empty texts are the end id alone. Repeated rows are packed each; a null doc_id stays null. Pieces of one
    length are ranked in parts by a hash, so that a length that many have doesn't meet in one task; ties among them (equal
    ids, pieces and tokens) are interchangeable. Texts of any length are read whole and cut into pieces only. An empty
    table gives an empty result; columns other than doc_id and text are ignored, whatever their names.

    The broadcast slots are those of the solution: five numbers for each place of each configuration. Configurations use up
    a length each, within rounds that each deal a fixed share of what is left, so their number is bounded by the lengths
    (at most `capacity`) and not by the texts.
    """
    spark = docs.sparkSession
    rows = cut(pieces(texts_of(docs), path, end_id, capacity))
    parts = max(16, rows.count() // 50_000)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(sorted(places(solve(histogram, capacity))) or [(0, 0, 0, 0, 0)], np.int64)  # by length and rank
    sent = spark.sparkContext.broadcast((slots[:, 0] * RANKS + slots[:, 1], slots[:, 1], slots[:, 3], slots[:, 4]))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")))
    ranked = ranked.join(F.broadcast(bases) if len(histogram) * parts <= 200_000 else bases, ["length", "part"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*columns, (F.col("r") - 1 + F.col("base")).alias("rank"))

    def place(batches):
        keys, lo, first, offset = sent.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            slot = np.searchsorted(keys, batch.column("length").to_numpy() * RANKS + rank, "right") - 1
            found = [pa.array(first[slot] + rank - lo[slot]), pa.array(offset[slot])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *found], names=[*columns, "sequence_id", "offset"])

    out = ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.select(real_id(), *out.columns[1:])
