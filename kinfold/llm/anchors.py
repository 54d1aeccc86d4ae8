"""Finding windows of units (bytes or words) that repeat, by anchors that equal windows share.

Every window of `length` units picks the gram of `gram` units inside it that has the smallest hash,
the leftmost of equals: equal windows pick equal grams at equal places. Windows in a row that pick one
gram form a context, which is named by the gram's hash and by a hash of all its units.

1. Contexts are made where the texts are read; equal ones of a partition are settled there.
2. A shuffle by gram settles equal contexts: all but the earliest repeat it. Grams of one context are done.
3. Of grams with several different contexts, each context's earliest occurrence is read from its text
   and dealt to a shard by gram, at most SHARD contexts to a shard; a solver compares all windows of a shard.
4. Windows of grams that needed several shards are merged across shards by binary search in sorted runs.

Repeats are runs of window starts: doc_id, side, lo (first start), n.

A document is a doc_id and a side: rows that repeat an id with another text are documents of their own, in the
order of side, a hash of the text (0 where no id repeats). Exact repeats of a row are one document and keep what it keeps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm import words
from kinfold.llm.common import cut, free, partitions, released, slices, utf8
from kinfold.llm.minhash_join import _groups

#: Contexts of one gram that one shard holds.
SHARD = 1024
#: Contexts that a partition settles among themselves at a time.
HELD = 500_000
#: Units of contexts that a solver gets at a time (whole shards).
SOLVED = 1 << 19


@dataclass(frozen=True)
class Windows:
    length: int
    gram: int
    #: a text column's units, end to end, and the n + 1 offsets of the texts
    units: Callable
    #: 64-bit values of units
    values: Callable
    #: earlier windows of the same document count as well
    within: bool
    chunk: int = 1 << 19

    @property
    def reach(self) -> int:
        return self.length - self.gram + 1


_TABLE = np.random.default_rng(99).integers(1, 2**63, 256, dtype=np.uint64)


def byte_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(column)


def byte_values(units: np.ndarray) -> np.ndarray:
    return _TABLE[units]


def word_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+."""
    data, at = utf8(column)
    starts, ends, counts = words.spans(data, at)
    return words.hashes(data, starts, ends), np.concatenate(([0], np.cumsum(counts)))


def word_values(units: np.ndarray) -> np.ndarray:
    return units


_INVERSE = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        steps = np.full(max(n, 2 * len(_INVERSE)), np.uint64(pow(int(words._BASE), -1, 1 << 64)), np.uint64)
        steps[0] = 1
        _INVERSE = np.multiply.accumulate(steps)
    return _INVERSE[:n]


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k values in a row, by doubling."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, size, part = int(words._BASE), 1, values
    out, done = None, 0
    while True:
        if k & size:
            head = part[done : done + n]
            out = head.copy() if out is None else out * np.uint64(pow(power, 1, 1 << 64)) + head
            done += size
        size *= 2
        if size > k:
            return words.mix(out)
        part = part[: len(part) - size // 2] * np.uint64(power) + part[size // 2 :]
        power = power * power % (1 << 64)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with `side`, which tells rows of one doc_id and different texts apart; without it where no id repeats."""
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return docs if again.isEmpty() else docs.withColumn("side", F.xxhash64("text"))


def key_of(docs: DataFrame) -> list[str]:
    return [c for c in ("doc_id", "side") if c in docs.columns]


def _sides(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("side").to_numpy() if "side" in batch.schema.names else np.zeros(batch.num_rows, np.int64)


def contexts(units: np.ndarray, at: np.ndarray, spec: Windows):
    """gram hash, context hash, row, first window start in the row, windows: of every context of the texts."""
    n = len(units)
    empty = np.zeros(0, np.int64)
    if n < spec.length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    values = spec.values(units)
    gram = grams(values, spec.gram)
    bits = np.uint64(max(1, int(n).bit_length()))
    key = ((gram >> bits) << bits) | np.arange(len(gram), dtype=np.uint64)
    size, least = 1, key
    while 2 * size <= spec.reach:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < spec.reach:
        rest = spec.reach - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    per_row = np.maximum(np.diff(at) - spec.length + 1, 0)
    start = np.arange(int(per_row.sum())) + np.repeat(at[:-1] - (np.cumsum(per_row) - per_row), per_row)
    row = np.repeat(np.arange(len(per_row)), per_row)
    if not len(start):
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    pick = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    lo, row, pick = start[first], row[first], pick[first]
    hi = lo + count - 1 + spec.length
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * words.powers(n), out=sums[1:])
    whole = (sums[hi] - sums[lo]) * _inverse_powers(n)[lo]
    name = words.mix(whole + words.mix(((hi - lo).astype(np.uint64) << np.uint64(32)) + (pick - lo).astype(np.uint64)))
    return gram[pick], name, row, lo - at[:-1][row], count


def _pack(lo: np.ndarray, count: np.ndarray, flag: int) -> np.ndarray:
    return (lo << 21) | (count << 1) | flag


def _settled(parts: list[tuple], within: bool) -> pa.RecordBatch:
    """Of equal contexts the earliest (of its document all, unless `within`) go on; the others are known to repeat it."""
    g, c, doc, side, lo, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((lo, side, doc, g ^ words.mix(c)))
    g, c, doc, side, lo, n = (x[order] for x in (g, c, doc, side, lo, n))
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    repeat = (doc != doc[head]) | (side != side[head]) | (within & (lo != lo[head]))
    g = np.where(repeat, words.mix(doc.view(np.uint64) + lo.astype(np.uint64)), g)  # known repeats are spread evenly
    order = np.lexsort((lo, side, doc))  # rows in the order of the texts take less room in the shuffle
    g, c, doc, side, lo, n, repeat = (x[order] for x in (g, c, doc, side, lo, n, repeat))
    return pa.RecordBatch.from_arrays(
        [pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(side), pa.array(np.where(repeat, _pack(lo, n, 1), _pack(lo, n, 0)))],
        names=["g", "c", "doc_id", "side", "packed"],
    )


def _read(docs: DataFrame, spec: Windows) -> DataFrame:
    def make(batches):
        held, count = [], 0
        for batch in batches:
            column, ids, sides = batch.column("text"), batch.column("doc_id").to_numpy(), _sides(batch)
            for i, j in slices(utf8(column)[1], spec.chunk):
                units, at = spec.units(column.slice(i, j - i))
                g, c, row, lo, n = contexts(units, at, spec)
                held.append((g, c, ids[i:j][row], sides[i:j][row], lo, n))
                count += len(g)
                if count >= HELD:
                    yield _settled(held, spec.within)
                    held, count = [], 0
        if count:
            yield _settled(held, spec.within)

    rows = docs.mapInArrow(released(make), "g long, c long, doc_id long, side long, packed long")
    return rows if "side" in docs.columns else rows.drop("side")


def _spotted(docs: DataFrame, spec: Windows) -> DataFrame:
    """doc_id, side, packed, g, shard: known repeats (shard null) and contexts to be compared further."""
    rows = _read(docs, spec)
    key = key_of(rows)
    equal = Window.partitionBy("g", "c").orderBy(*key, "packed")  # packed is in the order of starts
    if spec.within:
        rows = rows.withColumn("later", F.rank().over(equal) > 1)
    else:
        rows = rows.withColumn("later", F.struct(*key) > F.first(F.struct(*key)).over(equal))
    rows = rows.withColumn("number", F.dense_rank().over(Window.partitionBy("g").orderBy("c")))
    rows = rows.withColumn("kinds", F.max("number").over(Window.partitionBy("g")))
    known = F.col("later") | (F.col("packed").bitwiseAND(F.lit(1)) == 1)
    shards = F.when(F.col("kinds") > SHARD, 1 + F.floor((F.col("number") - 1) / SHARD)).otherwise(F.lit(0))
    shard = F.when(~known, shards.cast("int"))
    return rows.filter(known | (F.col("kinds") > 1)).select(*key, "packed", F.when(~known, F.col("g")).alias("g"), shard.alias("shard"))


def _fetched(docs: DataFrame, spotted: DataFrame, spec: Windows) -> DataFrame:
    """g, shard, doc_id, side, lo, n, units: known repeats joined to runs (shard null), and contexts with their units."""
    key = key_of(docs)
    wanted = spotted.groupBy(*key).agg(F.collect_set(F.struct("packed", "g", "shard")).alias("wanted"))
    rows = docs.join(wanted, key)

    def read(batches):
        for batch in batches:
            column, ids, sides = batch.column("text"), batch.column("doc_id").to_numpy(), _sides(batch)
            lists = batch.column("wanted")
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            flat = lists.flatten()
            packed, gram = flat.field("packed").to_numpy(), flat.field("g").fill_null(0).to_numpy()
            shard = flat.field("shard").fill_null(-1).to_numpy()
            for i, j in slices(utf8(column)[1], spec.chunk):
                units, at = spec.units(column.slice(i, j - i))
                own = slice(ends[i], ends[j])
                row = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))
                lo, n, g, s = packed[own] >> 21, (packed[own] >> 1) & 0xFFFFF, gram[own], shard[own]
                known = s < 0
                r, a, b = joined(row[known], lo[known], lo[known] + n[known])
                open_ = np.flatnonzero(~known)
                size = units.itemsize
                raw = units.tobytes()
                first = (at[:-1][row[open_]] + lo[open_]) * size
                last = first + (n[open_] + spec.length - 1) * size
                texts = [None] * len(r) + [raw[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
                of = np.concatenate((r, row[open_]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((np.zeros(len(r), np.int64), g[open_]))),
                        pa.array(np.concatenate((np.full(len(r), -1), s[open_])).astype(np.int32)),
                        pa.array(ids[i:j][of]),
                        pa.array(sides[i:j][of]),
                        pa.array(np.concatenate((a, lo[open_]))),
                        pa.array(np.concatenate((b - a, n[open_]))),
                        pa.array(texts, pa.binary()),
                    ],
                    names=["g", "shard", "doc_id", "side", "lo", "n", "units"],
                )

    return rows.mapInArrow(released(read), "g long, shard int, doc_id long, side long, lo long, n long, units binary")


def joined(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal ranges of each row, from ranges lo to hi (exclusive) that may overlap or touch; rows ascend in the result."""
    if not len(row):
        return row.astype(np.int64), lo.astype(np.int64), hi.astype(np.int64)
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    # the furthest end so far within the row: rows are moved apart so that one running maximum serves all
    far = int(hi.max()) + 1
    end = np.maximum.accumulate(hi + row * far) - row * far
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (lo[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], lo[first], end[last]


def _merged(rows: DataFrame, spec: Windows) -> DataFrame:
    """Repeats among the windows that several shards of one gram have kept: sorted runs merged by binary search."""
    keys = ["g", "part"]

    def merge(batches):
        for held, group in _groups(batches, keys):
            shard, doc, side, lo = (held.column(c).to_numpy() for c in ("shard", "doc_id", "side", "lo"))
            window = held.column("window").to_numpy()
            width = len(window[0])
            window = np.frombuffer(b"".join(window), f"S{width}")
            ends = np.append(np.flatnonzero((np.diff(group) != 0)) + 1, len(group))
            out = []
            for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
                # the earliest occurrence so far of each window, in order of windows
                own = np.arange(a, b)
                first = np.append(True, (window[a + 1 : b] != window[a : b - 1]) | (shard[a + 1 : b] != shard[a : b - 1]))
                runs = np.split(own[first], np.flatnonzero(np.diff(shard[own[first]])) + 1)
                known = runs[0]
                for run in runs[1:]:
                    place = np.searchsorted(window[known], window[run])
                    hit = np.minimum(place, len(known) - 1)
                    same = window[known[hit]] == window[run]
                    old, new = known[hit[same]], run[same]
                    later = (doc[new] > doc[old]) | ((doc[new] == doc[old]) & ((side[new] > side[old]) | ((side[new] == side[old]) & (lo[new] > lo[old]))))
                    known[hit[same]] = np.where(later, old, new)
                    known = np.insert(known, place[~same], run[~same])
                least = known[np.searchsorted(window[known], window[own])]
                out.append(own[(doc[own] != doc[least]) | (side[own] != side[least]) | (spec.within & (lo[own] != lo[least]))])
            found = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[found]) for x in (doc, side, lo)), pa.array(np.ones(len(found), np.int64))], names=["doc_id", "side", "lo", "n"])

    rows = rows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(64)).cast("int"))
    rows = rows.repartition(partitions(rows), *keys).sortWithinPartitions(*keys, "shard", "window", "doc_id", "side", "lo")
    return rows.mapInArrow(released(merge), "doc_id long, side long, lo long, n long")


def _solved(rows: DataFrame, spec: Windows, solve: Callable) -> DataFrame:
    """doc_id, lo, n of repeats (window null), and the windows that shards of one gram still have to compare."""
    keys = ["g", "shard"]

    def run(batches):
        for held, group in _groups(batches, keys):
            doc, side, lo, n = (held.column(c).to_numpy() for c in ("doc_id", "side", "lo", "n"))
            gram, shard = held.column("g").to_numpy(), held.column("shard").to_numpy()
            texts = held.column("units").to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
            a = 0
            while a < len(group):  # whole shards, some at a time
                far = np.searchsorted(np.cumsum(size[a:]), SOLVED, "right") + a
                b = int(ends[min(np.searchsorted(ends, max(far, a + 1)), len(ends) - 1)])
                # documents by their rank in the order of doc_id and side
                rank = np.unique(np.rec.fromarrays((doc[a:b], side[a:b])), return_inverse=True)[1]
                repeats, kept, names = solve(texts[a:b], rank, lo[a:b], n[a:b], np.flatnonzero(shard[a:b] > 0), spec)
                r, s, e = joined(repeats[0], repeats[1], repeats[1] + 1)
                r, owner = r + a, kept[0] + a
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((doc[r], doc[owner]))),
                        pa.array(np.concatenate((side[r], side[owner]))),
                        pa.array(np.concatenate((s, kept[1]))),
                        pa.array(np.concatenate((e - s, np.ones(len(owner), np.int64)))),
                        pa.array(np.concatenate((gram[r], gram[owner]))),
                        pa.array(np.concatenate((shard[r], shard[owner]))),
                        pa.array([None] * len(r) + names, pa.binary()),
                    ],
                    names=["doc_id", "side", "lo", "n", "g", "shard", "window"],
                )
                a = b

    rows = rows.repartition(partitions(rows), *keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(released(run), "doc_id long, side long, lo long, n long, g long, shard int, window binary")


def repeats(docs: DataFrame, spec: Windows, solve: Callable) -> DataFrame:
    """key_of(docs), runs array<struct<lo, n>>: the starts of windows that also start earlier, for documents that have any.

    docs: as from keyed(). solve(contexts, documents' ranks, first starts, windows, contexts whose windows go on,
    spec) returns repeats (context numbers and starts in the document), kept windows (likewise) and their names as
    equal-length bytes.
    """
    fetched = cut(_fetched(docs, _spotted(docs, spec), spec))
    free(docs.sparkSession)
    solved = cut(_solved(fetched.filter("shard >= 0"), spec, solve))
    free(docs.sparkSession)
    merged = _merged(solved.filter("window IS NOT NULL").select("g", "shard", "doc_id", "side", "lo", "window"), spec)
    run = ["doc_id", "side", "lo", "n"]
    found = fetched.filter("shard < 0").select(run).unionByName(solved.filter("window IS NULL").select(run)).unionByName(merged)
    return found.groupBy(*key_of(docs)).agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
