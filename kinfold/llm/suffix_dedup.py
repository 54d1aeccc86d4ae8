"""Removal of long byte strings that occur earlier, by suffix arrays of shards.

kinfold.llm.anchors deals the places where strings may repeat to shards. A shard's suffix array is
built in numpy by Larsson-Sadakane refinement (groups of equal prefixes are sorted by the rank of what
follows, prefixes double, groups of one are left alone), common prefixes of neighbours by Kasai's
relation (a suffix shares at least what its left neighbour in the text shares, less one), and windows of
one gram that filled several shards are merged by binary search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.anchors import Windows, byte_units, byte_values, joined, key_of, keyed, repeats
from kinfold.llm.common import real_id, released, texts_of, utf8

GRAM = 24


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the `depth` bytes (at least) that start there; the end sorts before all bytes."""
    n = len(data)
    wide = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(7):  # seven bytes, each with 1 added so that the end is smallest
        key = key * np.uint64(257) + np.where(np.arange(k, n + k) < n, wide[k : n + k] + np.uint64(1), np.uint64(0))
    order = np.argsort(key)
    new = np.ones(n, bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # the first place of the group
    size = 7
    while size < depth:
        ends = np.ones(n, bool)
        ends[:-1] = new[1:]
        loose = np.flatnonzero(~(new & ends))  # members of groups of several
        if not len(loose):
            break
        place = order[loose]
        follow = place + size
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        pair = (rank[place] << 32) | second
        turn = np.argsort(pair)
        place, pair = place[turn], pair[turn]
        order[loose] = place
        first = np.ones(len(loose), bool)
        first[1:] = pair[1:] != pair[:-1]
        new[loose] = first
        rank[place] = loose[np.flatnonzero(first)[np.cumsum(first) - 1]]
        size *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each place of the order the bytes shared with the place before it, exact below `limit`."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    # a place whose left neighbour in the text has the left neighbour of its partner shares one byte less
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] == before[1:] - 1) & (before[:-1] >= 0)
    if n > 1:
        at = np.flatnonzero(follows)
        follows[at] = data[at - 1] == data[before[at] - 1]
    head = np.flatnonzero(~follows & (before >= 0))
    # heads are compared in words of eight bytes; a head also serves those that follow it
    run = np.diff(np.append(np.flatnonzero(~follows), n))[np.searchsorted(np.flatnonzero(~follows), head)]
    most = np.minimum(limit + run, n - np.maximum(head, before[head]))
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    shared = np.zeros(len(head), np.int64)
    live = np.arange(len(head))
    while len(live):
        x, y = head[live] + shared[live], before[head[live]] + shared[live]
        differ = eight[np.minimum(x, n)] != eight[np.minimum(y, n)]
        some = differ.any(1)
        shared[live] += np.where(some, differ.argmax(1), 8)
        live = live[~some & (shared[live] < most[live])]
    shared = np.minimum(shared, most)
    plain = np.zeros(n, np.int64)
    plain[head] = shared
    origin = np.arange(n)
    origin[follows] = 0
    origin = np.maximum.accumulate(origin)
    plain = np.where(follows, np.maximum(plain[origin] - (np.arange(n) - origin), 0), plain)
    return plain[order]


def solve(texts: list[bytes], doc: np.ndarray, lo: np.ndarray, n: np.ndarray, onward: np.ndarray, spec: Windows):
    """The solver for anchors.repeats: windows of one class are neighbours in the suffix array."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(size) - size
    order = suffix_array(data, spec.length)
    kind = np.empty(len(data), np.int64)
    kind[order] = np.cumsum(common_prefixes(data, order, spec.length) < spec.length)
    owner = np.repeat(np.arange(len(texts)), n)
    step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    place = base[owner] + step
    start = lo[owner] + step
    by = np.lexsort((start, doc[owner], kind[place]))
    owner, start, place = owner[by], start[by], place[by]
    cls = kind[place]
    first = np.ones(len(cls), bool)
    first[1:] = cls[1:] != cls[:-1]
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = (doc[owner] != doc[owner[head]]) | (spec.within & (start != start[head]))
    raw = data.tobytes()
    goes = np.zeros(len(texts), bool)
    goes[onward] = True
    kept = np.flatnonzero(~later & goes[owner])
    names = [raw[p : p + spec.length] for p in place[kept].tolist()]
    return (owner[later], start[later]), (owner[kept], start[kept]), names


def byte_windows(length: int) -> Windows:
    return Windows(length, min(GRAM, max(1, length // 3)), byte_units, byte_values, within=True)


def cut_out(docs: DataFrame, length: int = 100, whole_characters: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns `keep`, kept (the remaining bytes), n_bytes, n_removed, n_spans of every row.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a smaller doc_id, or in
    the same document further to the front. With whole_characters, a character of which only some bytes
    would go stays whole. Null and empty texts have no bytes, and so no spans. A null doc_id is the smallest. Rows of
    one doc_id and different texts are documents one after the other, in the order of a hash of the text; exact
    repeats of a row are one document, and each of them keeps what it keeps. Of equal strings the earliest start
    stays, so there are no ties. A text of any length is read whole. An empty table gives an empty result; columns
    other than `keep` are ignored, whatever their names.
    """
    carried = [f"_{i}" for i in range(len(keep))]  # names that can't clash
    rows = keyed(texts_of(docs, *[F.col(c).alias(n) for c, n in zip(keep, carried, strict=True)]))
    found = repeats(rows.select(*key_of(rows), "text"), byte_windows(length), solve)

    def apply(batches):
        for batch in batches:
            data, at = utf8(batch.column("text"))
            lists = batch.column("runs")
            count = lists.value_lengths().fill_null(0).to_numpy()
            flat = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), count)
            lo, n = flat.field("lo").to_numpy(), flat.field("n").to_numpy()
            row, lo, hi = joined(row, lo, lo + n - 1 + length)
            hi = np.minimum(hi, np.diff(at)[row])
            if whole_characters and len(row):
                inner = np.append((data & 0xC0) == 0x80, False)  # bytes that continue a character
                for _ in range(3):
                    lo = lo + inner[np.minimum(at[row] + lo, len(data))]
                    hi = hi - inner[np.minimum(at[row] + hi, len(data))] * (at[row] + hi < at[row + 1])
            gone = np.zeros(len(data) + 1, np.int8)  # ranges are disjoint
            keep_range = hi > lo
            row, lo, hi = row[keep_range], lo[keep_range], hi[keep_range]
            np.add.at(gone, at[row] + lo, 1)
            np.add.at(gone, at[row] + hi, -1)
            stays = np.cumsum(gone[:-1], dtype=np.int8) == 0
            removed = np.bincount(row, hi - lo, batch.num_rows).astype(np.int64)
            spans = np.bincount(row, minlength=batch.num_rows).astype(np.int64)
            left = data[stays].tobytes()
            ends = np.cumsum(np.diff(at) - removed).tolist()
            kept, begin = [], 0
            for end in ends:
                kept.append(left[begin:end])
                begin = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in carried), pa.array(kept, pa.binary()), pa.array(np.diff(at)), pa.array(removed), pa.array(spans)],
                names=["doc_id", *carried, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = "doc_id long, " + "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in carried)
    out = rows.join(found, key_of(rows), "left").mapInArrow(released(apply), schema + "kept binary, n_bytes long, n_removed long, n_spans long")
    return out.withColumnsRenamed(dict(zip(carried, keep, strict=True)))


def digest(docs: DataFrame, length: int = 100) -> DataFrame:
    out = cut_out(docs, length)
    return out.select(real_id(), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
