"""Merging of adjacent symbol pairs by a table of priorities, many short sequences in step, in numpy.

Each sequence has an agenda: its adjacent pairs that the table lists. In every step each sequence
takes from its agenda the pair of best priority, the leftmost of equals, merges it and re-enters its
new neighbours, exactly as a heap would serve them. Long sequences are served by a real heap.
"""

from __future__ import annotations

import heapq

import numpy as np

NEVER = np.int32(2**31 - 1)
#: Symbols from which a sequence gets a heap of its own.
LONG = 256


class Pairs:
    """left, right, priority (smaller is sooner) and the merged symbol of each pair."""

    def __init__(self, left, right, priority, merged):
        key = (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.priority, self.merged = key[order], np.asarray(priority, np.int32)[order], np.asarray(merged, np.int32)[order]
        self._dict: dict[int, tuple[int, int]] | None = None
        bits = max(4, int(4 * len(self.key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(self.key), dtype=np.int32)
        home = self._home(self.key)
        while len(left):  # those that find their slot taken try the next one
            free = left[self.slots[home[left]] < 0]
            self.slots[home[free]] = free
            left = left[self.slots[home[left]] != left]
            home[left] = (home[left] + 1) & (len(self.slots) - 1)

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table, or -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        home = self._home(key)
        out = self.slots[home]
        wrong = np.flatnonzero((out >= 0) & (self.key[out] != key))
        while len(wrong):
            home[wrong] = (home[wrong] + 1) & (len(self.slots) - 1)
            out[wrong] = at = self.slots[home[wrong]]
            wrong = wrong[(at >= 0) & (self.key[at] != key[wrong])]
        return out

    def heap(self, symbols: list[int]) -> list[int]:
        """One sequence by a heap of (priority, position)."""
        if self._dict is None:
            self._dict = {k: (p, m) for k, p, m in zip(self.key.tolist(), self.priority.tolist(), self.merged.tolist(), strict=True)}
        table, n = self._dict, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(hit[0], i, symbols[i], symbols[i + 1], hit[1]) for i in range(n - 1) if (hit := table.get(symbols[i] << 32 | symbols[i + 1]))]
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right, merged = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j], k = merged, -1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if hit := table.get(merged << 32 | symbols[k]):
                    heapq.heappush(agenda, (hit[0], i, merged, symbols[k], hit[1]))
            h = before[i]
            if h >= 0 and (hit := table.get(symbols[h] << 32 | merged)):
                heapq.heappush(agenda, (hit[0], h, symbols[h], merged, hit[1]))
        return [s for s in symbols if s >= 0]

    def merge(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged sequences, end to end, and their lengths; counts has the lengths in `symbols`."""
        at = np.concatenate(([0], np.cumsum(counts)))
        done_rows, done_parts, done_sizes = [], [], []
        for r in np.flatnonzero(counts >= LONG).tolist():
            whole = np.array(self.heap(symbols[at[r] : at[r + 1]].tolist()), np.int32)
            done_rows.append(np.array([r]))
            done_parts.append(whole)
            done_sizes.append(np.array([len(whole)]))
        short = counts < LONG
        rows = np.flatnonzero(short & (counts > 0))
        sym = symbols[np.repeat(short, counts)].astype(np.int32)
        size = counts[rows]
        place = np.full(len(sym), -1, np.int32)
        if len(sym):
            place[:-1] = self.find(sym[:-1], sym[1:])
            place[np.cumsum(size) - 1] = -1
        rank = np.where(place >= 0, self.priority[place], NEVER)
        while len(rows):
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            best = np.minimum.reduceat(rank, start)
            done = best == NEVER
            if done.any():
                keep = np.repeat(~done, size)
                done_rows.append(rows[done])
                done_parts.append(sym[~keep])
                done_sizes.append(size[done])
                sym, place, rank = sym[keep], place[keep], rank[keep]
                rows, size, best = rows[~done], size[~done], best[~done]
                if not len(rows):
                    break
                start = np.concatenate(([0], np.cumsum(size)[:-1]))
            hits = np.flatnonzero(rank == np.repeat(best, size))
            owner = np.searchsorted(start, hits, "right") - 1
            p = hits[np.concatenate(([True], owner[1:] != owner[:-1]))]  # the leftmost of each sequence
            sym[p] = self.merged[place[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            last = p + 2 == start + size  # nothing follows the merged pair
            sym, place, rank = sym[keep], place[keep], rank[keep]
            p -= np.arange(len(p))  # as many places were taken out before
            size = size - 1
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            follow = np.minimum(p + 1, len(sym) - 1)
            place[p] = np.where(last, -1, self.find(sym[p], sym[follow]))
            q = p[p > start]
            place[q - 1] = self.find(sym[q - 1], sym[q])
            for x in (p, q - 1):
                rank[x] = np.where(place[x] >= 0, self.priority[place[x]], NEVER)
        if not done_rows:
            return np.zeros(0, np.int32), np.zeros(len(counts), np.int64)
        rows, flat, size = np.concatenate(done_rows), np.concatenate(done_parts), np.concatenate(done_sizes)
        out = np.zeros(len(counts), np.int64)
        out[rows] = size
        begin = np.zeros(len(counts), np.int64)
        begin[rows] = np.cumsum(size) - size
        return flat[spread(begin, out)], out


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... (count[i] of them) for each i, end to end."""
    total = np.cumsum(count)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + count, count)
