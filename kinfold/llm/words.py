"""Words of byte buffers in numpy: spans, 64-bit hashes and k-word shingles, without a Python step per word."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
#: A random number for each byte at each of the first PLACES places; later places use them again, times a number of their block.
PLACES = 4096
_BYTES = np.random.default_rng(20240611).integers(0, 2**64, PLACES * 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers of the base, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 2 * len(_POWERS)), _BASE, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:n]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word [^\\x20\\x09-\\x0D]+ (or run of bytes marked inside), and the number of words of each text."""
    n, rows = len(data), len(at) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    if inside is None:
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, at))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """A 64-bit hash of each span, spans being in order; works in blocks of bytes.

    Spans are summed up by tabulation: every byte at every place adds a random number of its own, so that two
    different spans are equal with a chance of 2**-64, whatever pattern they follow.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, "right")))
        size = ends[i:j] - starts[i:j]
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        byte = data[np.repeat(starts[i:j], size) + place]
        if int(size.max()) <= PLACES:
            value = _BYTES[(place << 8) | byte]
        else:
            value = _BYTES[((place % PLACES) << 8) | byte] * (mix((place // PLACES).astype(np.uint64)) | np.uint64(1))
        out[i:j] = np.add.reduceat(value, first)
        i = j
    return mix(out)


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct k-word shingles of each text, end to end, and the n + 1 offsets of the texts.

    A text of fewer than k words has its whole sequence as its one shingle, a text without words none.
    """
    at = np.concatenate(([0], np.cumsum(counts)))
    if len(words) >= k:
        total = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            total = mix(total + words[j : len(words) - k + 1 + j] + np.uint64(2 * j + 1))
    else:
        total = np.zeros(0, np.uint64)
    parts, sizes = [], np.zeros(len(counts), np.int64)
    for i, n in enumerate(counts.tolist()):
        if n >= k:
            own = np.unique(total[at[i] : at[i + 1] - k + 1])
        elif n:
            one = np.zeros(1, np.uint64)
            for j in range(n):
                one = mix(one + words[at[i] + j] + np.uint64(2 * j + 1))
            own = mix(one + np.uint64(1000 + n))
        else:
            continue
        sizes[i] = len(own)
        parts.append(own)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))
