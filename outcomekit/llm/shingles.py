"""Word shingles of many texts at once, with numpy on Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from outcomekit.llm.common import binary_slices, data, offsets

SHINGLE = 5


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (xor-shift, multiply; uint64)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _byte_codes() -> np.ndarray:
    """A 64-bit code per byte; A-Z have those of a-z."""
    code = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    code[ord("A"):ord("Z") + 1] = code[ord("a"):ord("z") + 1]
    return code


CODE = _byte_codes()
BASE = 0xA0761D6478BD642F                 # odd, so that its powers can be undone modulo 2**64
BACK = pow(BASE, -1, 1 << 64)
PLACE = mix64(np.arange(11, 11 + SHINGLE, dtype=np.uint64)) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
        if size > 1 << 24:                 # a giant text: don't keep its table
            del _powers[base]
    return have[:n]


def word_hashes(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each lower-cased word of the texts in ``raw`` (text i ends
    at ``ends[i]``), and the number of words of each text."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    gap = SPACE[raw]
    begins = ~gap
    stops = begins.copy()
    begins[1:] &= gap[:-1]
    stops[:-1] &= gap[1:]
    starts_of = np.concatenate(([0], ends[:-1]))
    cuts = starts_of[(starts_of > 0) & (starts_of < n)]          # a text's edge ends a word too
    begins[cuts] |= ~gap[cuts]
    stops[cuts - 1] |= ~gap[cuts - 1]
    at, to = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    total = np.cumsum(CODE[raw] * _power(BASE, n))
    before = np.where(at > 0, total[np.maximum(at - 1, 0)], np.uint64(0))
    h = (total[to - 1] - before) * _power(BACK, n)[at]
    h = mix64(h + (to - at).astype(np.uint64))
    count = np.searchsorted(at, ends, side="left")
    return h, np.diff(np.concatenate(([0], count)))


def shingle_sets(column: pa.Array):
    """Yield (row, sorted distinct uint64 shingle hashes) for every text of a
    binary column.  A text of fewer than five words is one shingle; one without
    words has none."""
    off, raw_all = offsets(column), data(column)
    for lo, hi in binary_slices(column):
        base = off[lo]
        h, counts = word_hashes(raw_all[base: off[hi]], off[lo + 1: hi + 1] - base)
        n = len(h) - SHINGLE + 1
        if n > 0:
            g = h[:n] * PLACE[0]
            for k in range(1, SHINGLE):
                g = g + h[k: k + n] * PLACE[k]
            g = mix64(g)
        end = np.cumsum(counts)
        for i, (e, c) in enumerate(zip(end.tolist(), counts.tolist())):
            if c >= SHINGLE:
                s = np.sort(g[e - c: e - SHINGLE + 1])
                if len(s) > 1:
                    s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif c:
                w = h[e - c: e]
                s = mix64((w * PLACE[:c]).sum(dtype=np.uint64, keepdims=True) + np.uint64(c))
            else:
                s = h[:0]
            yield lo + i, s
