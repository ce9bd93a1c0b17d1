"""Words of whole Arrow text columns, hashed with numpy.

A word is a maximal run of characters other than space and the control
characters 9 to 13.  Those separators are single bytes in UTF-8, so words are
found and hashed on the raw bytes of a whole batch at once, without a Python
object per word.

The hash of a word of up to ``LONG`` bytes is the sum of ``TABLE[byte] *
B**offset`` modulo 2**64, mixed by a 64-bit finaliser.  Such a sum has known
collisions for long words of few letters, so longer words, which are rare, take
XXH3 instead.  Runs of words are hashed as sums over word hashes, so the hash of
any run comes from two prefix sums (``run_hashes``); callers use it for short
runs (a shingle, a gram, a window).
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
_INV = U(pow(int(BASE), -1, 1 << 64))
LONG = 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_TABLE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x2545F4914F6CDD1D))
# the same with A-Z hashed as a-z
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
# everything in ASCII but letters and digits
_IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class _Powers:
    """Powers of a base, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base = base
        self.at = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.at) < n:
            steps = np.full(max(n, 2 * len(self.at)), self.base, dtype=np.uint64)
            steps[0] = 1
            self.at = np.multiply.accumulate(steps)
        return self.at[:n]


_POW, _IPOW = _Powers(BASE), _Powers(_INV)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[starts:ends]`` for each pair of offsets; equal runs get equal hashes."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _POW.upto(len(values)), out=total[1:])
    h = (total[ends] - total[starts]) * _IPOW.upto(len(values) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a batch of texts: word ``i`` is ``data[start[i]:end[i]]``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray
    offset: np.ndarray

    def bounds(self, d: int) -> tuple[int, int]:
        return int(self.first[d]), int(self.first[d + 1])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offsets of each text in them; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def split_words(texts: pa.Array, fold_case: bool = False, at_marks: bool = False) -> Words:
    """Find and hash the words of every text; ``fold_case`` hashes A-Z as a-z, ``at_marks`` also splits at ASCII punctuation."""
    data, offset = text_buffer(texts)
    space = (_IS_MARK if at_marks else _IS_SPACE)[data]
    # a word starts at a non-space byte after a space or at a text's begin, and ends likewise
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = space[:-1]
    if len(data):
        edge[offset[:-1][offset[:-1] < len(data)]] = True
    start = np.flatnonzero(edge[:-1] & ~space)
    stop = np.ones(len(data) + 1, dtype=bool)
    stop[1:-1] = space[1:]
    if len(data):
        stop[offset] = True
    end = np.flatnonzero(stop[1:] & ~space) + 1
    first = np.searchsorted(start, offset)
    h = np.zeros(0, np.uint64)
    if len(start):
        # prefix sums over slices of the batch, cut at word starts, keep the working set small
        parts, step = [], 1 << 18
        cuts = np.unique(np.concatenate([np.searchsorted(start, np.arange(0, len(data), step)), [len(start)]]))
        table = _FOLDED if fold_case else _TABLE
        for a, b in zip(cuts[:-1], cuts[1:]):
            lo, hi = start[a], end[b - 1]
            parts.append(run_hashes(table[data[lo:hi]], start[a:b] - lo, end[a:b] - lo))
        h = np.concatenate(parts)
        for i in np.flatnonzero(end - start > LONG).tolist():
            word = data[start[i] : end[i]].tobytes()
            h[i] = xxhash.xxh3_64_intdigest(word.lower() if fold_case else word)
    return Words(data, start, end, first, h, offset)


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = np.arange(n)
    return run_hashes(words, at, at + k)


def slices(batches, column: str, limit: int = 1 << 20):
    """Cut Arrow record batches into runs of rows with about ``limit`` bytes of text at most (one row at least).

    At the end, memory that the task freed goes back to the system: Python
    workers live on from task to task.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(sizes):
            n = max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 65536]), limit, side="right")))
            yield batch.slice(at, n)
            at += n
    give_back()


def give_back() -> None:
    """Return freed memory of Arrow's and the C library's pools to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
