"""Periodic runs of words within a document (operator 13).

A run is a stretch of words with smallest period q (words q apart are the same),
at least ``max(MIN_WORDS, MIN_TURNS * q)`` words long, that no neighbouring word
extends keeping the period.  Seen along the diagonal of lag q (word i against
word i + q) a run is a stretch of matches that is q shorter: at least 3q long.

Seed and extend, for the lags of each octave 2**j to 2**(j+1) - 1 in turn:

1. Index the k-grams of the minimum guaranteed overlap, k = 3 * 2**j (5 for lag
   1): the shortest matching stretch of any run of the octave.
2. Pairs of neighbouring occurrences of a gram in the same document, at a lag of
   the octave, are the seeds.  These suffice: k is more than 1.5 q, so a gram
   that came again in a run at x < q words' distance would (Fine and Wilf) give
   the run a smaller period.  One pair for each position keeps the seeds linear.
3. Each seed is extended left and right along its diagonal on the words
   themselves.  A table by lag holds how far the diagonal is covered; a seed
   before that point is not extended again.
4. A stretch that is long enough and whose period has no smaller divisor is a run.

Grams are named by hashing pairs of names of half their length; words have exact
numbers, so a gram that is hashed alike costs a comparison, not a wrong run.

Documents are worked on where they are: nothing is shuffled, and memory follows
one slice of texts (or one text, if longer).

Defined cases: null or empty text has no words and no runs; rows that repeat a
doc_id are each returned.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Index
from .shared import ship
from .words import U, mix, slices

MIN_WORDS = 6
MIN_TURNS = 4


def matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many values at the front of two arrays are the same."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + step)
        unlike = a[at:end] != b[at:end]
        if unlike.any():
            return at + int(unlike.argmax())
        at, step = end, 4 * step
    return n


def primitive(word: np.ndarray) -> bool:
    """Whether a period is no repetition of a shorter one."""
    q, rest, factor = len(word), len(word), 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            d = q // factor
            if np.array_equal(word[:-d], word[d:]):
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def octaves(words: np.ndarray, first: np.ndarray):
    """``(lowest lag, names of the octave's grams, their length)`` for every octave that some document is long enough for."""
    name = mix(words.astype(np.uint64) + U(0x9E3779B97F4A7C15))
    longest = int(np.diff(first).max()) if len(first) > 1 else 0

    def double(x: np.ndarray, y: np.ndarray, gap: int, level: int) -> np.ndarray:
        n = max(0, len(y) - gap)
        return mix(mix(x[:n] + U(level)) * U(0xD6E8FEB86659FD93) + y[gap : gap + n])

    two = double(name, name, 1, 1)
    four = double(two, two, 2, 2)
    if longest >= MIN_WORDS:
        yield 1, double(four, name, 4, 3), 5
    low, half, whole = 2, two, four
    while MIN_TURNS * low <= longest:
        yield low, double(whole, half, 2 * low, 64 + low), 3 * low
        low, half, whole = 2 * low, whole, double(whole, whole, 2 * low, 128 + low)


def seeds(names: np.ndarray, k: int, low: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, lag)`` of neighbouring occurrences of a gram in one document at lags low to 2 * low - 1, by lag and position."""
    size = np.diff(first)
    long = np.flatnonzero(size >= max(MIN_WORDS, MIN_TURNS * low))
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = size[long] - k + 1
    at = np.repeat(first[long] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    doc = np.repeat(long, n)
    order = np.argsort(names[at], kind="stable")
    gram, at, doc = names[at][order], at[order], doc[order]
    lag = at[1:] - at[:-1]
    ok = (gram[1:] == gram[:-1]) & (doc[1:] == doc[:-1]) & (lag >= low) & (lag < 2 * low)
    at, lag = at[:-1][ok], lag[ok]
    order = np.lexsort((at, lag))
    return at[order], lag[order]


def find_runs(words: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of each document, by start and period; document d has words first[d]:first[d + 1]."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    for low, names, k in octaves(words, first):
        at, lag = seeds(names, k, low, first)
        doc = np.searchsorted(first, at, side="right") - 1
        # the next position of a diagonal is covered by the extension from this one
        head = np.ones(len(at), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        covered: dict[tuple[int, int], int] = {}
        for i, q, d in zip(at[head].tolist(), lag[head].tolist(), doc[head].tolist()):
            if i < covered.get((d, q), 0):
                continue
            lo, hi = int(first[d]), int(first[d + 1])
            right = i + matching(words[i : hi - q], words[i + q : hi])
            left = i - matching(words[lo:i][::-1], words[lo + q : i + q][::-1])
            covered[d, q] = right
            length = right - left + q
            if length >= max(MIN_WORDS, MIN_TURNS * q) and primitive(words[left : left + q]):
                runs[d].append((left - lo, length, q))
    for one in runs:
        one.sort(key=lambda r: (r[0], r[2]))
    return runs


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most turns, exactly; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


Edit = Callable[[int | None, list], list]


def periodic_runs(docs: DataFrame, edit: Edit | None = None) -> DataFrame:
    """``(doc_id, n_words, runs array<struct<start, length, period>>, collapsed)`` for every row of ``docs(doc_id, text)``.

    ``collapsed`` holds the words, joined by one space, without those that repeat
    a run's first period.  ``edit(doc_id, words)`` may rewrite the words (bytes)
    of a document first.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, "text"):
            number, texts = Index(), []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = (text.as_py() or "").encode().split()
                texts.append(edit(doc, words) if edit else words)
            first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
            ids = np.fromiter((number[w] for words in texts for w in words), np.int64, int(first[-1]))
            found = find_runs(ids, first)
            collapsed = []
            for words, runs in zip(texts, found):
                if runs:
                    words = [w for w, gone in zip(words, dropped(len(words), runs).tolist()) if not gone]
                collapsed.append(b" ".join(words).decode())
            flat = np.array([r for one in found for r in one], np.int64).reshape(-1, 3)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
            ends = np.concatenate([[0], np.cumsum([len(one) for one in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(ends), parts), pa.array(collapsed, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
