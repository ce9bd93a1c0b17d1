"""Benchmark decontamination: seeds, then Smith-Waterman (operator 4).

Texts and benchmark items are lower-cased and split at white space and ASCII
punctuation.  The steps:

1. The seeds are all runs of ``seed`` words of the items.  None is set aside for
   being frequent: copies of an item make its own seeds frequent, so a count in
   the corpus cannot tell a phrase of the language from a copy.  Whether a
   document holds a copy therefore depends on that document alone.
2. One pass looks up the seeds in every document.  Each hit proposes a passage
   around its diagonal; overlapping proposals merge.  A frequent phrase costs a
   count of the item's words in the passage; a passage that shares enough of them
   is aligned with the item by Smith-Waterman (match +2, mismatch -1, gap -1).

The score is the best local alignment divided by the score of an exact copy; hits
are from ``min_score``.  An alignment must also be worth ``MIN_WORDS`` matched
words (16 points), or all words of a shorter item, since fewer are often a phrase
of the language.  This floor raises the bound of items under 16 words: 15 words
need 0.53, 12 words 0.67, 10 words 0.8, 9 words 0.89, and 8 words or fewer a
verbatim copy.
No text is shuffled.  What each task holds of the benchmark is bounded by
``MAX_WORDS`` words: a larger benchmark is worked off in slices of whole items,
one pass each.

Defined cases: null texts are empty; empty documents, and items with fewer words
than a seed, match nothing; repeated rows each give their rows; an item_id that
repeats counts as one item for each distinct text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, drop_rows, text_print
from .words import rolling, slices, split_words

SEED = 3
MIN_SCORE = 0.5
MIN_WORDS = 8
MAX_WORDS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the passage position after its last matched word."""
    n = len(passage)
    row = np.zeros(n + 1, np.int64)
    lift = np.arange(n + 1) * -GAP
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new = np.zeros(n + 1, np.int64)
        np.maximum(row[:-1] + step, row[1:] + GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        # gaps along the passage: a running maximum with the gap cost added back
        new = np.maximum.accumulate(new + lift) - lift
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top
        row = new
    return best, end


class Benchmark:
    """Items of one slice: word hashes and seeds, laid out for lookup by hash."""

    def __init__(self, ids: list, words: np.ndarray, first: np.ndarray, seed: int):
        self.ids, self.words, self.first, self.seed = ids, words, first, seed
        grams = rolling(words, seed)
        at = np.arange(len(grams))
        item = np.searchsorted(first, at, side="right") - 1
        inside = at + seed <= first[item + 1]
        gram, item, pos = grams[inside], item[inside], (at - first[item])[inside]
        order = np.argsort(gram, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.keys, self.lo, self.n = np.unique(gram[order], return_index=True, return_counts=True)
        self.vocabulary, self.place = np.unique(words, return_inverse=True)
        self.seen = np.zeros(len(self.vocabulary), dtype=bool)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of grams that are seeds, and their places in ``keys``."""
        at = np.flatnonzero(self.maybe[(grams & np.uint64(0xFFFFF)).astype(np.int64)])
        if not len(self.keys):
            return at[:0], at[:0]
        key = np.searchsorted(self.keys, grams[at])
        key[key == len(self.keys)] = 0
        yes = self.keys[key] == grams[at]
        return at[yes], key[yes]

    def shared(self, target: np.ndarray, passage: np.ndarray) -> int:
        """How many words of an item (places in ``vocabulary``) occur in the passage."""
        place = np.searchsorted(self.vocabulary, passage)
        place[place == len(self.vocabulary)] = 0
        self.seen[place[self.vocabulary[place] == passage]] = True
        n = int(self.seen[target].sum())
        self.seen[place] = False
        return n

    def align(self, words: np.ndarray, at: np.ndarray, key: np.ndarray, min_score: float):
        """``(item, score, start, end)`` of the best passage of each item in one document's words."""
        n = self.n[key]
        rows = np.repeat(self.lo[key] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, begin = self.item[rows], np.repeat(at, n) - self.pos[rows]
        order = np.lexsort((begin, item))
        item, begin = item[order], begin[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(item)) + 1, [len(item)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            of = slice(self.first[item[a]], self.first[item[a] + 1])
            target, place = self.words[of], self.place[of]
            m = len(target)
            pad = m // 2 + 2
            least = max(min_score * MATCH * m, MATCH * min(MIN_WORDS, m))
            starts = begin[a:b]
            split = np.concatenate([[0], np.flatnonzero(np.diff(starts) > m + 2 * pad) + 1, [len(starts)]])
            best = None
            for c, d in zip(split[:-1], split[1:]):
                lo, hi = max(0, int(starts[c]) - pad), min(len(words), int(starts[d - 1]) + m + pad)
                passage = words[lo:hi]
                if MATCH * self.shared(place, passage) < least:
                    continue
                score, end = smith_waterman(target, passage)
                if score >= least and (best is None or score > best[0]):
                    # the same alignment read backwards ends where it starts
                    start = end - smith_waterman(target[::-1], passage[:end][::-1])[1]
                    best = (score, lo + start, lo + end)
            if best:
                yield int(item[a]), best[0] / (MATCH * m), best[1], best[2]


def _slices_of(benchmark: DataFrame, s: Scratch):
    """Collect the benchmark in slices of at most MAX_WORDS words (whole items)."""
    words = F.size(F.split(F.col("text"), r"[^\p{L}\p{N}]+"))
    items = s.stash(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text")).distinct(), "items")
    total = items.agg(F.sum(words)).first()[0] or 0
    parts = max(1, -(-2 * total // MAX_WORDS)) if total > MAX_WORDS else 1
    for part in range(parts):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").toArrow()


def contaminated(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, min_score: float = MIN_SCORE) -> DataFrame:
    """``(doc_id, item_id, score, start_word, end_word)``: documents that hold a copy of an item, exact or edited.

    score is 1 for a verbatim copy; words count from 0 in the document split at
    white space and punctuation, end exclusive; the best passage of each item.
    """
    return _found(docs, benchmark, seed, min_score).drop("fp")


def _found(docs: DataFrame, benchmark: DataFrame, seed: int = SEED, min_score: float = MIN_SCORE) -> DataFrame:
    """``contaminated`` with the fingerprint ``fp`` of each row's text."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_print().alias("fp"), F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    with Scratch(spark, "decontaminate") as s:
        found = None
        for items in _slices_of(benchmark, s):
            words = split_words(items.column("text").combine_chunks(), at_marks=True)
            bench = Benchmark(items.column("item_id").to_pylist(), words.hash, words.first, seed)
            part = s.stash(_align(texts, bench, seed, min_score), "aligned", keep=True)
            found = part if found is None else found.union(part)
        return found


def _align(texts: DataFrame, bench: Benchmark, seed: int, min_score: float) -> DataFrame:
    held = texts.sparkSession.sparkContext.broadcast(bench)

    def run(batches):
        b = held.value
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), at_marks=True)
            at, key = b.hits(rolling(words.hash, seed))
            doc = np.searchsorted(words.first, at, side="right") - 1
            ok = at + seed <= words.first[doc + 1]
            at, key, doc = at[ok], key[ok], doc[ok]
            ids, prints = batch.column("doc_id").to_pylist(), batch.column("fp").to_pylist()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]]) if len(doc) else []
            rows = []
            for a, e in zip(cuts[:-1], cuts[1:]):
                d = int(doc[a])
                lo, hi = words.bounds(d)
                rows += [(ids[d], b.ids[i], *rest, prints[d]) for i, *rest in b.align(words.hash[lo:hi], at[a:e] - lo, key[a:e], min_score)]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "score", "start_word", "end_word", "fp"])

    return texts.mapInArrow(run, "doc_id long, item_id long, score double, start_word long, end_word long, fp long")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a copy of a benchmark item; null doc_id rows stay, and so do clean texts under a doc_id that repeats."""
    return drop_rows(docs, _found(docs, benchmark).select("doc_id", "fp").distinct())
