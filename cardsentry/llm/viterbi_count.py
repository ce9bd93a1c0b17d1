"""Token counts of a unigram vocabulary, without the tokens (operator 2).

An Aho-Corasick automaton enumerates every vocabulary piece that ends at each
character; dynamic programming carries the best score and the number of pieces
of the best segmentation up to there.  Tie rules are those of the public
tokenizers' unigram model: starts are tried from the left and only a strictly
better score replaces an earlier one, so the longest last piece wins a tie.  A
character that no single-character piece covers costs the least score minus 10
and counts one piece for each of its UTF-8 bytes (byte fallback).

Spaces become the mark U+2581 and a text gets one in front.  No piece holds a
mark after another character, so the best segmentation never crosses the begin
of a word: distinct words are counted once per stretch and texts are sums.

Defined cases: null or empty text has 0 tokens; white space only is counted like
any other text; repeated rows are counted each.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import ChunkTable
from .shared import ship

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def load_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, without control, unknown and byte pieces (never found in a text)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in usual]


def words_of(text: str) -> list[str]:
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


class Counter:
    """Counts the pieces of many words at once: one pass over all of them in a row."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        crossing = [p for p, _ in vocabulary if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces that reach over a word's begin are not supported: {crossing[:3]}")
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # marks alone join a following word, so a word of marks is counted by itself
        counts = np.zeros(len(words), dtype=np.int64)
        usual = [i for i, w in enumerate(words) if w[-1] != MARK]
        ends = np.cumsum([len(words[i]) for i in usual]) if usual else np.zeros(0, np.int64)
        total = np.array(self._pieces("".join([words[i] for i in usual])), dtype=np.int64)
        counts[usual] = np.diff(total[ends], prepend=0)
        for i, w in enumerate(words):
            if w[-1] == MARK:
                counts[i] = self._pieces(w)[-1]
        return counts, np.arange(len(words) + 1)

    def _pieces(self, text: str) -> list[int]:
        """Number of pieces in the best segmentation of every prefix of ``text``."""
        best, pieces = [0.0], [0]
        unknown = self.unknown
        at, top, n, single = 0, None, 0, False

        def settle(end: int) -> None:
            """Close the position after ``end`` characters."""
            nonlocal top, n
            if not single:
                score = best[end - 1] + unknown
                if top is None or score > top:
                    top, n = score, pieces[end - 1] + len(text[end - 1].encode())
            best.append(top)
            pieces.append(n)

        # matches come by their end, longest first: the order of starts from the left
        for last, (length, score) in self.automaton.iter(text):
            while at < last:
                at += 1
                settle(at)
                top, single = None, False
            start = last + 1 - length
            score += best[start]
            if top is None or score > top:
                top, n = score, pieces[start] + 1
            if length == 1:
                single = True
        while at < len(text):
            at += 1
            settle(at)
            top, single = None, False
        return pieces


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """``(doc_id, n_tokens)`` for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        table = ChunkTable(Counter(held.value), words_of)
        for batch, counts, first in table.encode_batches(batches):
            total = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(total[first[1:]] - total[first[:-1]])], names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long")
