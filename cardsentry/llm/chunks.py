"""Texts as indices into a dictionary of their distinct chunks.

Tokenizers treat a chunk (white space and the run of other characters after it)
the same wherever it stands, so each distinct chunk is encoded once per stretch
and a text's ids are gathered with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .words import slices

# White_Space of Unicode, as tokenizer libraries take \s
WS = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CHUNK = re.compile(f"[{WS}]*[^{WS}]+|[{WS}]+")
SLICE_BYTES = 1 << 20
STRETCH_BYTES = 5 << 20
MAX_CACHED = 150_000


class Index(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class ChunkTable:
    """``learn(chunks)`` returns the values of all chunks in a row and their offsets; they are kept up to MAX_CACHED chunks."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], split: Callable[[str], list[str]] = CHUNK.findall):
        self.learn, self.split = learn, split
        self._clear()

    def _clear(self) -> None:
        self.index = Index()
        self.values, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def look_up(self, texts: list[str]) -> list[np.ndarray]:
        """Chunk numbers of each text; new chunks get numbers and wait for ``settle``."""
        at = self.index.__getitem__
        return [np.fromiter(map(at, self.split(t)), dtype=np.int32) for t in texts]

    def settle(self) -> None:
        known = len(self.first) - 1
        if len(self.index) > known:
            new = list(self.index)[known:]
            values, first = self.learn(new)
            self.first = np.concatenate([self.first, first[1:] + self.first[-1]])
            self.values = np.concatenate([self.values, values.astype(np.int32)])

    def forget(self) -> None:
        """Start anew once there are many chunks; numbers given out before are void then."""
        if len(self.index) > MAX_CACHED:
            self._clear()

    def gather(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Values of the texts in a row, and each text's offset in them."""
        idx = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        size = self.first[idx + 1] - self.first[idx]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        values = self.values[np.repeat(self.first[idx] - end + size, size) + np.arange(total)]
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return values, np.concatenate([[0], end])[ends]

    def encode_batches(self, batches, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """``(batch, values, offsets)`` for slices of the batches; memory is bounded by a stretch of texts."""
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        size = 0

        def out():
            self.settle()
            for batch, numbers in held:
                yield batch, *self.gather(numbers)
            held.clear()
            self.forget()

        for batch in slices(batches, column, SLICE_BYTES):
            held.append((batch, self.look_up([t or "" for t in batch.column(column).to_pylist()])))
            size += batch.column(column).nbytes
            if size >= STRETCH_BYTES:
                yield from out()
                size = 0
        yield from out()
