"""Byte-level BPE by corpus-level merge replay, and decoding (operator 5).

A text is cut into pieces by the tokenizer's pattern.  The distinct new pieces
of a stretch of documents form one corpus of byte symbols.  An inverted index
leads from each merge to the positions where its pair stands; merges are taken
in rank order from a heap, applied to all their positions at once with numpy,
and only the pairs of the touched neighbours are looked up and indexed anew.
Every distinct piece is encoded once per stretch and task; documents are then
put together from a dictionary of chunks.

Ranks follow the rank-file rule: of all neighbouring pairs of a piece whose
joined bytes are a token, the one of least rank is merged, the leftmost first.

Defined cases: null text is empty and has no ids; any valid string decodes to
its own bytes.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import WS, ChunkTable, Index
from .shared import ship

def piece_pattern(pattern: str) -> "regex.Pattern":
    """The tokenizer's pattern with \\s and \\S spelled out."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{WS}").replace(r"\s", f"[{WS}]").replace(r"\S", f"[^{WS}]"))


class Ranks:
    """Tokens by rank, and every pair of tokens whose joined bytes are a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = [b""] * (max(rank.values()) + 1)
        keys, merged, unruly = [], [], set()
        for t, r in rank.items():
            self.token[r] = t
            for cut in range(1, len(t)):
                a, b = rank.get(t[:cut]), rank.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    merged.append(r)
                # merging x may make a pair of lower rank than x: such x go one position a piece at a time
                unruly.update(x for x in (a, b) if x is not None and x > r)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self.unruly = unruly
        self.byte = np.array([rank[bytes([b])] for b in range(256)], dtype=np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 if none."""
        key = a.astype(np.int64) << 20 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], -1)


def _distinct(at: np.ndarray) -> np.ndarray:
    at = np.sort(at)
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) > 1 else at


def replay(pieces: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in a row, and the offset of each piece in them."""
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    size = np.array([len(p) for p in pieces], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    n = len(data)
    sym = ranks.byte[data].astype(np.int32)
    word = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
    nxt = np.arange(1, n + 1, dtype=np.int32)
    nxt[first[1:][size > 0] - 1] = -1
    prv = np.arange(-1, n - 1, dtype=np.int32)
    prv[first[:-1][size > 0]] = -1
    alive = np.ones(n, dtype=bool)
    # rank of the pair that starts at each position
    pair = np.full(n, -1, dtype=np.int32)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def look_up(at: np.ndarray) -> None:
        """Find and index the pairs that start at these positions."""
        right = nxt[at]
        r = np.where(right >= 0, ranks.join(sym[at], sym[right]), -1)
        pair[at] = r
        at, r = at[r >= 0], r[r >= 0]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = [0, *(np.flatnonzero(r[1:] != r[:-1]) + 1).tolist(), len(r)]
        else:
            cuts = [0, 1]
        for a, b in zip(cuts, cuts[1:]):
            k = int(r[a])
            if k not in index:
                index[k] = []
                heapq.heappush(heap, k)
            index[k].append(at[a:b])

    if n:
        look_up(np.flatnonzero(nxt >= 0))
    while heap:
        r = heapq.heappop(heap)
        places = index.pop(r)
        at = places[0] if len(places) == 1 else np.concatenate(places)
        at = at[alive[at] & (pair[at] == r)]
        if not len(at):
            continue
        if len(at) > 1:
            at = _distinct(at)
            if r in ranks.unruly:
                lead = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                if not lead.all():
                    index[r] = [at[~lead]]
                    heapq.heappush(heap, r)
                    at = at[lead]
            else:
                # in a run of overlapping pairs every second one is taken, from the left
                joined = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
                if joined.any():
                    begin = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                    at = at[(np.arange(len(at)) - begin) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = r
        alive[gone] = False
        pair[gone] = -1
        nxt[at] = after
        prv[after[after >= 0]] = at[after >= 0]
        before = prv[at]
        touched = np.concatenate([at, before[before >= 0]])
        look_up(_distinct(touched))
    ids = sym[alive]
    return ids, np.concatenate([[0], np.cumsum(np.bincount(word[alive], minlength=len(pieces)))]) if len(pieces) else np.zeros(1, np.int64)


class Encoder:
    """Ids of chunks: cut into the pattern's pieces, and distinct pieces encoded as one corpus."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks = ranks
        self.pieces_of = piece_pattern(pattern).findall

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        number = Index()
        cut = [np.fromiter(map(number.__getitem__, self.pieces_of(c)), dtype=np.int64) for c in chunks]
        ids, first = replay([p.encode() for p in number], self.ranks)
        at = np.concatenate(cut) if cut else np.zeros(0, np.int64)
        size = first[at + 1] - first[at]
        end = np.cumsum(size)
        values = ids[np.repeat(first[at] - end + size, size) + np.arange(int(size.sum()))]
        pieces = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        return values, np.concatenate([[0], end])[pieces]


def encode_batches(batches, ranks: Ranks, pattern: str):
    """``(batch, ids, offsets)`` for Arrow batches with a column ``text``, inside a task."""
    return ChunkTable(Encoder(ranks, pattern)).encode_batches(batches)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids array<int>)`` for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(Ranks(ranks_path))

    def run(batches):
        for batch, ids, first in encode_batches(batches, held.value, pattern):
            made = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


class Decoder:
    """Bytes of ids, by a rank file or ranks that are loaded already."""

    def __init__(self, ranks: str | Ranks):
        self.token = (Ranks(ranks) if isinstance(ranks, str) else ranks).token

    def __call__(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def id_lists(column: pa.ListArray):
    """Each row's ids as a list, one row at a time; a null row has none."""
    values, at = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(at[:-1], at[1:]):
        yield values[a:b].tolist()


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with a binary column ``decoded``: the bytes that the ids stand for."""
    ship(encoded.sparkSession)
    held = encoded.sparkSession.sparkContext.broadcast(Decoder(ranks_path))

    def run(batches):
        for batch in batches:
            made = [held.value(ids) for ids in id_lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.large_binary()).cast(pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes) + ", decoded binary")
