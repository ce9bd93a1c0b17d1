"""SimHash near-duplicate groups by a byte-position inverted index (operator 11).

A document's fingerprint has 64 bits: bit b is set if bit b is set in over half
of the XXH64 values of its word shingles, repeats counted.  Two fingerprints
link if they differ in at most ``MAX_BITS`` = 2 bits.  The steps:

1. One pass over the texts gives the fingerprints; equal ones form a class.
2. Two differing bits lie in two bytes at most, so linked fingerprints agree in
   at least ``MIN_BYTES`` = 6 of their 8 byte positions.  That is the guaranteed
   minimum of the count filter.  A list for each single positional byte would
   hold 1/256 of all classes, and its pairs would grow with their square, so the
   index's terms are all choices of six byte positions together with their bytes
   (28 lists for each class).  Two classes that share s positional bytes meet in
   C(s, 6) lists: in none if their tally is below the minimum.
3. The members of a list differ in two bytes only, so a list holds at most
   65,536 classes, whatever the corpus.  In it the shared bytes of a pair are
   tallied over all 8 positions and the differing bits counted; a long list is
   looked up by differing bits instead of pair by pair.  A list gives one link
   for each member that joins another (a spanning forest), never all pairs.
4. Components come from alternating large-star and small-star.

Nothing is gathered by key but the bounded lists; a class that a third of all
documents share is one row.

Defined cases: null text is empty; a text without words has fingerprint zero and
is linked like any other; fewer words than a shingle count as one shingle; rows
with a null doc_id have a fingerprint, component null, and link nothing; rows
that repeat a doc_id are each returned and do not link their texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, salted_join, ship
from .words import slices

SEED = 42
MAX_BITS = 2
BYTES = 8
MIN_BYTES = BYTES - MAX_BITS
PIECE = 1 << 20
# beyond this many members the partners of a member are looked up, not compared
LONG_LIST = 64

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in runs from about ``size`` bytes each."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + size)
        end = gap.start() if gap else len(data)
        yield data[at:end].split()
        at = end


def shingle_hashes(text: str | None, size: int = 3) -> Iterator[np.ndarray]:
    """XXH64 of the text's word shingles (A-Z lowered), repeats included."""
    held: list[bytes] = []
    none_yet = True
    for words in word_lists((text or "").encode().lower()):
        held += words
        n = len(held) - size + 1
        if n > 0:
            shingles = map(b" ".join, zip(*(held[k : k + n] for k in range(size))))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
            held, none_yet = held[n:], False
    if none_yet and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(hashes: Iterator[np.ndarray]) -> int:
    """The majority bits of all hashes, as a signed 64-bit number."""
    total, ones = 0, np.zeros(64, np.int64)
    for part in hashes:
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, fp long)`` for every row of ``docs(doc_id, text)``."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in slices(batches, "text"):
            made = [fingerprint(shingle_hashes(t.as_py(), size)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _terms() -> list[int]:
    """Bit masks of every choice of MIN_BYTES byte positions, as signed numbers."""
    masks = [sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(BYTES), MIN_BYTES)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _spread(free: np.ndarray, mask: int) -> np.ndarray:
    """16-bit patterns laid over the two byte positions that the mask leaves out."""
    low, high = [8 * p for p in range(BYTES) if not mask >> 8 * p & 0xFF]
    free = free.astype(np.uint64)
    return (free & np.uint64(0xFF)) << np.uint64(low) | (free >> np.uint64(8)) << np.uint64(high)


_NEAR = np.array([1 << i for i in range(16)] + [1 << i | 1 << j for i, j in combinations(range(16), 2)], np.uint16)


def list_pairs(fps: np.ndarray, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked pairs among the distinct fingerprints of one list (which agree in the bytes of the mask)."""
    order = np.argsort(fps)
    fps = fps[order]
    if len(fps) <= LONG_LIST:
        i, j = np.triu_indices(len(fps), 1)
        differing = fps[i] ^ fps[j]
        shared = (differing.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        ok = (shared >= MIN_BYTES) & (np.bitwise_count(differing) <= MAX_BITS)
        return order[i[ok]], order[j[ok]]
    # the mask's bytes are shared by all, so a partner is one of 136 patterns away in the two others
    left, right = [], []
    for pattern in _spread(_NEAR, mask):
        wanted = fps ^ pattern
        at = np.minimum(np.searchsorted(fps, wanted), len(fps) - 1)
        ok = (fps[at] == wanted) & (fps < wanted)
        left.append(order[np.flatnonzero(ok)])
        right.append(order[at[ok]])
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places, the least place that the pairs connect it with."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        # only roots move, so what was joined stays joined
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def links(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of ``classes(fp)`` (distinct) within MAX_BITS."""
    masks = _terms()

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            cuts = _cuts(table)
            yield found(table, cuts[:-1])
            held = table.slice(int(cuts[-2]))
        if held is not None:
            yield found(held, _cuts(held))

    def _cuts(table: pa.Table) -> np.ndarray:
        term, shared = table.column("term").to_numpy(), table.column("shared").to_numpy()
        new = (term[1:] != term[:-1]) | (shared[1:] != shared[:-1])
        return np.concatenate([[0], np.flatnonzero(new) + 1, [len(term)]])

    def found(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        fps, term = table.column("fp").to_numpy(), table.column("term").to_numpy()
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in np.flatnonzero(np.diff(cuts) > 1):
            one = fps[cuts[k] : cuts[k + 1]]
            root = forest(len(one), *list_pairs(one.view(np.uint64), masks[term[cuts[k]]]))
            joined = np.flatnonzero(root != np.arange(len(one)))
            left.append(one[joined])
            right.append(one[root[joined]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    term = F.explode(F.array(*[F.struct(F.lit(k).alias("term"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("shared")) for k, m in enumerate(masks)]))
    postings = classes.select("fp", term.alias("t")).select("t.term", "t.shared", "fp")
    lists = postings.repartition("term", "shared").sortWithinPartitions("term", "shared")
    return lists.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    component_id is the smallest doc_id reachable by links of fingerprints that
    differ in at most MAX_BITS bits.
    """
    with Scratch(docs.sparkSession, "simhash") as s:
        prints = s.stash(fingerprints(docs, size), "prints")
        classes = s.stash(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
        comps = connected_components(s.stash(links(classes.select("fp")), "links"), s)
        found = s.stash(
            classes.join(comps, classes["fp"] == comps["node"], "left")
            .select("fp", "least", F.coalesce("component", "fp").alias("component")), "found")
        least = found.groupBy("component").agg(F.min("least").alias("component_id"))
        named = salted_join(found.select("fp", "component"), least, ["component"], F.hash("fp")).select("fp", "component_id")
        out = salted_join(prints, named, ["fp"], F.hash("doc_id"), how="left").select(
            "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
            F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
        return s.stash(out, "result", keep=True)
