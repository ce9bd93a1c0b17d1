"""Alignment of two tokenizers over the same bytes (operator 12).

Tokens of A (byte-level BPE) and B (sentencepiece) of a text cover the same
bytes.  Where tokens of both end, the text is cut; what lies between two cuts is
a group, and every A token of a group is linked with every B token of it.

Divide and conquer at shared cuts: from the middle A token outwards, each end is
looked up among the ends of B by bisection until one is common; both halves are
worked on in the same way.  An interval without a common end is a leaf: one group.
All intervals of a stretch are divided together with numpy.

Some places (``CUT``) are shared cuts whatever stands around them: A's pattern
begins a piece there, and no piece of B's vocabulary reaches over one, so neither
could a merge.  Each distinct chunk between them is encoded and aligned once, and
kept for the further texts of a task (up to ``MAX_KEPT`` chunks).

How many documents hold a pair of ids linked is counted over all documents:

1. One pass writes, per stretch (about 5 MB of texts, one task's work), the
   distinct pairs with the number of its documents that hold them, and per
   document its numbers and its pairs as places in that list (4-byte numbers).
2. Counts are summed per pair, and the highest count of each A id taken (partial
   aggregates: a pair costs one row for each stretch, however frequent it is).
3. Each stretch's list gets the counts by a join of two written tables (adaptive
   execution can split a pair that very many stretches hold), and meets its
   documents again in one sorted pass, list first.

Memory is bounded by a stretch; nothing is broadcast but the vocabularies.

Defined cases: texts that are null or empty, or whose joined A or B bytes differ
from space + text (say, one that holds U+2581), have no tokens: zeros, '' as
groups, and no part in the counts; rows that repeat are documents of their own;
a null doc_id is returned as null.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .chunks import Index
from .shared import Scratch
from .token_store import _byte_letters
from .words import slices

STRETCH_BYTES = 5 << 20
MARK = "▁"
MAX_KEPT = 300_000
SLICE = 16_384
# where tokens of both end whatever stands around: before a space after a sure character, before a
# mark after an ASCII letter, before a letter after a lone line feed that follows a sure character
_CUT = r"(?<=[\w!-~])(?= )|(?<=[A-Za-z])(?=[,.;:!?])|(?<=[\w!-~]\n)(?=[^\W\d_])"
CUT = re.compile(_CUT)
CHUNK = re.compile(rf" *[A-Za-z]+(?=[ ,.;:!?]|\Z)|.+?(?:{_CUT}|\Z)", re.S)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Groups as rows ``(a_from, a_to, b_from, b_to)`` of token places, in order.

    ``a_ends`` and ``b_ends`` are the ascending end offsets of all tokens.  The
    intervals ``a0:a1`` / ``b0:b1`` each end at the same offset on both sides;
    all of them are divided at the same time, one try a round.
    """
    groups = [np.zeros((0, 4), np.int64)]
    todo = np.stack([a0, a1, b0, b1], axis=1).astype(np.int64)
    step = np.zeros(len(todo), np.int64)
    while len(todo):
        a0, a1, b0, b1 = todo.T
        middle = (a0 + a1 - 1) // 2
        hit = np.zeros(len(todo), bool)
        cut_a, cut_b = np.zeros(len(todo), np.int64), np.zeros(len(todo), np.int64)
        # ends strictly inside the interval, from the middle outwards, each looked up among the other side's ends
        for i in (middle - step, middle + step):
            k = np.flatnonzero(~hit & (i >= a0) & (i < a1 - 1))
            j = np.searchsorted(b_ends, a_ends[i[k]])
            met = (j < b1[k] - 1) & (b_ends[np.minimum(j, len(b_ends) - 1)] == a_ends[i[k]])
            k, j = k[met], j[met]
            hit[k], cut_a[k], cut_b[k] = True, i[k] + 1, j + 1
        leaf = ~hit & (middle - step <= a0) & (middle + step >= a1 - 2)
        groups.append(todo[leaf])
        left = np.stack([a0, cut_a, b0, cut_b], axis=1)[hit]
        right = np.stack([cut_a, a1, cut_b, b1], axis=1)[hit]
        again = ~hit & ~leaf
        todo = np.concatenate([todo[again], left, right])
        step = np.concatenate([step[again] + 1, np.zeros(2 * len(left), np.int64)])
    out = np.concatenate(groups)
    return out[np.argsort(out[:, 0], kind="stable")]


class TokenizerPair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_definition: str, b_model: bytes):
        # one thread: Spark deals the work
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_definition)
        self.a.encode_special_tokens = True
        byte = {c: b for b, c in enumerate(_byte_letters())}
        self.a_bytes = {}
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        crossing = [p for p in self.b_bytes if b"\n" in p[1:] or CUT.search(p.decode(errors="replace"))]
        if crossing:
            raise ValueError(f"pieces that reach over a cut between words are not supported: {crossing[:3]}")
        self.space, self.feed = self.b.piece_to_id(MARK), self.b.encode("\n")
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)], np.int64)
        self.b_size = np.array([len(p) for p in self.b_bytes], np.int64)

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for chunks.

        B puts a space in front of what it encodes: it stands for the first space
        of a chunk, or goes with a line feed, which nothing joins, before any other.
        """
        a, b = [], []
        for at in range(0, len(chunks), SLICE):
            part = chunks[at : at + SLICE]
            a += [e.ids for e in self.a.encode_batch_fast(part, add_special_tokens=False)]
            ids = self.b.encode([c[1:] if c[0] == " " else "\n" + c for c in part], num_threads=1)
            b += [([self.space] if c == " " else y) if c[0] == " " else y[len(self.feed) :] for c, y in zip(part, ids)]
        return a, b


def _offsets(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _parts(first: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places ``first[k]:first[k + 1]`` of all k in ``which``, in a row."""
    n = first[which + 1] - first[which]
    return np.repeat(first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())


class Aligned:
    """Distinct chunks, new ones aligned together by ``settle``.

    ``sizes`` has a chunk's numbers of A tokens, B tokens, groups and links,
    ``links[link_first[k]:link_first[k + 1]]`` its linked pairs as ``a << 32 | b``,
    repeats included, and ``groups`` its groups as text.  A chunk whose tokens
    have other bytes than itself is not ``valid``.
    """

    def __init__(self, tokenizers: TokenizerPair):
        self.tokenizers = tokenizers
        self.number = Index()
        self.valid, self.sizes = np.zeros(0, bool), np.zeros((0, 4), np.int64)
        self.links, self.link_first = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.groups: list[str] = []

    def settle(self) -> None:
        chunks = list(islice(self.number, len(self.groups), None))
        if not chunks:
            return
        valid, sizes, links, groups = align_chunks(self.tokenizers, chunks)
        self.valid, self.sizes = np.concatenate([self.valid, valid]), np.concatenate([self.sizes, sizes])
        self.links = np.concatenate([self.links, links])
        self.link_first = _offsets(self.sizes[:, 3])
        self.groups += groups


def align_chunks(tokenizers: TokenizerPair, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """``valid``, ``sizes``, ``links`` and ``groups`` of chunks."""
    n = len(chunks)
    a, b = tokenizers.encode(chunks)
    a_first, b_first = _offsets(list(map(len, a))), _offsets(list(map(len, b)))
    a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(f[-1])) for x, f in ((a, a_first), (b, b_first)))
    a_size, b_size = tokenizers.a_size[a], tokenizers.b_size[b]
    data = [c.encode() for c in chunks]
    size = np.fromiter(map(len, data), np.int64, n)
    valid = (np.diff(_offsets(a_size)[a_first]) == size) & (np.diff(_offsets(b_size)[b_first]) == size)
    # of chunks whose length is right, the bytes themselves
    ok = np.flatnonzero(valid)
    whole = np.frombuffer(b"".join(map(data.__getitem__, ok.tolist())), np.uint8)
    end = _offsets(size[ok])
    for ids, first, table in ((a, a_first, tokenizers.a_bytes), (b, b_first, tokenizers.b_bytes)):
        joined = np.frombuffer(b"".join(map(table.__getitem__, ids[_parts(first, ok)].tolist())), np.uint8)
        wrong = np.flatnonzero(joined != whole)
        valid[ok[np.searchsorted(end, wrong, side="right") - 1]] = False
    ok = np.flatnonzero(valid)
    mine_a, mine_b = _parts(a_first, ok), _parts(b_first, ok)
    a, b = a[mine_a], b[mine_b]
    n_a, n_b = np.diff(a_first)[ok], np.diff(b_first)[ok]
    a_at, b_at = _offsets(n_a), _offsets(n_b)
    cut = shared_cuts(np.cumsum(a_size[mine_a]), np.cumsum(b_size[mine_b]), a_at[:-1], a_at[1:], b_at[:-1], b_at[1:])
    a0, a1, b0, b1 = cut.T
    n_links = (a1 - a0) * (b1 - b0)
    link = np.arange(n_links.sum()) - np.repeat(_offsets(n_links)[:-1], n_links)
    wide = np.repeat(b1 - b0, n_links)
    links = a[np.repeat(a0, n_links) + link // wide] << 32 | b[np.repeat(b0, n_links) + link % wide]
    first = np.append(np.searchsorted(a0, a_at[:-1]), len(cut))
    sizes = np.zeros((n, 4), np.int64)
    sizes[ok] = np.stack([n_a, n_b, np.diff(first), np.diff(_offsets(n_links)[first])], axis=1)
    x, y = list(map(str, a.tolist())), list(map(str, b.tolist()))
    text = [f"{x[p]}|{y[r]}" if q - p == 1 == t - r else ",".join(x[p:q]) + "|" + ",".join(y[r:t]) for p, q, r, t in cut.tolist()]
    groups, bounds = [""] * n, first.tolist()
    for k, lo, hi in zip(ok.tolist(), bounds, bounds[1:]):
        groups[k] = ";".join(text[lo:hi])
    return valid, sizes, links, groups


FIRST = "stretch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, place binary, times binary, pairs array<long>, docs array<int>"
_FIRST_TYPES = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
_FIRST_NAMES = [c.split()[0] for c in FIRST.split(", ")]


def _stretch_rows(number: int, table: Aligned, held: list[tuple[list, list[np.ndarray]]], as_digest: bool):
    """Rows of one stretch: its documents (ids, and the chunks of each), then its list of pairs."""
    table.settle()
    valid, sizes = table.valid, table.sizes
    seen = np.zeros(len(valid), bool)
    for _, numbers in held:
        for idx in numbers:
            seen[idx] = True
    # the stretch's pairs, and its chunks' links as places among them
    used = np.flatnonzero(seen)
    n_links = np.zeros(len(valid), np.int64)
    n_links[used] = sizes[used, 3]
    link_first = _offsets(n_links)
    pairs, place = np.unique(table.links[_parts(table.link_first, used)], return_inverse=True)
    docs = np.zeros(len(pairs), np.int32)
    for ids, numbers in held:
        columns: list[list] = [[] for _ in range(9)]
        for doc, idx in zip(ids, numbers):
            if not len(idx) or not valid[idx].all():
                for c, v in zip(columns, (number, doc, 0, 0, 0, 0, "", b"", b"")):
                    c.append(v)
                continue
            links = place[_parts(link_first, idx)]
            if len(links) * 8 < len(pairs):
                own, times = np.unique(links, return_counts=True)
            else:
                times = np.bincount(links, minlength=len(pairs))
                own = np.flatnonzero(times)
                times = times[own]
            docs[own] += 1
            groups = ";".join(map(table.groups.__getitem__, idx.tolist()))
            row = (number, doc, *sizes[idx].sum(axis=0).tolist(), hashlib.sha256(groups.encode()).hexdigest() if as_digest else groups, own.astype("<i4").tobytes(), times.astype("<i4").tobytes())
            for c, v in zip(columns, row):
                c.append(v)
        none = pa.nulls(len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FIRST_TYPES)] + [none.cast(t) for t in _FIRST_TYPES[9:]], names=_FIRST_NAMES)
    # pairs of chunks that only invalid texts hold keep their place, with no documents
    row = [[number], *([None] for _ in range(8)), [pairs], [docs]]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, _FIRST_TYPES)], names=_FIRST_NAMES)


def _first_pass(docs: DataFrame, a_path: str, b_path: str, as_digest: bool) -> DataFrame:
    with open(a_path, encoding="utf-8") as f:
        a_definition = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    vocabularies = docs.sparkSession.sparkContext.broadcast((a_definition, b_model))

    def run(batches):
        tokenizers = TokenizerPair(*vocabularies.value)
        table = Aligned(tokenizers)
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in slices(batches, "text"):
            at = table.number.__getitem__
            texts = batch.column("text").to_pylist()
            held.append((batch.column("doc_id").to_pylist(), [np.array(list(map(at, CHUNK.findall(" " + t))) if t else (), np.int32) for t in texts]))
            size += batch.column("text").nbytes
            if size >= STRETCH_BYTES:
                yield from _stretch_rows(number, table, held, as_digest)
                number, held, size = number + 1, [], 0
                if len(table.groups) > MAX_KEPT:
                    table = Aligned(tokenizers)
        if held:
            yield from _stretch_rows(number, table, held, as_digest)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, FIRST)


OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_OUT_NAMES = [c.split()[0] for c in OUT.split(", ")]


def _look_up(rows: DataFrame) -> DataFrame:
    """Sum each document's links over its stretch's list; rows come by stretch, the list (by place) before the documents."""

    def run(batches):
        stretch, counts, best, ready = None, [], [], None
        for batch in batches:
            at = batch.column("stretch").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]]) if len(at) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if at[lo] != stretch:
                    stretch, counts, best, ready = at[lo], [], [], None
                part = batch.slice(lo, hi - lo)
                n_list = int((part.column("kind").to_numpy() == 0).sum())
                if n_list:
                    counts.append(part.column("count").to_numpy(zero_copy_only=False)[:n_list].astype(np.int64))
                    best.append(part.column("is_best").to_numpy(zero_copy_only=False)[:n_list].astype(bool))
                docs = part.slice(n_list)
                if not docs.num_rows:
                    continue
                if ready is None:
                    ready = (np.concatenate(counts), np.concatenate(best)) if counts else (np.zeros(0, np.int64), np.zeros(0, bool))
                n_best, total = [], []
                for place, times in zip(docs.column("place"), docs.column("times")):
                    place, times = (np.frombuffer(x.as_buffer(), "<i4") for x in (place, times))
                    n_best.append(int(times[ready[1][place]].sum(dtype=np.int64)))
                    total.append(int(times @ ready[0][place]))
                made = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else docs.column(c) for c in _OUT_NAMES], names=_OUT_NAMES)

    return rows.mapInArrow(run, OUT)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, as_digest: bool = False) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row of ``docs(doc_id, text)``.

    ``groups`` lists a text's groups as ``a1,a2|b1;a3|b2,b3`` (ids of A and B);
    with ``as_digest`` its SHA-256 instead, so that it need not be moved.  A link's
    count is the number of documents that hold its pair of ids linked; count_sum
    adds it up over the links, and n_best counts the links whose count is the
    highest of their A id.
    """
    a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    with Scratch(docs.sparkSession, "alignment") as s:
        first = s.stash(_first_pass(docs, a_path, b_path, as_digest), "stretches")
        lists = first.where("pairs is not null").select("stretch", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p")).select("stretch", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
        a_id = F.shiftright("pair", 32)
        counts = s.stash(lists.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", a_id), "counts")
        highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
        # an A id has at most as many pairs as B has ids
        ranked = s.stash(counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("is_best")), "ranked")
        counted = lists.select("stretch", "at", "pair").join(ranked, "pair")
        none = F.lit(None)
        numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "place", "times"]
        listed = counted.select("stretch", F.lit(0).alias("kind"), "at", "count", "is_best", *[none.cast(first.schema[c].dataType).alias(c) for c in numbers])
        documents = first.where("pairs is null").select("stretch", F.lit(1).alias("kind"), F.lit(0).alias("at"), none.cast("long").alias("count"), none.cast("boolean").alias("is_best"), *numbers)
        met = listed.unionByName(documents).repartition("stretch").sortWithinPartitions("stretch", "kind", "at")
        return s.stash(_look_up(met), "result", keep=True)
