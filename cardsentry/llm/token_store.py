"""Token ids in wavelet-matrix shards (operator 8).

Documents are range-partitioned by doc_id, encoded, and written as shards of
whole documents.  A shard is one binary value that stands for itself:

    magic "WMX1" | n ids, n documents, bits (3 x u64) | zeros per plane (u64)
    | doc_id null flags (u8) | doc_ids (i64) | document starts (i64)
    | per plane: rank directory (u32 per 512 bits) | bit plane

Plane k holds bit ``bits - 1 - k`` of every id, in the order that the planes
before left: zeros first, stable.  Rank on the planes gives access, counting and
the places of any id without unpacking the shard.  The shards are rows of a
Parquet table (Spark's commit protocol makes the write safe against lost
executors); its column ``first_doc`` orders them.

The definition's added tokens, quoted in a text, get their ids with
``added_tokens``, as by the library's plain call; without it they are read as
ordinary text (the library's ``encode_special_tokens``).

Defined cases: null text is empty and still gets the end id; null doc_ids come
first; rows that repeat a doc_id are ordered by text; an empty table makes an
empty store.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .chunks import SLICE_BYTES, STRETCH_BYTES, WS
from .shared import ship
from .words import slices

MAGIC = b"WMX1"
SHARD_IDS = 1 << 20
BLOCK = 512


class WaveletMatrix:
    """Succinct sequence of ids: bit planes with a rank directory."""

    def __init__(self, n: int, zeros: np.ndarray, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, ranks = [], [], []
        for level in range(bits - 1, -1, -1):
            one = (cur & cur.dtype.type(1 << level)) != 0
            planes.append(np.packbits(one))
            padded = np.zeros(-(-len(one) // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(planes[-1])] = planes[-1]
            per_block = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32))
            # gathering by places costs the same for all planes; by mask, evenly mixed bits cost thrice that
            low = cur.take(np.flatnonzero(~one))
            zeros.append(len(low))
            cur = np.concatenate([low, cur.take(np.flatnonzero(one))])
        return cls(len(ids), np.array(zeros, np.uint64), planes, ranks)

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        """Number of ones of plane k before each position."""
        at = np.asarray(at, dtype=np.int64)
        block, rest = at // BLOCK, at % BLOCK
        total = self.ranks[k][block].astype(np.int64)
        plane = self.planes[k]
        # whole bytes after the directory's block, then the bits of the last one
        byte = block * (BLOCK // 8)
        for j in range(BLOCK // 8):
            inside = (rest >= 8 * (j + 1)).nonzero()[0]
            if not len(inside):
                break
            total[inside] += np.bitwise_count(plane[byte[inside] + j])
        tail = rest % 8
        some = tail.nonzero()[0]
        total[some] += np.bitwise_count(plane[at[some] // 8] >> (8 - tail[some]).astype(np.uint8))
        return total

    def access(self, at) -> np.ndarray:
        """Ids at the positions."""
        at = np.atleast_1d(np.asarray(at, dtype=np.int64))
        out = np.zeros(len(at), np.int64)
        for k, plane in enumerate(self.planes):
            bit = (plane[at // 8] >> (7 - at % 8).astype(np.uint8)) & 1
            ones = self._ones(k, at)
            out = out << 1 | bit
            at = np.where(bit == 1, int(self.zeros[k]) + ones, at - ones)
        return out

    def _range(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        if symbol < 0 or symbol.bit_length() > len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, b = self._ones(k, np.array([lo, hi])).tolist()
            if symbol >> (len(self.planes) - 1 - k) & 1:
                lo, hi = int(self.zeros[k]) + a, int(self.zeros[k]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in positions lo to hi."""
        a, b = self._range(symbol, lo, self.n if hi is None else hi)
        return b - a

    def places(self, symbol: int) -> np.ndarray:
        """All positions of an id, ascending: select, plane by plane from the last."""
        lo, hi = self._range(symbol, 0, self.n)
        at = np.arange(lo, hi)
        for k in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            if symbol >> (len(self.planes) - 1 - k) & 1:
                at = np.flatnonzero(bits)[at - int(self.zeros[k])]
            else:
                at = np.flatnonzero(~bits)[at]
        return np.sort(at)

    def ids(self) -> np.ndarray:
        """The whole sequence: planes undone from the last to the first."""
        cur = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for k in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n).view(bool)
            up = np.empty_like(cur)
            zeros = int(self.zeros[k])
            up[~one] = cur[:zeros]
            up[one] = cur[zeros:] | (1 << (len(self.planes) - 1 - k))
            cur = up
        return cur


def pack_shard(doc_ids: list, starts: np.ndarray, ids: np.ndarray) -> bytes:
    matrix = WaveletMatrix.build(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    docs = np.array([0 if d is None else d for d in doc_ids], np.int64)
    parts = [MAGIC, struct.pack("<3Q", len(ids), len(doc_ids), len(matrix.planes)), matrix.zeros.tobytes(), null.tobytes(), docs.tobytes(), starts.astype(np.int64).tobytes()]
    for plane, rank in zip(matrix.planes, matrix.ranks):
        parts += [rank.tobytes(), plane.tobytes()]
    return b"".join(parts)


def open_shard(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Document ids, their starts in the shard, and the matrix."""
    if data[:4] != MAGIC:
        raise ValueError("not a wavelet-matrix shard")
    n, docs, bits = struct.unpack_from("<3Q", data, 4)
    at = 28

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    zeros, null, ids, starts = take(np.uint64, bits), take(np.uint8, docs), take(np.int64, docs), take(np.int64, docs)
    planes, ranks = [], []
    for _ in range(bits):
        ranks.append(take(np.uint32, -(-n // BLOCK) + 1))
        planes.append(take(np.uint8, -(-n // 8)))
    return [None if x else int(d) for x, d in zip(null, ids)], starts, WaveletMatrix(n, zeros, planes, ranks)


# the piece pattern of this vocabulary's pre-tokenizer, for words without white space
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
# most words: letters, and marks behind them; these are their pieces
_LETTERS_MARKS = r"^(?P<letters>\p{L}+)(?P<marks>[!-/:-@\[-`{-~]*)$"
# most words that the normaliser leaves alone: ASCII (A-Z is lowered before) and the small letters of Latin-1
_LEFT_ALONE = "^[\\x00-\\x7f\u00df-\u00f6\u00f8-\u00ff]*$"
_WORDS = re.compile(f"[^{WS}]+")
# separators of str.split() that are not White_Space
_ODD = re.compile("[\x1c-\x1f]")


def words_of(text: str) -> list[str]:
    """Words at white space, A-Z lowered (the vocabulary is lower case)."""
    text = text.encode().lower().decode()
    return _WORDS.findall(text) if _ODD.search(text) else text.split()


def _byte_letters() -> list[str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    for n, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + n)
    return out


def gather(values: np.ndarray, first: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the numbered rows one after the other, and the offset of each in them; row ``i`` is ``values[first[i]:first[i + 1]]``."""
    size = first[idx + 1] - first[idx]
    out = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(first[idx] - out[:-1], size) + np.arange(out[-1])], out


class Pieces:
    """Ids of pieces, each new one by the library's BPE model; up to MAX_KEPT pieces are kept.

    New pieces go to the library many at a time, as a text with spaces between
    them; the vocabulary's end-of-word mark shows where a piece's ids end.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        # the space parts pieces and is itself
        letters = _byte_letters()
        self.letters = "".join([*letters[:32], " ", *letters[33:]])
        mark, tokens = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[i for t, i in tokens.items() if mark and t.endswith(mark)]] = True
        # the empty piece has no ids
        self.known, self.values, self.first = pa.array([""], pa.string()), np.zeros(0, np.int32), np.zeros(2, np.int64)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        def ids_of(step: int) -> list[list[int]]:
            texts = [" ".join(pieces[i : i + step]) for i in range(0, len(pieces), step)]
            texts = [t if t.isascii() and t.isprintable() else codecs.charmap_decode(t.encode(), "strict", self.letters)[0] for t in texts]
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        values = np.fromiter(chain.from_iterable(ids_of(PIECES_A_TEXT)), np.int32)
        first = np.concatenate([[0], np.flatnonzero(self.ends[values]) + 1])
        if len(first) != len(pieces) + 1 or first[-1] != len(values):
            # a vocabulary that does not mark every end
            single = ids_of(1)
            values, first = np.fromiter(chain.from_iterable(single), np.int32), np.concatenate([[0], np.cumsum([len(x) for x in single], dtype=np.int64)])
        return values, first

    def __call__(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces in a row, and the offset of each piece in them."""
        at = pc.index_in(pieces, value_set=self.known)
        fresh = pieces.filter(at.is_null())
        values, first = self._encode(fresh.to_pylist())
        at = at.to_numpy(zero_copy_only=False)
        new = np.isnan(at) if at.dtype.kind == "f" else np.zeros(len(at), bool)
        idx = np.where(new, len(self.known) - 1 + np.cumsum(new), at).astype(np.int64)
        values, first = np.concatenate([self.values, values]), np.concatenate([self.first, first[1:] + self.first[-1]])
        room = min(MAX_KEPT - len(self.known), len(fresh))
        if room > 0:
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.first = first[: len(self.known) + 1]
            self.values = values[: self.first[-1]]
        return gather(values, first, idx)


MAX_KEPT = 400_000
PIECES_A_TEXT = 60


class WordEncoder:
    """Ids of words by the tokenizer library, each distinct piece once.

    Pieces of words that its normaliser leaves alone go to its BPE model; all
    other words go through the whole tokenizer.  With ``added_tokens``, texts are
    first cut at the definition's added tokens, the longest where two begin.
    """

    def __init__(self, definition: str, added_tokens: bool = False):
        self.tokenizer = Tokenizer.from_str(definition)
        # the cut is made on the text as it stands: what lowering makes of a word is no added token
        self.tokenizer.encode_special_tokens = True
        tokens = json.loads(definition).get("added_tokens") or [] if added_tokens else []
        if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that depend on their surroundings or on the normaliser")
        # a word has no white space, so a space in front marks an added token
        self.added = {" " + t["content"]: [t["id"]] for t in tokens}
        self.quoted = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.quoted)) + ")")
        self.rare = "|".join([_ODD.pattern, *map(re.escape, self.quoted)])
        self.pieces = Pieces(definition)

    def split(self, text: str) -> list[str]:
        """Words of a text, and its added tokens with a space in front."""
        if not any(t in text for t in self.quoted):
            return words_of(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += [" " + part] if i % 2 else words_of(part)
        return out

    def split_all(self, texts: pa.Array) -> pa.ListArray:
        """Words of each text as by ``split``, and empty strings."""
        texts = texts.fill_null("")
        if pc.any(pc.match_substring_regex(texts, self.rare)).as_py():
            return pa.array([self.split(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        return pc.utf8_split_whitespace(pc.ascii_lower(texts))

    def __call__(self, words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and the offset of each word in them."""
        words = pa.array(words, pa.string()) if isinstance(words, list) else words
        strange = np.flatnonzero(~pc.match_substring_regex(words, _LEFT_ALONE).to_numpy(zero_copy_only=False))
        odd = {i: w for i, w in zip(strange.tolist(), words.take(pa.array(strange)).to_pylist()) if w != w.lower() or not unicodedata.is_normalized("NFC", w)}
        whole = dict(zip(odd, (e.ids for e in self.tokenizer.encode_batch_fast(list(odd.values()), add_special_tokens=False))))
        for token, ids in self.added.items():
            whole.update(dict.fromkeys(np.flatnonzero(pc.equal(words, token).to_numpy(zero_copy_only=False)).tolist(), ids))
        # pieces: those of words of letters and marks, column by column, then those of other words
        cut = pc.extract_regex(words, _LETTERS_MARKS)
        easy = cut.is_valid().to_numpy(zero_copy_only=False)
        easy[list(whole)] = False
        hard = ~easy
        hard[list(whole)] = False
        cut, found = cut.filter(pa.array(easy)), [_PIECES.findall(w) for w in words.filter(pa.array(hard)).to_pylist()]
        pieces = pa.concat_arrays([cut.field("letters"), cut.field("marks"), pa.array(list(chain.from_iterable(found)), pa.string())]).dictionary_encode()
        values, first = self.pieces(pieces.dictionary)
        # rows behind those of the pieces: the words that went through the whole tokenizer
        at, n, m = pieces.indices.to_numpy(), len(first) - 1, int(easy.sum())
        values = np.concatenate([values, np.fromiter(chain.from_iterable(whole.values()), np.int32)])
        first = np.concatenate([first, first[-1] + np.cumsum([len(x) for x in whole.values()], dtype=np.int64)])
        count = np.where(easy, 2, 1)
        count[hard] = [len(x) for x in found]
        begin = np.concatenate([[0], np.cumsum(count)])
        row = np.empty(begin[-1], np.int64)
        row[begin[:-1][easy]], row[begin[:-1][easy] + 1] = at[:m], at[m : 2 * m]
        row[np.repeat(hard, count)] = at[2 * m :]
        row[begin[list(whole)]] = n + np.arange(len(whole))
        ids, starts = gather(values, first, row)
        return ids, starts[begin]

    def encode_batches(self, batches) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """``(batch, ids, offsets)`` for slices of the batches; each distinct word of a stretch of texts is encoded once."""
        held: list[tuple[pa.RecordBatch, pa.ListArray]] = []
        size = 0

        def out():
            words = pa.chunked_array([w.flatten() for _, w in held]).combine_chunks().dictionary_encode()
            values, first = self(words.dictionary)
            at, done = words.indices.to_numpy(), 0
            for batch, lists in held:
                ends = lists.offsets.to_numpy()
                ids, starts = gather(values, first, at[done : done + ends[-1] - ends[0]])
                done += ends[-1] - ends[0]
                yield batch, ids, starts[ends - ends[0]]
            held.clear()

        for batch in slices(batches, "text", SLICE_BYTES):
            held.append((batch, self.split_all(batch.column("text"))))
            size += batch.column("text").nbytes
            if size >= STRETCH_BYTES:
                yield from out()
                size = 0
        if held:
            yield from out()


# a worker's encoder, from task to task
_kept: dict[tuple[str, bool], WordEncoder] = {}


def kept_encoder(definition: str, added_tokens: bool) -> WordEncoder:
    if (definition, added_tokens) not in _kept:
        _kept.clear()
        _kept[definition, added_tokens] = WordEncoder(definition, added_tokens)
    return _kept[definition, added_tokens]


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, added_tokens: bool = False) -> DataFrame:
    """Encode ``docs(doc_id, text)``, write the shards to ``path`` and return the written table.

    ``added_tokens`` gives the definition's added tokens in a text their ids.
    """
    ship(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        part = TaskContext.get().partitionId()
        shard, size, doc_ids, pieces, sizes = 0, 0, [], [], []

        def out():
            nonlocal shard, size
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            row = [[part], [shard], [doc_ids[0]], [len(doc_ids)], [size], [pack_shard(doc_ids, starts, np.concatenate(pieces))]]
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["part", "shard", "first_doc", "n_docs", "n_ids", "payload"])
            shard, size = shard + 1, 0
            for x in (doc_ids, pieces, sizes):
                x.clear()
            return batch

        # a task is to use one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        # white space is dropped by this kind of vocabulary, so words are encoded apart
        encoder = kept_encoder(held.value, added_tokens)
        for batch, ids, first in encoder.encode_batches(batches):
            ids, ends = np.insert(ids, first[1:], end_id), first + np.arange(len(first))
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                doc_ids.append(doc)
                pieces.append(ids[a:b])
                sizes.append(b - a)
                size += b - a
                if size >= SHARD_IDS:
                    yield out()
        if doc_ids:
            yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = dealt.mapInArrow(run, "part int, shard int, first_doc long, n_docs long, n_ids long, payload binary")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def read_store(store: DataFrame) -> DataFrame:
    """``(doc_id, start, ids array<int>)`` of every document, from the shards; start counts the ids of all documents before it."""
    ship(store.sparkSession)
    sizes = store.select("part", "shard", "first_doc", "n_ids")
    # one row per writing task goes through the single-partition sum
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"), F.min(F.struct(F.col("first_doc").isNotNull().alias("k"), "first_doc")).alias("at"))
    before = F.coalesce(F.sum("n").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    base = parts.select("part", before.alias("base"))
    inner = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("inner", inner).join(base, "part").select("part", "shard", (F.col("base") + F.col("inner")).cast("long").alias("start"))

    def run(batches):
        for batch in batches:
            for payload, start in zip(batch.column("payload"), batch.column("start").to_pylist()):
                docs, at, matrix = open_shard(payload.as_buffer().to_pybytes())
                ids = pa.ListArray.from_arrays(pa.array(np.append(at, matrix.n).astype(np.int32)), pa.array(matrix.ids().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(at + start), ids], names=["doc_id", "start", "ids"])

    return store.select("part", "shard", "payload").join(starts, ["part", "shard"]).select("start", "payload").mapInArrow(run, "doc_id long, start long, ids array<int>")
