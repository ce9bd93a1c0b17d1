"""Passages that repeat across documents, by sparse suffixes (operator 7).

A passage is a run of ``length`` words or more; a word belongs to a repeated
passage if some window of ``length`` words around it also occurs in an earlier
document (smaller doc_id).  The steps:

1. Of every window, the ``GRAM``-word gram with the least hash is its anchor
   (a minimiser, leftmost on ties).  Equal windows choose the same anchor, so
   only the suffixes at anchors are kept: about one in 22 words.  An anchor row
   has the gram's hash and the hash of its segment: all words of the windows
   that chose it.
2. Anchors are ordered by gram; grams of a single document go.  Neighbours with
   equal segments are copies: the first document's stays, all others' windows
   are repeats as a whole.
3. Neighbours that share a gram but not the segment match up to some point left
   and right of it.  The first documents' segments are read again and extended
   window by window, which finds exactly how far they agree.
4. Windows found are merged into spans.

Nothing here grows with the square of a group: copies cost one row per anchor,
and only one document per distinct segment is extended.

Defined cases: null or short texts have no passages; rows that repeat both
doc_id and text are one document; rows with a null doc_id take no part and stay
whole.  Repeats inside one document do not count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Scratch, fresh, salted_join, small
from .words import U, mix, rolling, run_hashes, slices, split_words

GRAM = 8
MAX_BROADCAST_SPANS = 250_000
DOC = ("doc_id", "fp")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), text.alias("text"))


def anchors_of(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all documents of a batch: gram hash, segment hash, first window, last window (positions in the batch)."""
    none = np.zeros(0, np.int64)
    if len(words) < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    grams = rolling(words, GRAM)
    wide = np.lib.stride_tricks.sliding_window_view(grams, length - GRAM + 1)
    step = 8192
    anchor = np.concatenate([wide[a : a + step].argmin(axis=1) + np.arange(a, min(a + step, len(wide))) for a in range(0, len(wide), step)])
    # windows that lie in one document
    doc_end = np.repeat(first[1:], np.diff(first))[: len(wide)]
    at = np.flatnonzero(np.arange(len(wide)) + length <= doc_end)
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    new = np.ones(len(at), dtype=bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    lo = at[new]
    hi = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
    p = anchor[lo]
    segment = mix(run_hashes(words, lo, hi + length) ^ (p - lo).astype(np.uint64) * U(0x9E3779B97F4A7C15))
    return grams[p], segment, lo, hi


def _anchors(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            gram, segment, lo, hi = anchors_of(words.hash, words.first, length)
            doc = np.searchsorted(words.first, lo, side="right") - 1
            base = words.first[doc]
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("fp").take(rows), pa.array(gram.astype(np.int64)), pa.array(segment.astype(np.int64)),
                 pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32))],
                names=["doc_id", "fp", "gram", "segment", "lo", "hi"],
            )

    return keyed.where("doc_id is not null").mapInArrow(run, "doc_id long, fp long, gram long, segment long, lo int, hi int")


def _extended(keyed: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """``(window, doc_id, fp, at)`` for every window in the ranges ``(doc_id, fp, lo, hi)``."""

    def run(batches):
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            spans = batch.column("ranges")
            for d in range(batch.num_rows):
                base, _ = words.bounds(d)
                one = spans[d].values
                lo, hi = one.field("lo").to_numpy(), one.field("hi").to_numpy()
                sizes = hi - lo + 1
                at = np.unique(np.repeat(lo - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()))
                # hash within the document only, so that cost follows its length
                own = words.hash[base : words.bounds(d)[1]]
                hashes = run_hashes(own, at, at + length)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.astype(np.int64)), pa.array(np.full(n, batch.column("doc_id")[d].as_py())), pa.array(np.full(n, batch.column("fp")[d].as_py())), pa.array(at.astype(np.int32))],
                    names=["window", "doc_id", "fp", "at"],
                )

    per_doc = ranges.groupBy(*DOC).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    texts = keyed.join(per_doc, list(DOC)).dropDuplicates(list(DOC))
    return texts.mapInArrow(run, "window long, doc_id long, fp long, at int")


def repeated_windows(docs: DataFrame, length: int, s: Scratch) -> DataFrame:
    """Ranges of windows ``(doc_id, fp, lo, hi, first_doc_id)`` that occur in an earlier document."""
    keyed = _keyed(docs)
    # equal anchors of rows that repeat a document are one anchor
    anchors = s.stash(_anchors(keyed, length), "anchors")
    me = F.struct(*DOC)
    shared = anchors.groupBy("gram").agg(F.min(me).alias("lo_doc"), F.max(me).alias("hi_doc")).where("lo_doc != hi_doc").select("gram")
    dups = s.stash(salted_join(anchors, shared, ["gram"], F.xxhash64(*DOC, "lo")), "shared")
    segments = s.stash(dups.groupBy("gram", "segment").agg(F.min(me).alias("first")), "segments")
    several = segments.groupBy("gram").agg(F.count(F.lit(1)).alias("k"))
    known = segments.join(several, "gram")
    rows = s.stash(salted_join(dups, known, ["gram", "segment"], F.xxhash64(*DOC, "lo")), "ordered")
    copies = rows.where(me != F.col("first")).select(*DOC, "lo", "hi", F.col("first.doc_id").alias("first_doc_id"))
    firsts = rows.where((me == F.col("first")) & (F.col("k") > 1)).select(*DOC, "lo", "hi")
    windows = s.stash(_extended(keyed, firsts, length), "extended")
    earliest = windows.groupBy("window").agg(F.min(me).alias("first"), F.max(me).alias("last")).where("first != last").select("window", "first")
    met = salted_join(windows, earliest, ["window"], F.xxhash64(*DOC, "at")).where(me != F.col("first"))
    grown = met.select(*DOC, F.col("at").alias("lo"), F.col("at").alias("hi"), F.col("first.doc_id").alias("first_doc_id"))
    # for a copy, first_doc_id is the segment's first document; single windows in it may be older still
    return copies.union(grown)


def repeated_passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """``(doc_id, fp, start_word, end_word, n_words, earlier_doc_ids)``: one row per repeated span, words counted from 0, end exclusive.

    ``earlier_doc_ids`` lists, for the span's windows, earlier documents that
    hold them (for a copied segment, the first document that has the segment).
    """
    with Scratch(docs.sparkSession, "repeats") as s:
        found = s.stash(repeated_windows(docs, length, s).distinct(), "found")
        by_doc = W.partitionBy(*DOC).orderBy("lo", "hi")
        reach = F.max("hi").over(by_doc.rowsBetween(W.unboundedPreceding, -1))
        # windows at distance `length` or less cover words without a gap
        cut = (F.col("lo") > F.coalesce(reach, F.lit(-length - 1)) + length).cast("int")
        runs = found.withColumn("cut", cut).withColumn("run", F.sum("cut").over(by_doc.rowsBetween(W.unboundedPreceding, 0)))
        spans = runs.groupBy(*DOC, "run").agg(
            F.min("lo").cast("long").alias("start_word"), (F.max("hi") + length).cast("long").alias("end_word"),
            F.array_sort(F.collect_set("first_doc_id")).alias("earlier_doc_ids"))
        out = spans.select(*DOC, "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "earlier_doc_ids")
        return s.stash(out, "spans", keep=True)


def cut_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with repeated passages cut out of their texts; the first document that holds a passage keeps it.

    A cut takes the span's words and the separators between them, and leaves
    what stands before and after.  n_chars, if there, follows the new text.
    All rows stay, also those whose text is used up.
    """
    spans = repeated_passages(docs, length)
    cuts, id_, print_ = fresh(docs, "cuts"), fresh(docs, "id"), fresh(docs, "print")
    per_doc = spans.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("start_word", "end_word"))).alias(cuts))
    keyed = docs.withColumn(id_, F.col("doc_id").cast("long")).withColumn(print_, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    named = per_doc.withColumnsRenamed({"doc_id": id_, "fp": print_})
    # few spans go to the texts; many: both sides are shuffled
    joined = keyed.join(F.broadcast(named) if small(spans, MAX_BROADCAST_SPANS) else named, [id_, print_], "left").drop(id_, print_)
    schema = docs.schema
    at = schema.names.index("text")

    def run(batches):
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"))
            texts, spans_ = batch.column("text").to_pylist(), batch.column(cuts).to_pylist()
            for d, gone in enumerate(spans_):
                if not gone:
                    continue
                base, left, kept = words.bounds(d)[0], int(words.offset[d]), []
                for c in gone:
                    kept.append(words.data[left : words.start[base + c["start_word"]]].tobytes())
                    left = int(words.end[base + c["end_word"] - 1])
                kept.append(words.data[left : int(words.offset[d + 1])].tobytes())
                texts[d] = b"".join(kept).decode()
            columns = [batch.column(n) for n in schema.names]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = joined.mapInArrow(run, schema)
    if "n_chars" in schema.names:
        kind = schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
