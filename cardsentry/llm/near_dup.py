"""MinHash near-duplicate groups over word shingles (operator 10).

A document's set holds the hashes of its distinct word shingles.  The steps:

1. One pass over the texts gives each document its set's size and 128-bit
   fingerprint, ``bands * rows`` universal-hash minima (folded to one key per
   band, and one byte per minimum), and a bitmap of the set.
2. Documents with equal sets form a class; one member goes on.
3. Band keys deal classes into buckets.  The bucket's best-connected member is
   its centre; each member is a candidate pair with the centre only.
4. Candidates are confirmed on full sets.  Components of confirmed links come
   from alternating large-star and small-star.
5. Buckets that still hold several components are compared in blocks: members
   outside the centre's component against all others, in bounded tasks.  A pair
   survives only if the set sizes, the bitmaps (an upper bound of the overlap)
   and the signatures allow the threshold.  Survivors are confirmed on full sets
   and their links join the components.

After 5, every pair that shares a bucket has been tested or is known to be
connected, so components lose no link that banding finds.  With 28 bands of 5
minima a pair at similarity 0.85 shares no bucket with probability 8e-8 (at
0.8: 1.3e-5 with 28 bands, hence 40 bands are used below 0.85).

Defined cases: null text is empty; a document without words has size 0 and is
linked with nothing; fewer words than a shingle count as one shingle; null
doc_id rows take no part (component null, kept); rows that repeat a doc_id are
each returned, with the same verdict if their texts are the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Scratch, drop_rows, fresh, salted_join, small, text_print
from .words import U, mix, rolling, run_hashes, slices, split_words

BITS = 2048
BLOCK = 1024
MAIN_BLOCK = 4096
SEED = 20


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a document's word hashes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return run_hashes(words, np.array([0]), np.array([len(words)]))
    return np.unique(rolling(words, size))


class MinHash:
    """``(a * x + b) mod 2**64 >> 32`` over 32-bit x: a universal family; the minima of ``bands * rows`` members."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.default_rng(SEED)
        n = bands * rows
        self.a = (rng.integers(0, 2**63, n, dtype=np.uint64) * U(2) + U(1))[:, None]
        self.b = rng.integers(0, 2**63, n, dtype=np.uint64)[:, None]
        self.bands, self.rows = bands, rows

    def minima(self, items: np.ndarray) -> np.ndarray:
        x = items >> U(32)
        low = np.full(len(self.a), 2**64 - 1, dtype=np.uint64)
        for at in range(0, len(x), 512):
            np.minimum(low, (self.a * x[None, at : at + 512] + self.b).min(axis=1), out=low)
        return low >> U(32)

    def keys(self, minima: np.ndarray) -> np.ndarray:
        band = minima.reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64)
        for r in range(self.rows):
            key = mix(key * U(0x9E3779B97F4A7C15) + band[:, r])
        return key.astype(np.int64)


def _bitmap(items: np.ndarray) -> np.ndarray:
    on = np.zeros(BITS, dtype=bool)
    on[(items % U(BITS)).astype(np.int64)] = True
    return np.packbits(on)


SKETCH = "doc_id long, print long, n_shingles long, fp1 long, fp2 long, keys array<long>, sig binary, bits binary"


def sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """One row per document: set size, fingerprint, band keys, minima bytes, bitmap."""

    def run(batches):
        family = MinHash(bands, rows)
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), fold_case=True)
            out: list[list] = [[], [], [], [], [], []]
            for d in range(batch.num_rows):
                lo, hi = words.bounds(d)
                items = shingle_set(words.hash[lo:hi], size)
                one = [len(items), 0, 0, [], b"", b""]
                if len(items):
                    low = family.minima(items)
                    fp = [int(mix(items + U(s)).sum(dtype=np.uint64).astype(np.int64)) for s in (1, 2)]
                    one = [len(items), *fp, family.keys(low), low.astype(np.uint8).tobytes(), _bitmap(items).tobytes()]
                for column, value in zip(out, one):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("print")]
                + [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()))],
                names=["doc_id", "print", "n_shingles", "fp1", "fp2", "keys", "sig", "bits"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_print().alias("print"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, SKETCH)


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(node, items)`` of the wanted classes: their sorted shingle hashes."""

    def run(batches):
        for batch in slices(batches, "text"):
            words = split_words(batch.column("text"), fold_case=True)
            items = [shingle_set(words.hash[slice(*words.bounds(d))], size) for d in range(batch.num_rows)]
            prints = [[int(mix(x + U(s)).sum(dtype=np.uint64).astype(np.int64)) for x in items] for s in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p, pa.int64()) for p in prints), pa.array([x.tobytes() for x in items], pa.binary())],
                names=["node", "fp1", "fp2", "items"],
            )

    # rows that share a doc_id but not the text are told apart by the fingerprint
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = wanted.select("doc_id").distinct()
    # few wanted texts: their ids go to the texts; many: both sides are shuffled
    chosen = texts.join(F.broadcast(ids) if small(wanted) else ids, "doc_id", "left_semi")
    made = chosen.mapInArrow(run, "node long, fp1 long, fp2 long, items binary")
    return made.join(wanted.select(F.col("doc_id").alias("node"), "fp1", "fp2"), ["node", "fp1", "fp2"], "left_semi").dropDuplicates(["node", "fp1", "fp2"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold; ``pairs`` is a written table, so hot sides can be split."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("class").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("class").alias("b"), F.col("items").alias("y"))
    sized = pairs.join(x, "a").where(F.length("x") > 0).join(y, "b")
    lx, ly = F.length("x"), F.length("y")
    return sized.where(100 * F.least(lx, ly) >= percent * F.greatest(lx, ly)).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _compare_blocks(rows: DataFrame, percent: int, minima: int) -> DataFrame:
    """Pairs of different components within each block that size, bitmaps and signatures allow.

    ``rows(block, side, node, comp, n, sig, bits)`` come sorted by block; side 0
    is compared with all other rows of the block, side 1 only with side 0.
    """
    j = percent / 100
    least = int((j - 6 * (j * (1 - j) / minima) ** 0.5) * minima)

    def pairs(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        node, comp, n, side = (block.column(c).to_numpy() for c in ("node", "comp", "n", "side"))
        sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(len(node), -1)
        bits = np.frombuffer(b"".join(block.column("bits").to_pylist()), np.uint64).reshape(len(node), -1)
        spare = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        left, right = [], []
        for i in np.flatnonzero(side == 0):
            o = np.flatnonzero((comp != comp[i]) & ((side == 1) | (node > node[i])) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])))
            if len(o):
                most = np.bitwise_count(bits[o] & bits[i]).sum(axis=1, dtype=np.int64) + np.minimum(spare[o], spare[i])
                o = o[100 * most >= percent * (n[o] + n[i] - most)]
            if len(o):
                o = o[(sig[o] == sig[i]).sum(axis=1) >= least]
                left.append(np.full(len(o), node[i]))
                right.append(node[o])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        p, q = np.concatenate(left), np.concatenate(right)
        return np.minimum(p, q), np.maximum(p, q)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            ids = table.column("block").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1, [len(ids)]]) if len(ids) else np.array([0])
            out = [pairs(table.slice(a, b - a)) for a, b in zip(cuts[:-2], cuts[1:-1])]
            held = table.slice(int(cuts[-2])) if len(cuts) > 1 else None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in (0, 1)], names=["a", "b"])
        if held is not None and held.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in pairs(held)], names=["a", "b"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _blocks(members: DataFrame) -> DataFrame:
    """Deal the members of unsettled buckets into blocks of bounded size.

    ``members(key, class, comp, main)``: side 1 is the centre's component.  Side
    0 is cut into chunks of about BLOCK rows, side 1 of MAIN_BLOCK; every chunk
    of side 0 meets every other chunk once.
    """
    rows = members.withColumn("side", (F.col("comp") == F.col("main")).cast("int"))
    counts = rows.groupBy("key").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.ceil(F.sum(1 - F.col("side")) / BLOCK).cast("int").alias("g0"),
        F.ceil(F.sum("side") / MAIN_BLOCK).cast("int").alias("g1"),
    ).where("lo != hi").select("key", "g0", "g1")
    rows = salted_join(rows, counts, ["key"], F.col("class"))
    mine = F.pmod(F.xxhash64("class"), F.when(F.col("side") == 0, F.col("g0")).otherwise(F.col("g1"))).cast("int")
    rows = rows.withColumn("mine", mine)
    # block names: (kind 0, low, high) for side 0 with itself, (kind 1, chunk of side 0, chunk of side 1)
    own = F.transform(F.sequence(F.lit(0), F.col("g0") - 1), lambda i: F.struct(F.lit(0).alias("k"), F.least(i, F.col("mine")).alias("p"), F.greatest(i, F.col("mine")).alias("q")))
    cross0 = F.when(F.col("g1") > 0, F.transform(F.sequence(F.lit(0), F.col("g1") - 1), lambda i: F.struct(F.lit(1).alias("k"), F.col("mine").alias("p"), i.alias("q"))))
    cross1 = F.transform(F.sequence(F.lit(0), F.col("g0") - 1), lambda i: F.struct(F.lit(1).alias("k"), i.alias("p"), F.col("mine").alias("q")))
    none = F.array().cast("array<struct<k:int,p:int,q:int>>")
    places = F.when(F.col("side") == 0, F.concat(own, F.coalesce(cross0, none))).otherwise(cross1)
    return rows.withColumn("at", F.explode(places)).select(F.xxhash64("key", "at.k", "at.p", "at.q").alias("block"), "side", "class", "comp")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int | None = None, rows: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Two documents are linked if ``100 * |intersection| >= percent * |union|`` of
    their shingle sets; component_id is the smallest doc_id reachable by links.
    """
    return _verdicts(docs, size, percent, bands, rows).select("doc_id", "n_shingles", "component_id", "kept")


def _verdicts(docs: DataFrame, size: int, percent: int, bands: int | None = None, rows: int = 5) -> DataFrame:
    """``near_duplicates`` with each row's text fingerprint ``print`` and its ``component`` (a number of its own, null if linked with nothing)."""
    spark = docs.sparkSession
    bands = bands or (28 if percent >= 85 else 40)
    with Scratch(spark, "near-dup") as s:
        sketch = s.stash(sketches(docs, size, bands, rows), "sketch")
        of = ("fp1", "fp2")
        classes = s.stash(
            sketch.where("n_shingles > 0 and doc_id is not null").groupBy(*of)
            .agg(F.min(F.struct("doc_id", "n_shingles", "keys", "sig", "bits")).alias("v"))
            .select(F.xxhash64(*of, "v.doc_id").alias("class"), *of, "v.*"), "classes")
        bands_ = classes.select("class", F.explode("keys").alias("key"))
        counts = bands_.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        members = s.stash(salted_join(bands_, counts, ["key"], F.col("class")), "members")
        score = members.groupBy("class").agg(F.sum("m").alias("score"))
        centre = members.join(score, "class").groupBy("key").agg(F.max(F.struct("score", "class")).alias("c")).select("key", F.col("c.class").alias("centre"))
        centred = s.stash(salted_join(members.select("key", "class"), centre, ["key"], F.col("class")), "centred")
        near = F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")
        stars = s.stash(centred.where("class != centre").select(*near).distinct(), "pairs")
        wanted = s.stash(classes.join(members.select("class").distinct(), "class", "left_semi").select("class", "doc_id", *of), "wanted")
        sets = s.stash(_full_sets(docs, wanted, size).withColumnRenamed("node", "doc_id").join(wanted, ["doc_id", *of]).select("class", "items"), "sets")
        links = s.stash(_confirm(stars, sets, percent), "confirmed")
        comps = s.stash(connected_components(links, s), "components")
        # what the centres left apart
        comp = centred.join(comps.withColumnRenamed("node", "class").withColumnRenamed("component", "comp"), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
        main = comp.where("class = centre").select("key", F.col("comp").alias("main"))
        blocks = _blocks(salted_join(comp.select("key", "class", "comp"), main, ["key"], F.col("class")))
        payload = classes.select("class", F.col("n_shingles").alias("n"), "sig", "bits")
        rows_ = blocks.join(payload, "class").select("block", "side", F.col("class").alias("node"), "comp", "n", "sig", "bits")
        rest = s.stash(_compare_blocks(rows_, percent, bands * rows), "rest")
        more = s.stash(_confirm(rest, sets, percent), "late")
        if more.limit(1).count():
            comps = s.stash(connected_components(links.union(more), s), "all-components")
        found = classes.join(comps, classes["class"] == comps["node"], "left").select(*of, "doc_id", F.coalesce("component", "class").alias("component"))
        least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        named = salted_join(found.select(*of, "component", "doc_id"), least, ["component"], F.col("doc_id")).select(*of, "component", "component_id")
        sk = sketch.select("doc_id", "print", "n_shingles", *of)
        out = salted_join(sk, named.withColumn("linked", F.lit(True)), of, F.xxhash64("doc_id"), how="left")
        linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
        out = out.select("doc_id", "print", "n_shingles", F.when(linked, F.col("component")).alias("component"), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
        out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return s.stash(out, "result", keep=True)


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that repeat a kept document (one document of each group stays).

    Of a group the row with the smallest doc_id stays; if several texts of the
    group share that doc_id, the one with the smallest fingerprint.  Rows that
    repeat both doc_id and text count as one document.  Columns and all other
    rows are unchanged, also other texts under the doc_id of a dropped row.
    """
    verdict = _verdicts(docs, size, percent)
    print_ = fresh(docs, "print")
    lost = verdict.where("not kept").select("doc_id", F.col("print").alias("fp"))
    twice = verdict.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if twice:
        first = verdict.where("kept and component is not null")
        stays = first.groupBy("component").agg(F.min("print").alias("stays"))
        lost = lost.union(salted_join(first, stays, ["component"], F.col("print")).where("print != stays").select("doc_id", "print"))
    left = drop_rows(docs, lost.distinct())
    if twice:
        once = left.where("doc_id is not null").withColumn(print_, text_print()).dropDuplicates(["doc_id", print_]).drop(print_)
        left = once.unionByName(left.where("doc_id is null"))
    return left
