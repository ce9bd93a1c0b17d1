import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardsentry.llm import simhash
from cardsentry.llm.queries import op11_simhash_near_dedup
from cardsentry.llm.simhash import fingerprint, forest, list_pairs, near_duplicates, shingle_hashes, word_lists

from .conftest import lowered, sentence, words


def plain_fingerprint(text):
    w = words(lowered(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, bits=2):
    """Least place reachable for each place, comparing all pairs."""
    x = np.array(prints, np.uint64)
    root = list(range(len(x)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[:i] ^ x[i]) <= bits):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(x))]


def brute(rows):
    """(doc_id, fingerprint, component_id) by comparing every pair of rows."""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = components(prints)
    least = {}
    for (doc, _), r in zip(rows, root):
        least[r] = min(doc, least.get(r, doc))
    return sorted((doc, f"{p:016x}", least[r]) for (doc, _), p, r in zip(rows, prints, root))


def family(rng, n, size=400):
    base = [f"w{rng.integers(300)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.integers(0, 4)):
            copy[rng.integers(len(copy))] = f"x{rng.integers(1000)}"
        out.append(" ".join(copy))
    return out


def test_matches_brute_force(make_docs):
    rng = np.random.default_rng(11)
    texts = family(rng, 60) + family(rng, 20, 2000) + [sentence(rng, int(n)) for n in rng.integers(1, 60, 40)]
    texts += ["", None, "   \n\t", "One", "one", "ONE two", "one TWO", "É été", "é été", "a\x1cb c", "a b c", texts[3], texts[3].upper()]
    got = near_duplicates(make_docs(texts)).collect()
    want = brute(list(enumerate(texts)))
    assert sorted(map(tuple, got)) == want
    assert any(c != d for d, _, c in want[:60])


def test_whole_table_matches_brute_force(spark):
    got = op11_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == brute(docs)


@pytest.mark.parametrize("size", [2, 7, 30, 500, 5000])
def test_lists_find_every_pair(size):
    rng = np.random.default_rng(size)
    mask = simhash._terms()[13]
    free = ~np.uint64(mask & (1 << 64) - 1)
    fps = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) & free | np.uint64(0x1234567890ABCDEF) & ~free)
    a, b = list_pairs(fps, mask)
    i, j = np.triu_indices(len(fps), 1)
    near = np.bitwise_count(fps[i] ^ fps[j]) <= 2
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset(p) for p in zip(i[near].tolist(), j[near].tolist())}


def test_every_close_pair_meets_in_a_list():
    masks = simhash._terms()
    assert len(masks) == 28
    rng = np.random.default_rng(3)
    for _ in range(2000):
        x = int(rng.integers(0, 1 << 63, dtype=np.uint64))
        y = x ^ 1 << int(rng.integers(64)) ^ 1 << int(rng.integers(64))
        assert any((x & m) == (y & m) for m in masks)


def test_long_chains_settle(spark):
    # one list of thousands of members, linked in long chains: all in one component by pairs at most 2 bits apart
    rng = np.random.default_rng(4)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 13, 3000) << 20, rng.integers(0, 1 << 62, 2000)]))
    from cardsentry.llm.components import connected_components
    from cardsentry.llm.shared import Scratch

    with Scratch(spark, "t") as s:
        table = spark.createDataFrame([(int(x),) for x in fps], "fp long")
        made = s.stash(simhash.links(table), "links")
        assert made.count() <= 28 * len(fps)
        comps = {r.node: r.component for r in connected_components(made, s).collect()}
    want = components(fps.tolist())
    assert [comps.get(int(x), int(x)) for x in fps] == [int(fps[r]) for r in want]


def test_forest():
    rng = np.random.default_rng(8)
    for n in (1, 5, 200):
        a, b = rng.integers(0, n, n // 2), rng.integers(0, n, n // 2)
        root = forest(n, a, b)
        assert (root[root] == root).all() and (root[a] == root[b]).all() and (root <= np.arange(n)).all()


def test_long_texts_in_pieces():
    rng = np.random.default_rng(9)
    text = sentence(rng, 5000)
    data = text.encode()
    assert [w for part in word_lists(data, 100) for w in part] == data.split()
    assert fingerprint(shingle_hashes(text)) & (1 << 64) - 1 == plain_fingerprint(text)
    whole = fingerprint(shingle_hashes("ab " * 1_500_000 + "x" * 3_000_000))
    assert whole & (1 << 64) - 1 == xxhash.xxh64_intdigest("ab ab ab", 42)


def test_nulls_repeats_and_extra_columns(make_docs, clashing):
    docs = make_docs([(None, "a b c", "en", "s", 5), (4, "a b c", None, None, None), (4, "d e f g", "en", "s", 7), (2, "a b c", "en", "s", 5), (3, None, "en", "s", 0), (9, "", "en", "s", 0)])
    got = sorted(map(tuple, near_duplicates(clashing(docs)).collect()), key=repr)
    abc, defg = f"{plain_fingerprint('a b c'):016x}", f"{plain_fingerprint('d e f g'):016x}"
    assert got == sorted([(None, abc, None), (4, abc, 2), (4, defg, 4), (2, abc, 2), (3, "0" * 16, 3), (9, "0" * 16, 3)], key=repr)


def test_empty_table(make_docs):
    out = near_duplicates(make_docs([]))
    assert out.count() == 0 and out.columns == ["doc_id", "fingerprint", "component_id"]


def test_large_group_of_copies(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text for a third")).otherwise(F.concat(F.lit("t "), F.col("id"), F.lit(" u v "), F.col("id") * 7)).alias("text"))
    got = near_duplicates(docs)
    assert got.where("doc_id % 3 = 0 and component_id != 0").count() == 0 and got.count() == 20000
