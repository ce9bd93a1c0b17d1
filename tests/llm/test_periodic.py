import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cardsentry.llm.chunks import Index
from cardsentry.llm.periodic import find_runs, periodic_runs, primitive
from cardsentry.llm.queries import op13_periodic_runs, planted_periods

from .conftest import words


def brute_runs(w):
    """All runs by trying every period and every maximal stretch."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(w[x] == w[x + p] for x in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(texts):
    number = Index()
    ids = np.array([number[w] for t in texts for w in t], np.int64)
    return find_runs(ids, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def brute_row(doc, text):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("letters,seed", [(1, 0), (2, 1), (2, 2), (3, 3), (3, 4), (8, 5)])
def test_random_words(letters, seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(letters, size=int(n)).tolist() for n in rng.integers(0, 90, 120)]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_planted_runs_with_edits():
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(150):
        text = []
        for _ in range(rng.integers(1, 5)):
            word = rng.integers(4, size=int(rng.integers(1, 30))).tolist()
            text += (word * int(rng.integers(1, 9)))[: int(rng.integers(1, 150))]
        for _ in range(rng.integers(0, 3)):
            text[rng.integers(len(text))] = 9
        texts.append(text)
    want = [brute_runs(t) for t in texts]
    assert runs_of(texts) == want and sum(map(len, want)) > 100


def test_grams_that_recur_in_a_period():
    # every 5-gram of the period occurs twice in it, so only the longer grams of its octave tell the lag
    x, y = [1, 2, 3, 4, 5], [6, 7, 8, 9, 0]
    period = x + x + y + y + x + x + x + y + y + y
    for text in (period * 4, period * 6 + [99], [99] + period * 4 + x):
        assert runs_of([text]) == [brute_runs(text)]
        assert (len(period) in [q for _, _, q in brute_runs(text)])


def test_one_word_throughout_and_fibonacci():
    assert runs_of([[7] * 200_000]) == [[(0, 200_000, 1)]]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert runs_of([b]) == [brute_runs(b)]
    cubes = (b[:13] * 5 + [3]) * 5
    assert runs_of([cubes]) == [brute_runs(cubes)]


def test_primitive():
    for n in range(1, 40):
        for w in ([1] * n, list(range(n)), [1, 2] * n, [1, 1, 2] * n):
            assert primitive(np.array(w)) == (not any(len(w) % d == 0 and w == w[:d] * (len(w) // d) for d in range(1, len(w))))


def test_whole_table_matches_brute_force(spark):
    got = op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: r.text for r in docs if len(words(r.text)) <= 700}
    want = sorted(brute_row(d, t) for d, t in short.items())
    assert sorted(tuple(r) for r in got if r.doc_id in short) == want and len(got) == len(docs)
    assert len(short) > 150 and sum(r[1] > 0 for r in want) > 10
    # longer documents: every run reported is one, and made ones are found
    for r in docs:
        if r.doc_id not in short:
            w = planted_periods(r.doc_id, r.text.encode().split())
            for s, n, q in runs_of([w])[0]:
                assert w[s:s + n - q] == w[s + q:s + n] and n >= max(6, 4 * q)
                assert (s == 0 or w[s - 1] != w[s + q - 1]) and (s + n == len(w) or w[s + n] != w[s + n - q])


def test_nulls_repeats_and_extra_columns(make_docs, clashing):
    docs = make_docs([(None, "a a a a a a b", "en", "s", 5), (4, None, None, None, None), (4, "x y x y x y x y", "en", "s", 7), (4, "x y x y x y x y", "en", "s", 7), (5, "", "en", "s", 0), (6, "a\x1ca a a a a a\na", "en", "s", 0)])
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(clashing(docs)).collect()), key=repr)
    assert got == sorted([(None, 7, [(0, 6, 1)], "a b"), (4, 0, [], ""), (4, 8, [(0, 8, 2)], "x y"), (4, 8, [(0, 8, 2)], "x y"), (5, 0, [], ""), (6, 7, [(1, 6, 1)], "a\x1ca a")], key=repr)


def test_empty_table(make_docs):
    out = periodic_runs(make_docs([]))
    assert out.count() == 0 and out.columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_long_text(make_docs):
    rng = np.random.default_rng(7)
    page = " ".join(f"w{x}" for x in rng.integers(1000, size=20_000))
    row = periodic_runs(make_docs([(" ".join([page] * 5))])).collect()[0]
    assert [tuple(r) for r in row.runs] == [(0, 100_000, 20_000)] and row.collapsed == page
