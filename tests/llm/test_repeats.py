import numpy as np

from cardsentry.llm.repeats import cut_repeats, repeated_passages

from .conftest import hard_words, sentence, words


def brute(rows, length):
    """Spans of windows that an earlier document has."""
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        spans = []
        for i in range(len(w) - length + 1):
            if first.setdefault(tuple(w[i:i + length]), doc) != doc:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        if spans:
            out[doc] = [tuple(s) for s in spans]
    return out


def spans_of(df):
    got = {}
    for r in df.collect():
        assert r.n_words == r.end_word - r.start_word and r.earlier_doc_ids and all(e < r.doc_id for e in r.earlier_doc_ids)
        got.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    return {d: sorted(s) for d, s in got.items()}


def test_matches_brute_force(make_docs):
    rng = np.random.default_rng(2)
    passages = [sentence(rng, int(n)) for n in (49, 50, 51, 70, 200)]
    texts = []
    for _ in range(80):
        parts = [sentence(rng, int(rng.integers(0, 60)))]
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(len(passages))].split()
            cut = rng.integers(0, 12)
            parts += [" ".join(p[cut:]), sentence(rng, int(rng.integers(0, 40)))]
        texts.append(" ".join(parts))
    texts += ["", None, "a " * 300, "a " * 400, sentence(rng, 30), texts[0]]
    want = brute(enumerate(texts), 50)
    assert want
    assert spans_of(repeated_passages(make_docs(texts))) == want


def test_whole_table_matches_brute_force(spark):
    from cardsentry.llm.queries import op7_suffix_array_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert spans_of(op7_suffix_array_dedup(spark, "/root/testdata/sf0.01")) == brute(rows, 50)


def test_cut_leaves_first_and_rest(make_docs, clashing):
    rng = np.random.default_rng(3)
    p = sentence(rng, 60)
    docs = clashing(make_docs([f"alpha {p}\nomega é", f"beta\t{p}  gamma", p, "clean text", None,
                               (None, p, None, None, 0), (0, f"alpha {p}\nomega é", "en", "s", 1)]))
    out = cut_repeats(docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text, r.n_chars) for r in out.collect()]
    first = f"alpha {p}\nomega é"
    assert rows.count((0, first, len(first))) == 2
    assert (1, "beta\t  gamma", 12) in rows and (2, "", 0) in rows and (3, "clean text", 10) in rows
    assert any(d == 4 and t is None for d, t, _ in rows)
    assert any(d is None and t == p for d, t, _ in rows)
    assert len(rows) == 7


def test_empty_table(make_docs):
    assert repeated_passages(make_docs([])).count() == 0
    assert cut_repeats(make_docs([])).count() == 0


def test_long_words_of_few_letters_are_told_apart(make_docs):
    rng = np.random.default_rng(8)
    left, right = sentence(rng, 30), sentence(rng, 29)
    texts = [f"{left} {w} {right}" for w in hard_words()]
    docs = make_docs(texts)
    assert repeated_passages(docs).count() == 0
    assert [r.text for r in cut_repeats(docs).orderBy("doc_id").collect()] == texts
