import re

import numpy as np
import pytest

from cardsentry.llm import decontaminate
from cardsentry.llm.decontaminate import contaminated, drop_contaminated, smith_waterman

from .conftest import sentence


def plain_alignment(a, b):
    """Best local alignment score, cell by cell."""
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, prev[j] + (2 if x == y else -1), prev[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
        prev = row
    return best


def test_alignment_matches_plain_one():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(0, 12)), rng.integers(0, 5, rng.integers(1, 25))
        assert smith_waterman(a, b)[0] == plain_alignment(a.tolist(), b.tolist())


def test_finds_exact_and_edited_copies_and_nothing_else(spark, make_docs):
    rng = np.random.default_rng(4)
    items = [sentence(rng, int(n), 3000) for n in rng.integers(12, 60, 30)]
    texts, want = [], {}
    for d in range(120):
        parts = [sentence(rng, int(rng.integers(5, 200)), 3000)]
        if d % 3 == 0:
            k = d % 30
            copy = items[k].split()
            for j in range(0, len(copy), 9 if d % 2 else 10**6):
                copy[j] = "edited"
            parts += [" ".join(copy).upper() if d % 4 == 0 else ", ".join(copy), sentence(rng, 20, 3000)]
            want[(d, k)] = " ".join(copy)
        texts.append(" ".join(parts))
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, ""), (92, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(make_docs(texts + ["", None]), bench).collect()}
    assert set(got) == set(want)
    for (d, k), r in got.items():
        item = items[k].split()
        assert r.score == pytest.approx(plain_alignment(item, want[(d, k)].lower().split()) / (2 * len(item)))
        words = re.findall(r"[a-z0-9]+", texts[d].lower())
        assert words[r.start_word:r.end_word][-1] == [w for w in want[(d, k)].lower().split() if w != "edited"][-1]


def test_slices_of_a_large_benchmark_agree(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(6)
    items = [sentence(rng, 30, 2000) for _ in range(20)]
    texts = [sentence(rng, 20) + " " + items[i % 20] for i in range(40)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, contaminated(make_docs(texts), bench).collect()))
    monkeypatch.setattr(decontaminate, "MAX_WORDS", 200)
    assert sorted(map(tuple, contaminated(make_docs(texts), bench).collect())) == whole and len(whole) == 40


def test_filter(spark, make_docs, clashing):
    item = "the quick brown fox jumps over the lazy dog again and again"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = clashing(make_docs(["clean text here", f"see: {item}!", None, "", (None, item, None, None, 1), (1, f"see: {item}!", "x", "y", 2)]))
    left = drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["0", "2", "3", "None"]
    none = bench.where("false")
    assert drop_contaminated(docs, none).count() == 6
    assert contaminated(make_docs([]), bench).count() == 0


@pytest.mark.parametrize("edited, verbatim", [(9, 0), (100, 0), (1000, 0), (100, 10), (1000, 10)])
def test_copies_of_one_edited_passage_are_all_found(spark, make_docs, edited, verbatim):
    rng = np.random.default_rng(8)
    item = sentence(rng, 30, 3000).split()
    changed = ["edited" if j % 5 == 4 else w for j, w in enumerate(item)]
    texts = [" ".join([sentence(rng, 20, 3000), *copy, sentence(rng, 20, 3000)]) for copy in [changed] * edited + [item] * verbatim]
    texts += [sentence(rng, 80, 3000) for _ in range(30)]
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in contaminated(make_docs(texts), bench).collect()}
    score = plain_alignment(item, changed) / 60
    assert 0.5 <= score < 1 and got == {d: pytest.approx(score if d < edited else 1) for d in range(edited + verbatim)}


def test_a_phrase_of_many_documents_still_finds_the_copy_that_keeps_only_it(spark, make_docs):
    rng = np.random.default_rng(9)
    item = sentence(rng, 30, 3000).split()
    # a run of five words survives, else two of three
    copy = [w if j == 12 or j % 3 else "edited" for j, w in enumerate(item)]
    phrase = " ".join(item[10:15])
    texts = [" ".join([sentence(rng, 20, 3000), phrase, sentence(rng, 20, 3000)]) for _ in range(300)]
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = contaminated(make_docs([*texts, " ".join(copy)]), bench).collect()
    assert [(r.doc_id, r.score) for r in got] == [(300, pytest.approx(plain_alignment(item, copy) / 60))]


def test_bound_of_short_items(spark, make_docs):
    rng = np.random.default_rng(10)
    items, texts, want = [], [], {}
    for n in range(8, 17):
        item = sentence(rng, n, 3000).split()
        items.append((n, " ".join(item)))
        for changed in range(n - 3):
            copy = item[: n - changed] + ["edited"] * changed
            score = plain_alignment(item, copy)
            if score >= max(n, 16):
                want[(len(texts), n)] = score / (2 * n)
            texts.append(" ".join([sentence(rng, 20, 3000), *copy, sentence(rng, 20, 3000)]))
        # a word changed in the middle
        copy = item[: n // 2] + ["edited"] + item[n // 2 + 1 :]
        score = plain_alignment(item, copy)
        if score >= max(n, 16):
            want[(len(texts), n)] = score / (2 * n)
        texts.append(" ".join(copy))
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(make_docs(texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    assert min(v for (_, n), v in want.items() if n == 12) == pytest.approx(16 / 24) and [v for (_, n), v in want.items() if n == 8] == [1]


def test_clean_texts_under_a_contaminated_doc_id_stay(spark, make_docs):
    import numpy as np

    from cardsentry.llm.decontaminate import drop_contaminated

    from .conftest import sentence
    rng = np.random.default_rng(31)
    item = sentence(rng, 25, 5000)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = sentence(rng, 40, 5000)
    docs = make_docs([(5, "x y " + item + " z", "en", "s", 0), (5, clean, "en", "s", 0), (6, clean, "en", "s", 0), (None, item, "en", "s", 0)])
    assert sorted((r.doc_id or -1, r.text) for r in drop_contaminated(docs, bench).collect()) == sorted([(5, clean), (6, clean), (-1, item)])
