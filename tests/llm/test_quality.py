import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsentry.llm.quality_classifier import classify, isotonic
from cardsentry.llm.quality_rules import keep_quality, quality_rules

from .conftest import sentence, words


def base(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), n < 10 or 100 * len(inside) > 20 * n)


def odd_texts(rng):
    texts = [sentence(rng, int(n), 30) for n in rng.integers(0, 80, 60)]
    return texts + ["", None, " \n\t\x0b\x0c\r ", "a", "é ñ 漢字 😀 #1 <b>", "a b c d e\na b c d e\n\n x\n x\n", "x\x1cy z", "a " * 500, "one\r\ntwo\r\none\r\n", "a b c d e f a b c d e"]


def test_base_measures_match_brute_force(make_docs):
    texts = odd_texts(np.random.default_rng(0))
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules(make_docs(texts)).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_bounds_follow_language_and_source(make_docs):
    rng = np.random.default_rng(1)
    plain = [(i, sentence(rng, 40), "en", "plain", 0) for i in range(300)]
    # a source of tables: marks are usual there
    marked = [(1000 + i, " | ".join(sentence(rng, 40).split()), "en", "tables", 0) for i in range(300)]
    junk = [(2000, " | ".join(sentence(rng, 40).split()), "en", "plain", 0), (2001, sentence(rng, 40) + " a|b", "en", "plain", 0)]
    rare = [(3000, sentence(rng, 40), None, None, 0), (3001, sentence(rng, 40), "en", "small", 0)]
    kept = {r.doc_id for r in quality_rules(make_docs(plain + marked + junk + rare)).where("kept").collect()}
    assert kept == {r[0] for r in plain + marked + rare} | {2001}


@pytest.mark.parametrize("size", [20, 50, 199, 200])
def test_styled_groups_keep_their_documents_at_every_size(make_docs, size):
    rng = np.random.default_rng(size)
    plain = [(i, sentence(rng, 40), "en", "plain", 0) for i in range(300)]
    styled = [(1000 + i, " | ".join(sentence(rng, 40).split()), "en", "tables", 0) for i in range(size)]
    # two odd documents are no style yet
    few = [(5000 + i, " | ".join(sentence(rng, 40).split()), "en", "few", 0) for i in range(2)]
    kept = {r.doc_id for r in quality_rules(make_docs(plain + styled + few)).where("kept").collect()}
    assert kept == {r[0] for r in plain + styled}


def test_filter_keeps_columns(make_docs, clashing):
    rng = np.random.default_rng(2)
    docs = clashing(make_docs([sentence(rng, 30), "short", None, (7, sentence(rng, 30), None, None, None), (7, sentence(rng, 30), None, None, None)]))
    left = keep_quality(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [0, 7, 7]
    assert keep_quality(make_docs([])).count() == 0 and quality_rules(make_docs([])).count() == 0


def test_plan_has_no_python(make_docs):
    plan = quality_rules(make_docs(["a b c"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(3)
    y = rng.normal(np.linspace(0, 1, 40), 0.5)
    x, v = isotonic(np.arange(40.0), np.ones(40), y)
    assert (np.diff(v) > 0).all() and (np.diff(x) > 0).all()
    # each block's value is the mean of its members: the total is kept
    assert x[0] >= 0 and x[-1] <= 39
    assert (v.min() >= y.min()) and (v.max() <= y.max())


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    from cardsentry.llm.queries import op3_quality_classifier

    scored = op3_quality_classifier(spark, sf)
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert scored.where("score is null or score < 0 or score > 1 or predicted != int(score >= 0.3)").count() == 0
    held = scored.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() > 0.98
    bad = held[held.quality == 0].score.to_numpy()
    good = held[held.quality == 1].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.97


def test_classifier_edge_cases(spark, make_docs):
    docs = make_docs(["", None, "a b", (None, "x", None, None, 0), (2, "a b", None, None, 0)])
    none = spark.createDataFrame([], "doc_id long, y int")
    assert [r.score for r in classify(docs, none).collect()] == [0.5] * 5
    one = spark.createDataFrame([(2, 1), (2, 1), (0, None), (None, 0)], "doc_id long, y int")
    assert [r.score for r in classify(docs, one).collect()] == [1.0] * 5
    assert classify(make_docs([]), one).count() == 0
    mixed = spark.createDataFrame([(2, 1), (2, 0), (0, 0), (1, 0)], "doc_id long, y int")
    assert all(0 <= r.score <= 1 for r in classify(docs, mixed).collect())
    with pytest.raises(Exception):
        classify(docs.drop("text"), one).select(F.sum("score")).collect()
