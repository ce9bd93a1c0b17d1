import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cardsentry.llm import shared
from cardsentry.llm.shared import Scratch, fresh, salted_join, stats_join
from cardsentry.llm.words import rolling, split_words

from .conftest import words


def test_fresh_names():
    class Table:
        columns = ["id", "ID_", "text"]

    assert fresh(Table, "id") == "id__" and fresh(Table, "lost") == "lost"


@pytest.mark.parametrize("limit", [0, 100])
def test_stats_join_either_way(spark, monkeypatch, limit):
    monkeypatch.setattr(shared, "MAX_BROADCAST_ROWS", limit)
    rows = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"))
    stats = spark.createDataFrame([(k, k * 10) for k in range(1, 6)], "k long, v long")
    got = {(r.id, r.v) for r in stats_join(rows, stats, "k", F.col("id")).collect()}
    assert got == {(i, (i % 7) * 10 if 0 < i % 7 < 6 else None) for i in range(300)}


def test_salted_join_spreads_a_hot_key(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(8000).select("id", F.lit(1).alias("k"))
        joined = salted_join(rows, spark.createDataFrame([(1, 2)], "k int, v int"), ["k"], F.col("id"))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 8000 and max(sizes) < 4000


def test_scratch_keeps_what_it_is_told(spark):
    with Scratch(spark, "t") as s:
        gone = s.stash(spark.range(3).toDF("a"), "gone")
        kept = s.stash(gone, "kept", keep=True)
        assert gone.count() == 3
    assert kept.count() == 3
    with pytest.raises(Exception):
        gone.select("a").collect()


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["a b  c\n", None, "", "É é\x0bx\x1cy", " lead", "a b c", "aB Ab", "b a"]
    w = split_words(pa.array(texts))
    for d, t in enumerate(texts):
        lo, hi = w.bounds(d)
        assert [w.data[w.start[i]:w.end[i]].tobytes().decode() for i in range(lo, hi)] == words(t)
    by_word = {}
    for d, t in enumerate(texts):
        for i, x in zip(range(*w.bounds(d)), words(t)):
            assert by_word.setdefault(x, w.hash[i]) == w.hash[i]
    assert len(set(by_word.values())) == len(by_word)
    folded = split_words(pa.array(texts), fold_case=True)
    assert folded.hash[folded.first[6]] == folded.hash[folded.first[6] + 1]
    grams = [rolling(w.hash[slice(*w.bounds(d))], 2).tolist() for d in (0, 5, 7)]
    assert grams[0] == grams[1] and len(set(grams[1] + grams[2])) == 3


FOREIGN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
from cardsentry.llm.near_dup import near_duplicates
docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
print(sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()))
"""


def test_operators_run_from_a_foreign_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "job.py"
    script.write_text(FOREIGN.format(repo=repo, shared=str(tmp_path / "shared")))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().splitlines()[-1:] == ["[(1, 1), (2, 1), (3, 3)]"], done.stderr[-2000:]
