"""Hot key: one user (and its card) holds a third of all rows.

The skewed ``events`` is written to a scratch folder; the same registered
queries and the same DuckDB oracle SQL run on it and must agree exactly.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF01
from oracle_check import compare

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skew"))
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    hot.write.parquet(f"{d}/events.parquet")
    return d


def test_one_user_holds_a_third(spark, skewed_dir):
    ev = spark.read.parquet(f"{skewed_dir}/events.parquet")
    top = ev.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert top["user_id"] == 0 and top["count"] * 3 >= ev.count() - 3


@pytest.mark.parametrize("name", ["detect_above_limit", "above_limit_sliding_12h", "detect_low_values",
                                  "p05_by_card_week", "trailing_24h_repeat", "detect_location_jump",
                                  "fraud_alerts", "feed_above_limit"])
def test_hot_key_results_match_oracle(spark, skewed_dir, name):
    r = compare(name, spark, skewed_dir, QUERIES, ORACLE)
    assert r["ok"], r
    assert r["spark_rows"] > 0


def test_joins_with_statistics_spread_a_hot_key(spark):
    """No task gets all rows of a key that holds the whole table."""
    from cardsentry.operators.skew import join_stats
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(8000).select(F.col("id").alias("seq"), F.lit(1).alias("k"))
        stats = spark.createDataFrame([(1, 2)], "k int, v int")
        for how in ("inner", "left_semi"):
            sizes = [r["count"] for r in join_stats(rows, stats, ["k"], how=how).groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 8000 and max(sizes) < 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
