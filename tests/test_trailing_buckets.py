"""W1: buckets follow a user's row count; results do not depend on them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardsentry.operators.trailing import detect_trailing_repeat, trailing_hits
from test_edge_cases import T0, mk


def plain(rows, k, hours):
    """seq of every above-limit row with at least k of its user's in the trailing hours, itself included."""
    out = []
    for u in {r["user_id"] for r in rows}:
        mine = sorted((r["ts"], r["seq"]) for r in rows if r["user_id"] == u)
        out += [s for i, (t, s) in enumerate(mine) if sum(t - x <= dt.timedelta(hours=hours) for x, _ in mine[: i + 1]) >= k]
    return sorted(out)


@pytest.mark.parametrize("k,hours", [(2, 24), (4, 24), (3, 1)])
def test_any_bucket_gives_the_same(spark, k, hours):
    rnd = random.Random(k * 100 + hours)
    rows, seq = [], 0
    for u in range(12):
        at = 0.0
        for _ in range(rnd.choice([1, 3, 20, 150])):
            at += rnd.choice([0, 0, 1, 60, 1800, 3600 * hours, 3600 * 30])
            rows.append(dict(seq=seq, user_id=u, value="150.00", ts=T0 + dt.timedelta(seconds=at)))
            seq += 1
    tx = mk(spark, rows).cache()
    want = plain(rows, k, hours)
    assert 20 < len(want) < len(rows)
    for bucket_hours, bucket_rows in ((24, None), (24, 1), (24, 7), (1, 50), (500, 10**9)):
        got = sorted(r.seq for r in trailing_hits(tx, min_count=k, hours=hours, bucket_hours=bucket_hours, bucket_rows=bucket_rows).collect())
        assert got == want, (bucket_hours, bucket_rows)


def test_a_hot_user_day_is_dealt_over_many_tasks(spark):
    """One user's day of 200,000 rows: no task of the last window sees more than a few buckets."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = 200_000
        tx = mk(spark, [dict(seq=0)]).drop("seq", "ts", "user_id", "value").crossJoin(spark.range(n)).select(
            F.col("id").alias("seq"), "card_id", (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 0.4)).alias("ts"),
            F.lit("150.00").cast("decimal(18,2)").alias("value"), F.lit(1).alias("user_id"), "lim", "lat", "lon")
        sizes = [r["count"] for r in trailing_hits(tx, bucket_rows=4000).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n - 1 and len(sizes) >= 6 and max(sizes) < n / 2
        assert detect_trailing_repeat(tx).count() == n - 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
