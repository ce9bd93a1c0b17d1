"""Sliding windows by pane, and the index percentile of groups with many distinct values."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardsentry.operators import above_limit, low_values
from cardsentry.operators.windows import duration_seconds, pane_seconds
from cardsentry.schema import TX_SCHEMA

EPOCH = dt.datetime(1970, 1, 1)


def _windows(ts, length, slide):
    """Starts of all windows (seconds) that contain ``ts``."""
    at = (ts - EPOCH).total_seconds()
    start = at // slide * slide
    while start > at - length:
        yield EPOCH + dt.timedelta(seconds=start)
        start -= slide


def _rows(seed, n=400, values=40):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ts = EPOCH + dt.timedelta(days=20000, seconds=rnd.choice([0, 21600, 43200, 43199, 86400, rnd.randrange(900000)]))
        out.append((rnd.choice([i, i, 7]), rnd.randrange(3), ts, Decimal(rnd.randrange(values)) / 10, rnd.randrange(3), 2, 0.0, 0.0))
    return out


def _grouped(rows, key, length, slide, keep=lambda r: True):
    groups = {}
    for r in rows:
        if keep(r):
            for start in _windows(r[2], length, slide):
                groups.setdefault((r[key], start), []).append(r)
    return groups


SPECS = [("24 hours", "12 hours"), ("1 day", "5 hours"), ("7 days", "84 hours"), ("2 days", None)]


def _secs(spec):
    return duration_seconds(spec[0]), duration_seconds(spec[1] or spec[0])


@pytest.mark.parametrize("spec", SPECS)
def test_above_limit_panes(spark, spec):
    rows = _rows(3)
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    want = []
    for (user, start), members in _grouped(rows, 4, *_secs(spec), keep=lambda r: r[3] > r[5]).items():
        members.sort(key=lambda r: (r[2], r[0]))
        want += [(user, start, r[2], r[0]) for r in members[3:]]
    got = [tuple(r) for r in above_limit.detect_above_limit(tx, *spec).select("user_id", "window_start", "ts", "seq").collect()]
    assert want and sorted(got) == sorted(want)
    counted = above_limit.above_limit_ranked(tx, *spec, allowed=5, skip=2).select("user_id", "window_start", "n").distinct()
    sizes = {k: len(m) for k, m in _grouped(rows, 4, *_secs(spec), keep=lambda r: r[3] > r[5]).items() if len(m) > 5}
    assert {(r[0], r[1]): r[2] for r in counted.collect()} == sizes


@pytest.mark.parametrize("spec", SPECS)
def test_low_value_panes(spark, spec):
    rows = _rows(4)
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    want = []
    for (card, start), members in _grouped(rows, 1, *_secs(spec)).items():
        if sorted(r[3] for r in members)[int(len(members) * 0.05)] < 1:
            want += [(card, start, r[2], r[0], r[3]) for r in members if r[3] < 1]
    got = [tuple(r) for r in low_values.detect_low_values(tx, *spec)
           .select("card_id", "window_start", "ts", "seq", "value").collect()]
    assert want and sorted(got) == sorted(want)


@pytest.mark.parametrize("spec", SPECS)
@pytest.mark.parametrize("scan,brackets", [(100_000, 256), (5, 4), (0, 16), (20, 2)])
def test_index_value_by_brackets(spark, monkeypatch, spec, scan, brackets):
    """Every bound on the scanned values and every number of brackets gives the sorted list's entry."""
    monkeypatch.setattr(low_values, "SCAN_VALUES", scan)
    monkeypatch.setattr(low_values, "BRACKETS", brackets)
    rows = _rows(5, values=90)
    want = {k: (len(m), sorted(r[3] for r in m)[int(len(m) * 0.05)]) for k, m in _grouped(rows, 1, *_secs(spec)).items()}
    got = low_values.p05_by_group(spark.createDataFrame(rows, TX_SCHEMA), *spec).collect()
    assert {(r["card_id"], r["window_start"]): (r["n"], r["p05_value"]) for r in got} == want and len(got) == len(want)


def test_index_value_with_nulls_and_outliers(spark, monkeypatch):
    """Nulls sort first; values far apart do not make one bracket of all others."""
    base = EPOCH + dt.timedelta(days=20000)
    values = [None] * 3 + [Decimal(i) / 100 for i in range(400)] + [Decimal(10) ** 15, Decimal(-10) ** 15]
    rows = [(i, 1, base, v, 1, 2, 0.0, 0.0) for i, v in enumerate(values)] + [(900 + i, 2, base, None, 1, 2, 0.0, 0.0) for i in range(9)]
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    plain = sorted(map(str, low_values.p05_by_group(tx).collect()))
    monkeypatch.setattr(low_values, "SCAN_VALUES", 0)
    assert sorted(map(str, low_values.p05_by_group(tx).collect())) == plain and len(plain) == 2
    assert low_values.p05_by_group(tx.limit(0)).count() == 0


def test_a_hot_card_is_selected_over_many_tasks(spark):
    """300,000 distinct values of one card: no window of the plan runs over them all."""
    n = 300_000
    tx = spark.range(n).select(
        F.col("id").alias("seq"), F.lit(1).alias("card_id"), F.lit(EPOCH).cast("timestamp_ntz").alias("ts"),
        (F.pmod(F.col("id") * 7919, F.lit(n)) / 100).cast("decimal(18,2)").alias("value"),
        F.lit(1).alias("user_id"), F.lit(5).alias("lim"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    row, = low_values.p05_by_group(tx).collect()
    assert (row["n"], row["p05_index"], row["p05_value"]) == (n, 15000, Decimal("150"))
    hist = tx.groupBy("card_id", F.lit(0).alias("window_start"), F.lit(0).alias("window_end"), "value").agg(F.count(F.lit(1)).alias("c"))
    sizes = spark.createDataFrame([(1, 0, 0, n, 15000)], "card_id int, window_start int, window_end int, n long, at long")
    kept = low_values._bracketed(hist, sizes, ["card_id", "window_start", "window_end"]).count()
    assert kept < 3 * n / low_values.BRACKETS


def test_panes_repeat_no_rows(spark):
    """In sliding plans rows are aggregated by pane before anything repeats them (Expand)."""
    tx = spark.createDataFrame(_rows(1, 10), TX_SCHEMA)
    assert pane_seconds(tx, "24 hours", "9 hours") == 3 * 3600
    assert pane_seconds(tx, "1 day") is None and pane_seconds(tx, "1 month", "1 day") is None
    for build in (low_values.low_value_stats, low_values.p05_by_group):
        p = spark._jvm.PythonSQLUtils.explainString(build(tx, "7 days", "84 hours")._jdf.queryExecution(), "simple")
        lines = p.splitlines()
        repeats = [i for i, line in enumerate(lines) if "Expand" in line]
        aggregates = [i for i, line in enumerate(lines) if "HashAggregate(keys" in line and "pane_start" in line]
        assert repeats and all(any(a > i for a in aggregates) for i in repeats), p
