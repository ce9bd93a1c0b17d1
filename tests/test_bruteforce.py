"""Randomized checks against direct Python statements of the rules, on data
full of ties (equal timestamps, equal whole seconds, points near 100 km),
which the fixture does not exercise."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from cardsentry.operators.above_limit import detect_above_limit
from cardsentry.operators.clustering import haversine_py
from cardsentry.operators.location import velocity_checks
from cardsentry.operators.trailing import detect_trailing_repeat
from cardsentry.schema import TX_SCHEMA

DAY = dt.datetime(2024, 6, 2)


def _rows(seed: int, users: int = 6, per_user: int = 45):
    rnd = random.Random(seed)
    rows, seq = [], 0
    for u in range(users):
        home = (rnd.uniform(-60, 60), rnd.uniform(-170, 170))
        seconds = [rnd.randint(0, 86399 * 2) for _ in range(per_user)]
        for i in range(per_user):
            s = seconds[i] if rnd.random() > 0.2 else seconds[max(0, i - 1)]        # exact ties
            frac = rnd.choice([0, 0, 200_000, 500_000, 900_000, 999_999])
            ts = DAY + dt.timedelta(seconds=s, microseconds=frac)
            if rnd.random() < 0.25:                                                 # far away
                d = rnd.choice([0.9, 1.5, 3.0, 9.0])
                lat, lon = home[0] + rnd.uniform(-d, d), home[1] + rnd.uniform(-d, d)
            else:
                lat, lon = home[0] + rnd.uniform(-0.4, 0.4), home[1] + rnd.uniform(-0.4, 0.4)
            lim = 100
            value = Decimal(rnd.choice(["150.00", "20.00", "100.00", "100.01"]))
            rows.append((seq, u, ts, value, u, lim, lat, lon))
            seq += 1
    rnd.shuffle(rows)                                   # arrival order is seq, not list order
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, TX_SCHEMA)


def _key(r):
    return (r[2], r[0])                                 # (ts, seq)


def _by_group(rows, window_days=1):
    groups = {}
    for r in rows:
        start = dt.datetime.combine(r[2].date(), dt.time()) if window_days == 1 else None
        groups.setdefault((r[4], start), []).append(r)
    return {k: sorted(v, key=_key) for k, v in groups.items()}


def brute_d1(rows):
    out = set()
    for grp in _by_group(rows).values():
        above = [r for r in grp if r[3] > r[5]]
        if len(above) > 1:
            out |= {r[0] for r in above[3:]}
    return out


def brute_w1(rows):
    out = set()
    by_user = {}
    for r in rows:
        by_user.setdefault(r[4], []).append(r)
    for grp in by_user.values():
        grp.sort(key=_key)
        above = [r for r in grp if r[3] > r[5]]
        for i, r in enumerate(above):
            n = sum(1 for e in above[: i + 1] if e[2] >= r[2] - dt.timedelta(hours=24))
            if n >= 2:
                out.add(r[0])
    return out


def _micros(a, b):
    return (b - a) // dt.timedelta(microseconds=1)


def brute_d3(rows):
    """Leader clustering in arrival order, first-created wins; main = first
    largest; nearest main by truncated whole seconds, stable by time."""
    result = {}
    for grp in _by_group(rows).values():
        clusters = []                                   # [lat, lon, members]
        for r in grp:
            for c in clusters:
                if haversine_py(c[0], c[1], r[6], r[7]) < 100.0:
                    n = len(c[2])
                    c[0] = (c[0] * n + r[6]) / (n + 1)
                    c[1] = (c[1] * n + r[7]) / (n + 1)
                    c[2].append(r)
                    break
            else:
                clusters.append([r[6], r[7], [r]])
        if len(clusters) <= 1:
            continue
        main = max(clusters, key=lambda c: len(c[2]))
        mains = sorted(main[2], key=lambda m: m[2])     # stable: ties keep arrival order
        for c in clusters:
            if c is main:
                continue
            for s in c[2]:
                near = min(mains, key=lambda m: abs(_micros(m[2], s[2])) // 1_000_000)
                hours = (abs(_micros(near[2], s[2])) // 1000) / 3_600_000.0
                dist = haversine_py(s[6], s[7], near[6], near[7])
                vel = dist / hours if hours else (math.inf if dist > 0 else math.nan)
                fraud = (not math.isnan(vel)) and (vel > 150 if dist < 300 else vel > 900)
                result[s[0]] = (near[0], fraud)
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_d1_with_ties(spark, seed):
    rows = _rows(seed)
    got = {r.seq for r in detect_above_limit(_df(spark, rows)).collect()}
    assert got == brute_d1(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_w1_with_ties(spark, seed):
    rows = _rows(seed)
    got = {r.seq for r in detect_trailing_repeat(_df(spark, rows)).collect()}
    assert got == brute_w1(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_d3_with_ties(spark, seed):
    rows = _rows(seed)
    want = brute_d3(rows)
    got = {r.seq: (r.near.seq, r.is_fraud) for r in velocity_checks(_df(spark, rows)).collect()}
    assert len(want) > 0
    assert got == want


def brute_d2(rows):
    """Per (card, 7-day window from Thursday 1970-01-01): sort values, read
    index floor(n * 0.05); if below 1.0, every value below 1.0 alerts."""
    epoch = dt.datetime(1970, 1, 1)
    groups = {}
    for r in rows:
        start = (r[2] - epoch) // dt.timedelta(days=7)
        groups.setdefault((r[1], start), []).append(r)
    out = set()
    for grp in groups.values():
        values = sorted(r[3] for r in grp)
        if values[int(len(values) * 0.05)] < Decimal("1.0"):
            out |= {r[0] for r in grp if r[3] < Decimal("1.0")}
    return out


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_d2_index_rule_random_groups(spark, seed):
    from cardsentry.operators.low_values import detect_low_values
    rnd = random.Random(seed)
    rows, seq = [], 0
    for card in range(60):
        n = rnd.choice([1, 5, 19, 20, 21, 39, 40, 41, 60])
        low_share = rnd.choice([0.0, 0.02, 0.05, 0.1, 0.3])
        for _ in range(n):
            ts = DAY + dt.timedelta(days=rnd.randint(-10, 10), seconds=rnd.randint(0, 86399))
            v = Decimal(rnd.choice(["0.50", "0.99"])) if rnd.random() < low_share else \
                Decimal(rnd.choice(["1.00", "5.00", "50.00"]))
            rows.append((seq, card, ts, v, card, 100, 0.0, 0.0))
            seq += 1
    want = brute_d2(rows)
    got = {r.seq for r in detect_low_values(_df(spark, rows)).collect()}
    assert len(want) > 0 and got == want


@pytest.mark.parametrize("bucket_hours", [6, 24, 48])
def test_w1_bucket_sizes_agree(spark, bucket_hours):
    rows = _rows(2)
    got = {r.seq for r in detect_trailing_repeat(_df(spark, rows), bucket_hours=bucket_hours).collect()}
    assert got == brute_w1(rows)


@pytest.mark.parametrize("parts", [7, 32])
def test_d1_map_side_limit_over_many_partitions(spark, parts):
    """Each group's rows spread over many map tasks: the partial
    WindowGroupLimit keeps 3 per task, the final one picks the true first 3."""
    rows = _rows(5, users=4, per_user=80)
    df = _df(spark, rows).repartition(parts)
    got = {r.seq for r in detect_above_limit(df).collect()}
    assert got == brute_d1(rows) and got


def test_w1_and_d3_over_many_partitions(spark):
    rows = _rows(6)
    df = _df(spark, rows).repartition(24)
    assert {r.seq for r in detect_trailing_repeat(df).collect()} == brute_w1(rows)
    got = {r.seq: (r.near.seq, r.is_fraud) for r in velocity_checks(df).collect()}
    assert got == brute_d3(rows)
