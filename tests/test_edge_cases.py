"""Hand-made edge rows (FIXTURES.md F6) through the library's own operators."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardsentry.functions.geo import haversine_km
from cardsentry.functions.timefmt import format_2dp, local_datetime_text
from cardsentry.operators.above_limit import detect_above_limit
from cardsentry.operators.alerts import above_limit
from cardsentry.operators.location import (clustered_groups, detect_location_jump,
                                           suspects_with_nearest)
from cardsentry.operators.low_values import detect_low_values
from cardsentry.operators.trailing import detect_trailing_repeat
from cardsentry.operators.windows import assign_windows
from cardsentry.schema import TX_SCHEMA

T0 = dt.datetime(2024, 6, 2, 1, 0, 0)
EQ_KM_PER_DEG = 6371.0 * math.pi / 180.0


def mk(spark, rows):
    full = []
    for i, r in enumerate(rows):
        d = dict(seq=i, card_id=1, ts=T0, value=Decimal("10.00"), user_id=1, lim=100, lat=0.0, lon=0.0)
        d.update(r)
        d["value"] = Decimal(str(d["value"]))
        full.append(tuple(d[f.name] for f in TX_SCHEMA.fields))
    return spark.createDataFrame(full, TX_SCHEMA)


def test_at_the_limit_is_not_above(spark):
    df = mk(spark, [dict(value="100.00", lim=100), dict(value="100.01", lim=100)])
    assert [r[0] for r in df.orderBy("seq").select(above_limit()).collect()] == [False, True]


@pytest.mark.parametrize("n,expected", [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 2)])
def test_above_limit_group_sizes(spark, n, expected):
    rows = [dict(value="150.00", ts=T0 + dt.timedelta(minutes=i)) for i in range(n)]
    rows += [dict(value="5.00", ts=T0 + dt.timedelta(minutes=30 + i)) for i in range(3)]
    alerts = detect_above_limit(mk(spark, rows)).collect()
    assert len(alerts) == expected
    # the alerts are the 4th and later above-limit rows in arrival order
    assert sorted(a.seq for a in alerts) == list(range(3, n))


def test_above_limit_arrival_order_breaks_timestamp_ties(spark):
    rows = [dict(value="150.00", ts=T0, seq=s) for s in (7, 3, 9, 1, 5)]
    alerts = detect_above_limit(mk(spark, rows).drop("seq").withColumn(
        "seq", F.monotonically_increasing_id()).select(*TX_SCHEMA.fieldNames())).collect()
    assert len(alerts) == 2


def test_low_value_boundary(spark):
    rows = [dict(value="1.00")] + [dict(value="0.99", card_id=2)]
    alerts = detect_low_values(mk(spark, rows)).collect()
    assert [a.card_id for a in alerts] == [2]


@pytest.mark.parametrize("n,lows,flagged", [(19, 1, True), (20, 1, False), (21, 1, False), (20, 2, True)])
def test_p05_index_rule(spark, n, lows, flagged):
    rows = [dict(value="0.50", ts=T0 + dt.timedelta(minutes=i)) for i in range(lows)]
    rows += [dict(value="50.00", ts=T0 + dt.timedelta(minutes=100 + i)) for i in range(n - lows)]
    alerts = detect_low_values(mk(spark, rows)).collect()
    assert len(alerts) == (lows if flagged else 0)


def _trip(spark, km, hours, extra_main=()):
    """Main cluster of 3 rows at (0,0); one suspect ``km`` east on the equator,
    ``hours`` after the first main row."""
    lon = km / EQ_KM_PER_DEG
    rows = [dict(ts=T0), dict(ts=T0 + dt.timedelta(hours=10)), dict(ts=T0 + dt.timedelta(hours=11))]
    rows += list(extra_main)
    rows.append(dict(ts=T0 + dt.timedelta(hours=hours), lon=lon))
    return mk(spark, rows)


@pytest.mark.parametrize("km,kmh,alert", [(299.0, 160.0, True), (301.0, 160.0, False),
                                          (1000.0, 901.0, True), (1000.0, 899.0, False),
                                          (200.0, 149.0, False)])
def test_velocity_regimes(spark, km, kmh, alert):
    alerts = detect_location_jump(_trip(spark, km, km / kmh)).collect()
    assert len(alerts) == (1 if alert else 0)


def test_same_instant_is_infinite_velocity(spark):
    alerts = detect_location_jump(_trip(spark, 200.0, 0.0)).collect()
    assert len(alerts) == 1
    reason = alerts[0].fraud_reason
    assert "Time between is 0.00hours. Computed velocity is: Infinity for distance 200.00" in reason
    assert reason.endswith("One transaction timestamp is 2024-06-02T01:00 the second is 2024-06-02T01:00")


def test_one_cluster_gives_no_suspect(spark):
    rows = [dict(ts=T0 + dt.timedelta(minutes=i), lat=0.1 * i) for i in range(5)]
    assert suspects_with_nearest(mk(spark, rows)).count() == 0


def test_nearest_whole_second_tie_prefers_earliest(spark):
    base = T0 + dt.timedelta(hours=5)
    rows = [dict(ts=base - dt.timedelta(seconds=10.9)), dict(ts=base - dt.timedelta(seconds=10.2)),
            dict(ts=base + dt.timedelta(seconds=10.5)),
            dict(ts=base, lon=50.0)]
    s = suspects_with_nearest(mk(spark, rows)).collect()
    assert len(s) == 1
    assert s[0].near.ts == base - dt.timedelta(seconds=10.9)
    assert s[0].near_key == 10


def test_nearest_after_side_wins_when_closer(spark):
    base = T0 + dt.timedelta(hours=5)
    rows = [dict(ts=base - dt.timedelta(seconds=30)), dict(ts=base + dt.timedelta(seconds=12.7)),
            dict(ts=base + dt.timedelta(seconds=40)), dict(ts=base, lon=50.0)]
    s = suspects_with_nearest(mk(spark, rows)).collect()
    assert s[0].near.ts == base + dt.timedelta(seconds=12.7)
    assert s[0].near_key == 12


def test_first_created_cluster_wins(spark):
    # centres at lon 0 and lon 1.5 (167 km apart); the third point is < 100 km
    # from both and must join the first; then two clusters of 2: first is main.
    rows = [dict(ts=T0, lon=0.0), dict(ts=T0 + dt.timedelta(minutes=1), lon=1.5),
            dict(ts=T0 + dt.timedelta(minutes=2), lon=0.75),
            dict(ts=T0 + dt.timedelta(minutes=3), lon=1.6)]
    c = {r.seq: r for r in clustered_groups(mk(spark, rows)).collect()}
    assert [c[i].cid for i in range(4)] == [1, 2, 1, 2]
    assert c[0].main_cid == 1 and c[0].main_n == 2 and c[0].n_clusters == 2


def test_haversine_antipodes_never_nan(spark):
    df = spark.range(1).select(
        haversine_km(0.0, 0.0, 0.0, 180.0).alias("a"), haversine_km(45.0, 0.0, -45.0, 180.0).alias("b"),
        haversine_km(12.5, -71.25, 12.5, -71.25).alias("z"))
    r = df.first()
    assert round(r.a, 2) == 20015.09 and round(r.b, 2) == 20015.09 and r.z == 0.0


def test_reason_time_text_and_format(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 6, 2, 10, 0, 0), 0.125), (dt.datetime(2024, 6, 2, 10, 0, 3), 1.005),
         (dt.datetime(2024, 6, 2, 10, 0, 3, 179000), float("inf")),
         (dt.datetime(2024, 6, 2, 10, 0, 3, 179570), 2.0)], "ts timestamp_ntz, x double")
    got = [(r[0], r[1]) for r in df.select(local_datetime_text("ts"), format_2dp("x")).collect()]
    assert got == [("2024-06-02T10:00", "0.13"), ("2024-06-02T10:00:03", "1.01"),
                   ("2024-06-02T10:00:03.179", "Infinity"), ("2024-06-02T10:00:03.179570", "2.00")]


def test_seven_day_windows_start_on_thursday(spark):
    df = mk(spark, [dict(ts=dt.datetime(2024, 6, 5, 23, 59, 59)), dict(ts=dt.datetime(2024, 6, 6))])
    starts = [r.window_start for r in assign_windows(df, "7 days").orderBy("seq").collect()]
    assert starts == [dt.datetime(2024, 5, 30), dt.datetime(2024, 6, 6)]


@pytest.mark.parametrize("gap,alert", [(dt.timedelta(hours=24), True),
                                       (dt.timedelta(hours=24, seconds=1), False)])
def test_trailing_24h_is_inclusive(spark, gap, alert):
    rows = [dict(value="150.00", ts=T0), dict(value="150.00", ts=T0 + gap)]
    alerts = detect_trailing_repeat(mk(spark, rows)).collect()
    assert len(alerts) == (1 if alert else 0)
    if alert:
        assert alerts[0].fraud_reason.startswith("Użytkownik 1 ")


def test_trailing_reaches_across_midnight(spark):
    rows = [dict(value="150.00", ts=dt.datetime(2024, 6, 2, 23, 0)),
            dict(value="5.00", ts=dt.datetime(2024, 6, 3, 0, 30)),
            dict(value="150.00", ts=dt.datetime(2024, 6, 3, 1, 0))]
    assert [a.seq for a in detect_trailing_repeat(mk(spark, rows)).collect()] == [2]


@pytest.mark.parametrize("mains,expected", [
    # (offset seconds, seq) of main rows; the suspect is at offset 0 with seq 5
    ([(0.0, 7), (-0.5, 2), (30.0, 3)], -0.5),   # key 0 on both sides: earliest wins
    ([(0.0, 7), (0.3, 8), (30.0, 3)], 0.0),     # later arrival at the same instant
    ([(0.0, 1), (0.0, 7), (-40.0, 3)], 0.0),    # two at the same instant: first arrival
])
def test_nearest_with_references_at_the_same_instant(spark, mains, expected):
    base = T0 + dt.timedelta(hours=5)
    rows = [dict(ts=base + dt.timedelta(seconds=o), seq=s) for o, s in mains]
    rows.append(dict(ts=base, seq=5, lon=50.0))
    s = suspects_with_nearest(mk(spark, rows)).collect()
    assert len(s) == 1 and s[0].near_key == 0
    assert s[0].near.ts == base + dt.timedelta(seconds=expected)
    if expected == 0.0 and mains[0][1] == 1:
        assert s[0].near.seq == 1


def test_fixed_centre_variant(spark):
    """D5: with centres fixed at their first point, a point 94 km from the first
    point but 142 km from the moved centre joins instead of opening a cluster."""
    rows = [dict(ts=T0, lon=0.0), dict(ts=T0 + dt.timedelta(minutes=1), lon=0.85),
            dict(ts=T0 + dt.timedelta(minutes=2), lon=-0.85)]
    moving = {r.seq: r.cid for r in clustered_groups(mk(spark, rows)).collect()}
    fixed = {r.seq: r.cid for r in clustered_groups(mk(spark, rows), update_centre=False).collect()}
    assert [moving[i] for i in range(3)] == [1, 1, 2]
    assert [fixed[i] for i in range(3)] == [1, 1, 1]


def test_single_cluster_shortcut_is_sound(spark):
    """Groups the shortcut marks as single-cluster really fold into one
    cluster: random boxes of 1-200 km at any latitude, near the poles and
    across the antimeridian, plus the fixture."""
    import random
    from cardsentry.operators.clustering import single_cluster_groups
    from cardsentry.sources.fixture import load_tx
    from conftest import SF01
    rnd = random.Random(7)
    rows, seq = [], 0
    for u in range(1500):
        lat0 = rnd.choice([rnd.uniform(-89.5, 89.5), rnd.uniform(80, 89.9), rnd.uniform(-5, 5)])
        lon0 = rnd.choice([rnd.uniform(-180, 180), rnd.uniform(179.0, 180.5)])
        span = rnd.choice([0.01, 0.1, 0.4, 0.8, 1.5])
        for i in range(rnd.randint(1, 25)):
            lat = max(-90.0, min(90.0, lat0 + rnd.uniform(-span, span)))
            rows.append(dict(seq=seq, user_id=u, ts=T0 + dt.timedelta(minutes=i), lat=lat,
                             lon=lon0 + rnd.uniform(-span, span) / max(0.05, math.cos(math.radians(lat0)))))
            seq += 1
    for df in (mk(spark, rows), load_tx(spark, SF01)):
        g = ["user_id", "window_start", "window_end"]
        w = assign_windows(df, "1 day")
        single = single_cluster_groups(w, g)
        folded = clustered_groups(df).select(*g, "n_clusters").dropDuplicates(g)
        joined = single.join(folded, g)
        assert joined.where("single AND n_clusters <> 1").count() == 0
        assert joined.where("single").count() > 0          # the shortcut does fire


@pytest.mark.parametrize("n,expected", [(4, 0), (5, 4)])
def test_above_limit_allowed_above_skip(spark, n, expected):
    """allowed=4, skip=1: a group needs 5 above-limit rows, then rows 2..n alert."""
    rows = [dict(value="150.00", ts=T0 + dt.timedelta(minutes=i)) for i in range(n)]
    alerts = detect_above_limit(mk(spark, rows), allowed=4, skip=1).collect()
    assert sorted(a.seq for a in alerts) == list(range(1, n))[:expected]


def test_fold_state_survives_arrow_batch_boundaries(spark):
    """Groups spanning several Arrow batches fold exactly as in one batch."""
    from cardsentry.operators.location import velocity_checks
    from cardsentry.sources.fixture import load_tx
    from conftest import SF001
    tx = load_tx(spark, SF001)
    base = {(r.seq, r.near.seq, r.is_fraud) for r in velocity_checks(tx).collect()}
    clusters = {(r.seq, r.cid, r.run_n) for r in clustered_groups(tx).collect()}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        small = {(r.seq, r.near.seq, r.is_fraud) for r in velocity_checks(tx).collect()}
        small_clusters = {(r.seq, r.cid, r.run_n) for r in clustered_groups(tx).collect()}
    finally:
        spark.conf.set(key, old)
    assert base and small == base and small_clusters == clusters


@pytest.mark.parametrize("copies,below,want", [(6, 0, 3), (3, 0, 0), (4, 2, 3), (2, 2, 1), (2, 1, 0), (10, 3, 10)])
def test_above_limit_rows_that_repeat_time_and_seq(spark, copies, below, want):
    """Rows with one (ts, seq) are counted one by one: the first three of the group are spared."""
    from cardsentry.operators.above_limit import detect_above_limit
    early = [(i, 1, dt.datetime(2024, 6, 1, 7, i), 50.0, 1, 10, 0.0, 0.0) for i in range(below)]
    same = [(99, 1, dt.datetime(2024, 6, 1, 8), 50.0, 1, 10, 0.0, 0.0)] * copies
    df = spark.createDataFrame(early + same, "seq long, card_id int, ts timestamp_ntz, value double, user_id int, lim int, lat double, lon double")
    df = df.withColumn("value", F.col("value").cast("decimal(18,2)"))
    assert detect_above_limit(df).count() == want
    assert detect_above_limit(df, "24 hours", None, 4, 3).count() == (want if copies + below > 4 else 0)


def test_trailing_rule_is_linear_in_a_hot_user_day(spark):
    """60,000 above-limit rows of one user-day: a quadratic plan takes minutes."""
    import time
    from cardsentry.operators.trailing import detect_trailing_repeat
    rows = spark.range(60_000).select(
        F.col("id").alias("seq"), F.lit(1).alias("card_id"),
        F.expr("TIMESTAMP_NTZ'2024-06-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        F.lit("50.00").cast("decimal(18,2)").alias("value"), F.lit(1).alias("user_id"), F.lit(10).alias("lim"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    t0 = time.perf_counter()
    assert detect_trailing_repeat(rows).count() == 59_999
    assert time.perf_counter() - t0 < 60
