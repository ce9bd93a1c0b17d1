"""D3 in parts and J1 in segments: equal to the whole-group fold and scan, whatever the cuts."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from cardsentry.functions.geo import haversine_km
from cardsentry.operators import nearest
from cardsentry.operators.clustering import (clusters_by_part, far_parts, leader_clusters, with_cells,
                                             with_main_cluster)
from cardsentry.operators.nearest import nearest_in_time, with_segments
from cardsentry.operators.windows import assign_windows
from test_edge_cases import T0, mk

G = ["user_id", "window_start", "window_end"]


def scattered(seed, users):
    """User-days of 1 to 5 places, next to each other at about 100 km or far apart, at any latitude and around 180 degrees."""
    rnd = random.Random(seed)
    rows, seq = [], 0
    for u in range(users):
        lat0 = rnd.choice([rnd.uniform(-85, 85), rnd.uniform(80, 89.5), rnd.uniform(-1, 1)])
        lon0 = rnd.choice([rnd.uniform(-180, 180), rnd.uniform(179.0, 180.5), rnd.uniform(-180.5, -179)])
        places = [(lat0, lon0)]
        for _ in range(rnd.randint(0, 4)):
            lat, lon = rnd.choice(places)
            km = rnd.choice([60, 95, 99, 100.5, 102, 105, 110, 150, 300, 3000, 15000])
            turn = rnd.choice([0, 90, 180, 270, rnd.uniform(0, 360)])
            lat2 = max(-89.9, min(89.9, lat + math.degrees(km / 6371) * math.cos(math.radians(turn))))
            lon2 = lon + math.degrees(km / 6371) * math.sin(math.radians(turn)) / max(0.02, math.cos(math.radians(lat)))
            places.append((lat2, lon2 if rnd.random() < 0.7 else (lon2 + 180) % 360 - 180))
        spread = rnd.choice([0.0, 0.001, 0.05, 0.3, 0.6])
        for i in range(rnd.randint(1, 30)):
            lat, lon = rnd.choice(places)
            rows.append(dict(seq=seq, user_id=u, ts=T0 + dt.timedelta(seconds=rnd.choice([i, 60 * i, 0.4 * i])),
                             lat=max(-90.0, min(90.0, lat + rnd.uniform(-spread, spread))), lon=lon + rnd.uniform(-spread, spread)))
            seq += 1
    return rows


def labels(df, columns):
    return sorted((r.seq, *(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns)) for r in df.collect())


@pytest.mark.parametrize("seed,moving", [(1, True), (2, True), (3, False)])
def test_parts_give_the_whole_fold(spark, seed, moving):
    w = assign_windows(mk(spark, scattered(seed, 400)), "1 day").cache()
    whole = with_main_cluster(leader_clusters(w, G, update_centre=moving), G)
    apart = clusters_by_part(w, G, update_centre=moving)
    columns = ["cid", "run_n", "centre_lat", "centre_lon", "main_cid", "main_n", "n_clusters", "is_main"]
    assert labels(apart, columns) == labels(whole, columns)
    # groups left out have one cluster; parts that are not folded are numbered right
    some = clusters_by_part(w, G, update_centre=moving, suspects_only=True)
    kept = {r.seq for r in some.select("seq").collect()}
    columns = ["cid", "main_cid", "main_n", "n_clusters", "is_main"]
    want = labels(whole, columns)
    assert labels(some, columns) == [r for r in want if r[0] in kept]
    assert all(r[4] == 1 for r in want if r[0] not in kept)
    parts = far_parts(w, G)
    assert parts.where("many and single").count() > 100 and parts.where("not many").count() > 10


def test_parts_are_far_apart(spark):
    """Boxes of different parts of a group are over 100 km from each other, corner by corner."""
    w = with_cells(assign_windows(mk(spark, scattered(5, 300)), "1 day"))
    cells = far_parts(w.drop("_lat_cell", "_lon_cell"), G).select(*G, "_lat_cell", "_lon_cell", "part")
    boxes = w.join(cells, [*G, "_lat_cell", "_lon_cell"]).groupBy("user_id", "window_start", "part").agg(
        *(f(c).alias(f"{c}{k}") for c in ("lat", "lon") for k, f in enumerate((F.min, F.max))))
    a, b = boxes.alias("a"), boxes.alias("b")
    met = a.join(b, ["user_id", "window_start"]).where("a.part < b.part")
    corners = [haversine_km(F.col(f"a.lat{i}"), F.col(f"a.lon{j}"), F.col(f"b.lat{k}"), F.col(f"b.lon{m}")) for i in (0, 1) for j in (0, 1) for k in (0, 1) for m in (0, 1)]
    nearest_corner = met.select(F.least(*corners).alias("km")).agg(F.min("km").alias("km"), F.count("*").alias("n")).first()
    assert nearest_corner.n > 100 and nearest_corner.km > 100


def test_a_hot_spread_day_is_folded_in_many_tasks(spark):
    rows = [dict(seq=i, user_id=1, ts=T0 + dt.timedelta(seconds=i), lat=-80.0 + 2 * (i % 80), lon=(i // 80) * 0.9) for i in range(4000)]
    w = assign_windows(mk(spark, rows), "1 day")
    parts = far_parts(w, G)
    assert parts.select("part").distinct().count() == 80 and parts.where("many and not single").count() > 0
    whole = with_main_cluster(leader_clusters(w, G), G)
    columns = ["cid", "run_n", "main_cid", "n_clusters"]
    assert labels(clusters_by_part(w, G), columns) == labels(whole, columns)


@pytest.mark.parametrize("lat,lon", [(None, 5.0), (5.0, None), (None, None), (float("nan"), 5.0)])
def test_rows_without_a_position(spark, lat, lon):
    rows = [dict(seq=i, user_id=u, ts=T0 + dt.timedelta(seconds=i), lat=float(i % 3), lon=0.0) for u in (1, 2) for i in range(9)]
    df = mk(spark, [dict(r, seq=r["seq"] + 100 * r["user_id"]) for r in rows])
    odd = (df["user_id"] == 1) & (df["seq"] == 104)
    df = df.withColumn("lat", F.when(odd, F.lit(lat).cast("double")).otherwise(F.col("lat"))).withColumn("lon", F.when(odd, F.lit(lon).cast("double")).otherwise(F.col("lon")))
    w = assign_windows(df, "1 day")
    columns = ["cid", "run_n", "main_cid", "n_clusters"]
    assert labels(clusters_by_part(w, G), columns) == labels(with_main_cluster(leader_clusters(w, G), G), columns)


@pytest.mark.parametrize("seed", [1, 2])
def test_segments_give_the_whole_scan(spark, seed):
    """References and probes with equal instants and whole-second ties; any number of segments, empty ones too."""
    rnd = random.Random(seed)
    rows = []
    for u in range(25):
        at = 0.0
        for _ in range(rnd.randint(1, 120)):
            at += rnd.choice([0, 0, 0.1, 0.5, 0.9, 1.0, 3.3, 40, 700])
            rows.append(dict(seq=len(rows) if rnd.random() < 0.9 else 10_000 - len(rows), user_id=u, ts=T0 + dt.timedelta(seconds=at), lat=float(len(rows))))
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    w = assign_windows(mk(spark, rows), "1 day").withColumn("is_main", F.hash("seq", "lat") % 3 == 0)
    stats = w.groupBy(*G).agg(F.count(F.lit(1)).alias("_rows"), F.min(t).alias("_t0"), F.max(t).alias("_t1"))
    w = w.join(stats, G).cache()
    pick = lambda df: sorted((r.seq, r.ts, r.near.seq, r.near.ts, r.near.lat, r.near_key) for r in df.select("seq", "ts", "near", "near_key").collect())
    want = pick(nearest_in_time(w.drop("_rows", "_t0", "_t1"), G))
    assert len(want) > 300
    for segment_rows, min_us in ((10**9, nearest.MIN_SEGMENT_US), (20, nearest.MIN_SEGMENT_US), (1, nearest.MIN_SEGMENT_US), (1, 1)):
        cut = with_segments(w, segment_rows, min_us)
        assert (cut.agg(F.max("_k")).first()[0] > 1) == (segment_rows < 10**9)
        assert pick(nearest_in_time(cut, G)) == want
        assert nearest_in_time(cut, G).columns == nearest_in_time(w.drop("_rows", "_t0", "_t1"), G).columns
    everything = nearest_in_time(with_segments(w, 5), G, keep_all=True)
    assert everything.count() == w.count() and everything.where("is_main and near is not null").count() == 0


def test_detection_does_not_depend_on_the_segments(spark, monkeypatch):
    from cardsentry.operators.location import velocity_checks
    tx = mk(spark, scattered(9, 60))
    pick = lambda df: sorted((r.seq, r.near.seq, r.near_key, r.is_fraud) for r in df.collect())
    want = pick(velocity_checks(tx))
    monkeypatch.setattr(nearest, "SEGMENT_ROWS", 4)
    assert len(want) > 100 and pick(velocity_checks(tx)) == want
