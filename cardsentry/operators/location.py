"""Sudden location change detector (D3).

Per (user, day) window: leader clustering of the positions (A5), the largest
cluster is the main one (A6), every row of the other clusters is a suspect
(A7).  For a suspect, the main-cluster row nearest in time (J1) gives distance
(haversine), time (whole ms, in hours) and velocity; too fast for the distance
regime (F6) means an alert whose reason spells the numbers out (G7–G9).
A group with one cluster has no suspect.

Plan: rows reduced to grid cells → cells cut into far-apart parts → rows joined
with their part → the fold per part (``mapInPandas``, O(#clusters) state) of those
that may hold several clusters → a written table → clusters numbered from one row
each, and joined back → nearest scans in segments of a group → expressions.  No
group is collected or passes whole through one task, no pair is formed, and only
the fold is Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km, too_fast, velocity_kmh
from ..functions.timefmt import abs_hours_from_millis, format_2dp, local_datetime_text
from ..schema import (MAX_CENTRE_DISTANCE_KM, REASON_LOCATION_DISTANCE, REASON_LOCATION_FIRST_TS,
                      REASON_LOCATION_HOURS, REASON_LOCATION_PREFIX, REASON_LOCATION_SECOND_TS,
                      WINDOW_LOCATION)
from .alerts import to_alerts
from .clustering import clusters_by_part
from . import nearest
from .windows import WINDOW_COLS, assign_windows

KEY = "user_id"


def clustered_groups(tx: DataFrame, length: str = WINDOW_LOCATION, slide: str | None = None,
                     key: str = KEY, max_km: float = MAX_CENTRE_DISTANCE_KM,
                     update_centre: bool = True) -> DataFrame:
    """Every row with its cluster (``cid``, ``run_n``, running centre) and the
    group's ``main_cid``, ``main_n``, ``n_clusters``, ``is_main``."""
    g = [key, *WINDOW_COLS]
    w = assign_windows(tx, length, slide)
    return clusters_by_part(w, g, max_km, update_centre)


def suspects_with_nearest(tx: DataFrame, length: str = WINDOW_LOCATION, slide: str | None = None,
                          key: str = KEY) -> DataFrame:
    """Suspects (rows outside the main cluster of a multi-cluster group) with
    the nearest main row ``near`` and ``near_key``.

    Groups that provably form a single cluster have no suspect and are dropped
    before the fold; a hot group is searched in segments of time."""
    g = [key, *WINDOW_COLS]
    w = assign_windows(tx, length, slide)
    rows = clusters_by_part(w, g, suspects_only=True, large_group=nearest.SEGMENT_ROWS).where(F.col("n_clusters") > 1)
    return nearest.nearest_in_time(nearest.with_segments(rows), g, "is_main")


def with_velocity(s: DataFrame) -> DataFrame:
    """Add ``distance_km``, ``hours``, ``velocity`` and ``is_fraud`` to rows
    carrying their nearest main row ``near`` (NULL ``near`` -> not fraud)."""
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("near.lat"), F.col("near.lon"))
    hours = abs_hours_from_millis(F.col("near.ts"), F.col("ts"))
    s = (s.withColumn("distance_km", dist)
         .withColumn("hours", hours)
         .withColumn("velocity", velocity_kmh(F.col("distance_km"), F.col("hours"))))
    return s.withColumn("is_fraud", F.coalesce(too_fast(F.col("distance_km"), F.col("velocity")),
                                               F.lit(False)))


def velocity_checks(tx: DataFrame, length: str = WINDOW_LOCATION, slide: str | None = None,
                    key: str = KEY) -> DataFrame:
    """Suspects with ``distance_km``, ``hours``, ``velocity`` and ``is_fraud``."""
    return with_velocity(suspects_with_nearest(tx, length, slide, key))


def location_reason(hours="hours", velocity="velocity", distance="distance_km",
                    main_ts="near.ts", suspect_ts="ts"):
    return F.concat(
        F.lit(REASON_LOCATION_PREFIX), format_2dp(hours),
        F.lit(REASON_LOCATION_HOURS), format_2dp(velocity),
        F.lit(REASON_LOCATION_DISTANCE), format_2dp(distance),
        F.lit(REASON_LOCATION_FIRST_TS), local_datetime_text(main_ts),
        F.lit(REASON_LOCATION_SECOND_TS), local_datetime_text(suspect_ts))


def detect_location_jump(tx: DataFrame, length: str = WINDOW_LOCATION, slide: str | None = None,
                         key: str = KEY) -> DataFrame:
    """Flat alerts (tx columns, above_limit, fraud_reason, window_start, window_end)."""
    checks = velocity_checks(tx, length, slide, key).where("is_fraud")
    return to_alerts(checks, location_reason(), extra=WINDOW_COLS)
