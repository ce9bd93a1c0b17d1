"""The detection job as a DataFrame function: transactions in, alerts out.

``fraud_alerts`` is the bag union of the three windowed detectors, exactly as
the reference unions its three alert streams (a row may alert up to 3×).
The same function runs on a batch table or on complete windows handed over
by the streaming driver (see ``cardsentry.streaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.above_limit import detect_above_limit
from ..operators.alerts import above_limit, to_alerts, union_alerts
from ..operators.clustering import (leader_clusters, leader_clusters_skipping_single,
                                   with_main_cluster)
from ..operators.location import detect_location_jump, location_reason, with_velocity
from ..operators.low_values import detect_low_values
from ..operators.nearest import arrival_window, nearest_in_time
from ..operators.windows import WINDOW_COLS, assign_windows
from ..schema import (ABOVE_LIMIT_ALLOWED, ABOVE_LIMIT_SKIP, REASON_ABOVE_LIMIT, TX_COLUMNS, WINDOW_ABOVE_LIMIT,
                      WINDOW_LOCATION, WINDOW_LOW_VALUES)
from ..tables import stash


def fraud_alerts(tx: DataFrame,
                 above_limit_window: tuple[str, str | None] = (WINDOW_ABOVE_LIMIT, None),
                 low_values_window: tuple[str, str | None] = (WINDOW_LOW_VALUES, None),
                 location_window: tuple[str, str | None] = (WINDOW_LOCATION, None),
                 fuse: bool = False) -> DataFrame:
    """Union of D1, D2 and D3 alerts in the flat alert layout.

    Default: the detectors run on their own plans, over one pruned copy of the
    transactions in the shared folder: the source is read and parsed once, however
    costly (JSON, CSV), and not once per scan of a detector.  D1 and D2 are skew-safe
    (partial aggregates, map-side group limits); D3 sends to its sequential
    fold only the groups that may hold several clusters, so a hot user who
    stays in one area never reaches a single task.

    ``fuse=True`` (O3) computes D1 on D3's (user, day) partitioning when the
    windows agree: one scan and shuffle fewer, but every group then passes
    through one task, so use it only when no single user-day is huge (the
    streaming driver does, on micro-batches of closed windows).
    """
    from ..streaming.detect import _same  # window-spec comparison
    if fuse and _same(above_limit_window, location_window):
        return union_alerts(detect_low_values(tx, *low_values_window), user_day_alerts(tx, location_window, skip_single=False))
    tx = stash(tx.select(*TX_COLUMNS), "transactions")
    return union_alerts(
        detect_above_limit(tx, *above_limit_window),
        detect_low_values(tx, *low_values_window),
        detect_location_jump(tx, *location_window),
    )


def user_day_alerts(tx: DataFrame, window: tuple[str, str | None] = (WINDOW_LOCATION, None),
                    allowed: int = ABOVE_LIMIT_ALLOWED, skip: int = ABOVE_LIMIT_SKIP,
                    skip_single: bool = True) -> DataFrame:
    """D1 and D3 alerts of the same (user, window) groups in one pass.

    After the clustering fold, one set of window functions over the group
    gives both the above-limit rank (D1) and the nearest main row (D3); each
    row then yields 0, 1 or 2 alerts (bag semantics, as the union).
    ``skip_single`` lets provably single-cluster groups bypass the fold (it
    reads the input twice more: worth it when the input is cached, as a
    streaming micro-batch is)."""
    g = ["user_id", *WINDOW_COLS]
    w = assign_windows(tx, *window)
    clustered = leader_clusters_skipping_single(w, g) if skip_single else leader_clusters(w, g)
    groups = with_main_cluster(clustered, g)
    above = above_limit()
    # Rank among the above-limit rows = running count in arrival order; it
    # shares the sort of the nearest-in-time forward scan.
    running = arrival_window(g).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = arrival_window(g).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (groups.withColumn("_n_above", F.count_if(above).over(whole))
              .withColumn("_rank", F.count_if(above).over(running)))
    d1 = above & (F.col("_n_above") > F.lit(allowed)) & (F.col("_rank") > F.lit(skip))
    checked = with_velocity(nearest_in_time(ranked.withColumn("_d1", d1), g, "is_main", keep_all=True))
    hits = checked.where(F.col("_d1") | F.col("is_fraud"))
    reasons = F.filter(F.array(F.when(F.col("_d1"), F.lit(REASON_ABOVE_LIMIT)),
                               F.when(F.col("is_fraud"), location_reason())),
                       lambda r: r.isNotNull())
    exploded = hits.withColumn("fraud_reason", F.explode(reasons))
    return to_alerts(exploded, F.col("fraud_reason"), extra=WINDOW_COLS)


def group_location_alerts(tx: DataFrame, window: tuple[str, str | None] = (WINDOW_LOCATION, None)) -> DataFrame:
    """D3 alerts of groups that pass whole through one task each (the closed windows of a
    micro-batch): the fold, the main cluster and the nearest main row, without D3's parts and segments."""
    g = ["user_id", *WINDOW_COLS]
    groups = with_main_cluster(leader_clusters(assign_windows(tx, *window), g), g)
    checked = with_velocity(nearest_in_time(groups.where(F.col("n_clusters") > 1), g, "is_main"))
    return to_alerts(checked.where("is_fraud"), location_reason(), extra=WINDOW_COLS)
