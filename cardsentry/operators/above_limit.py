"""Repeated above-limit detector (D1) and skip-k selection (R1).

Rule: per (user, window), take the rows with ``value > limit`` in arrival
order (``ts``, then ``seq``).  A group with at most ``allowed`` such rows is
fine; otherwise every row from index ``skip`` on (the 4th and later with the
defaults) is an alert.  With the defaults a group of 2 crashes the reference
(``subList(3, 2)``); here it yields no alert.

Plan: rank > skip  ⇔  (ts, seq) > the skip-th smallest (ts, seq) of the group.
* ``n`` per group: partial aggregate (only when ``allowed > skip``: otherwise
  a rank above ``skip`` implies ``n > allowed``).
* the first ``skip`` (+1) rows per group: ``row_number() <= k``, which Spark
  plans with a *partial* ``WindowGroupLimit`` below the shuffle, so each map
  task sends at most k rows per group; the max of the first ``skip`` is the
  threshold, and a (skip+1)-th row shows the group has alerts at all (only
  those groups keep a threshold).
* alert rows: above-limit rows joined with the per-group thresholds, each
  group's rows dealt over several tasks (``skew.join_stats``).
* sliding windows: counts and first rows are taken per pane (``windows.py``), so at
  most skip+1 rows a pane are repeated per window, and alert rows only for windows
  that have a threshold.
* rows that repeat (ts, seq) may straddle the threshold.  Only in groups where
  the (skip+1)-th row ties with the skip-th, the tied rows are ranked among
  themselves and those beyond the threshold are alerts too.
Nothing collects a group; a hot user is pre-aggregated on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ABOVE_LIMIT_ALLOWED, ABOVE_LIMIT_SKIP, REASON_ABOVE_LIMIT, WINDOW_ABOVE_LIMIT
from .alerts import above_limit, to_alerts
from .skew import join_stats
from .windows import PANE, WINDOW_COLS, assign_windows, pane_seconds, panes_of_windows, with_pane

KEY = "user_id"
ORDER = ["ts", "seq"]


def above_limit_ranked(tx: DataFrame, length: str = WINDOW_ABOVE_LIMIT, slide: str | None = None,
                       allowed: int = ABOVE_LIMIT_ALLOWED, skip: int = ABOVE_LIMIT_SKIP,
                       key: str = KEY, with_count: bool = True) -> DataFrame:
    """Above-limit rows of groups with ``n > allowed`` whose rank is above
    ``skip``, with the window; ``with_count`` adds ``n`` (the group's
    above-limit count).

    Without ``with_count`` and with ``allowed <= skip`` (the defaults), a rank
    above ``skip`` already implies ``n > allowed``, so the count aggregate,
    its scan and its join are left out."""
    g = [key, *WINDOW_COLS]
    pane = pane_seconds(tx, length, slide)
    above = tx.where(above_limit())
    above = with_pane(above, pane) if pane else assign_windows(above, length, slide)

    def with_stats(stats: DataFrame) -> DataFrame:
        """Above-limit rows with their windows' statistics."""
        if pane:
            return join_stats(above, panes_of_windows(stats, pane), [key, PANE]).drop(PANE)
        return join_stats(above, stats, g)

    counts = None
    if with_count or allowed > skip or skip <= 0:
        if pane:
            per_pane = above.groupBy(key, PANE).agg(F.count(F.lit(1)).alias("n"))
            counts = assign_windows(per_pane, length, slide, time_col=PANE).groupBy(*g).agg(F.sum("n").alias("n"))
        else:
            counts = above.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.where(F.col("n") > F.lit(allowed))
    if skip <= 0:
        return with_stats(counts)
    # The first skip+1 rows tell the threshold, whether any row is ranked above
    # it (only those groups keep one: the join's build side is bounded by the
    # alerting groups), and whether it is tied.
    order = Window.partitionBy(*g).orderBy(*ORDER)
    head = above
    if pane:
        # a window's first rows are among the first rows of its panes
        in_pane = Window.partitionBy(key, PANE).orderBy(*ORDER)
        head = (above.select(key, PANE, *ORDER).withColumn("_rn", F.row_number().over(in_pane))
                .where(F.col("_rn") <= skip + 1))
        head = assign_windows(head, length, slide, time_col=PANE)
    first = (head.select(*g, *ORDER)
             .withColumn("_rn", F.row_number().over(order)).withColumn("_rank", F.rank().over(order))
             .where(F.col("_rn") <= skip + 1))
    key_ = F.struct(*ORDER)
    stats = (first.groupBy(*g)
             .agg(F.count(F.lit(1)).alias("_m"), F.max(key_).alias("_next"),
                  F.max(F.when(F.col("_rn") <= skip, F.struct(*ORDER, "_rank"))).alias("_last"))
             .where(F.col("_m") > F.lit(skip))
             .withColumn("_kth", F.struct(*[F.col(f"_last.{c}").alias(c) for c in ORDER]))
             .select(*g, "_kth", (F.col("_kth") == F.col("_next")).alias("_tied"),
                     (F.col("_last._rank") - 1).alias("_below")))
    if counts is not None:
        stats = stats.join(counts, g, "inner")
    at_kth = key_ == F.col("_kth")
    late = with_stats(stats).where((key_ > F.col("_kth")) | (F.col("_tied") & at_kth))
    # rows that share (ts, seq) are told apart only where the threshold falls among them
    twins = Window.partitionBy(*g, *ORDER).orderBy(*[c for c in tx.columns if c not in (key, *ORDER)])
    return (late.withColumn("_rn", F.row_number().over(twins))
            .where(~at_kth | (F.col("_rn") + F.col("_below") > F.lit(skip)))
            .drop("_kth", "_tied", "_below", "_rn"))


def detect_above_limit(tx: DataFrame, length: str = WINDOW_ABOVE_LIMIT, slide: str | None = None,
                       allowed: int = ABOVE_LIMIT_ALLOWED, skip: int = ABOVE_LIMIT_SKIP,
                       key: str = KEY) -> DataFrame:
    """Flat alerts (tx columns, above_limit, fraud_reason, window_start, window_end)."""
    rows = above_limit_ranked(tx, length, slide, allowed, skip, key, with_count=False)
    return to_alerts(rows, REASON_ABOVE_LIMIT, extra=WINDOW_COLS)
