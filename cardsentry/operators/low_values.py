"""Low-values detector (D2) and the index percentile (A3).

Rule: per (card, window), sort the values; if the value at index
``floor(n * 0.05)`` is below 1.0, every row below 1.0 is an alert.

Plan (O2): ``sorted[floor(0.05 n)] < 1.0``  ⇔  ``count(value < 1.0) > floor(0.05 n)``,
so the detector needs two partial aggregates per group (map-side combined,
one small row per group crosses the shuffle) and a semi join of the low rows
with the flagged groups.  No group is ever collected or sorted; a card that
holds a third of all rows costs the same as any other.  Sliding windows are
counted by pane (``windows.py``): no row is repeated per window before its window
is flagged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import (LOW_VALUE_PERCENT, LOW_VALUE_THRESHOLD, REASON_LOW_VALUES,
                      VALUE_TYPE, WINDOW_LOW_VALUES)
from .alerts import to_alerts
from .skew import join_stats
from .windows import PANE, WINDOW_COLS, assign_windows, pane_seconds, panes_of_windows, with_pane

KEY = "card_id"


def _is_low(threshold: str = LOW_VALUE_THRESHOLD):
    # Compare as DECIMAL; the literal keeps the value's scale.
    return F.col("value") < F.lit(threshold).cast(VALUE_TYPE)


def p05_index(n) -> "F.Column":
    """``(int)(n * 0.05)`` in double arithmetic, as the reference computes it."""
    return F.floor(n.cast("double") * F.lit(LOW_VALUE_PERCENT)).cast("long")


def low_value_stats(tx: DataFrame, length: str = WINDOW_LOW_VALUES, slide: str | None = None,
                    key: str = KEY) -> DataFrame:
    """Per (key, window): ``n``, ``n_low``, ``p05_index`` and ``flagged``."""
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(_is_low()).alias("n_low")]
    pane = pane_seconds(tx, length, slide)
    if pane:
        per_pane = with_pane(tx, pane).groupBy(key, PANE).agg(*counts)
        w = assign_windows(per_pane, length, slide, time_col=PANE)
        counts = [F.sum(c).alias(c) for c in ("n", "n_low")]
    else:
        w = assign_windows(tx, length, slide)
    return (w.groupBy(key, *WINDOW_COLS).agg(*counts)
            .withColumn("p05_index", p05_index(F.col("n")))
            .withColumn("flagged", F.col("n_low") > F.col("p05_index")))


def detect_low_values(tx: DataFrame, length: str = WINDOW_LOW_VALUES, slide: str | None = None,
                      key: str = KEY) -> DataFrame:
    """Flat alerts (tx columns, above_limit, fraud_reason, window_start, window_end)."""
    pane = pane_seconds(tx, length, slide)
    w = tx if pane else assign_windows(tx, length, slide)
    flagged = (low_value_stats(w, length, slide, key)
               .where("flagged").select(key, *WINDOW_COLS))
    lows = w.where(_is_low())
    if pane:
        hits = join_stats(with_pane(lows, pane), panes_of_windows(flagged, pane), [key, PANE])
    else:
        hits = join_stats(lows, flagged, [key, *WINDOW_COLS], how="left_semi")
    return to_alerts(hits, REASON_LOW_VALUES, extra=WINDOW_COLS)


#: A group with more distinct values than this is cut into ``BRACKETS`` value brackets first.
SCAN_VALUES = 100_000
BRACKETS = 256


def _at_index(hist: DataFrame, g: list[str], cols: list[str]) -> DataFrame:
    """Rows of ``hist`` (``c`` rows each, ordered by ``cols``) that hold a group's index
    ``at``; ``before`` rows of the group are ahead of all of them."""
    running = Window.partitionBy(*g).orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    return (hist.withColumn("cum", F.sum("c").over(running) + F.col("before"))
            .where((F.col("cum") > F.col("at")) & (F.col("cum") - F.col("c") <= F.col("at"))))


def _bracketed(hist: DataFrame, sizes: DataFrame, g: list[str]) -> DataFrame:
    """The values of each group of ``sizes`` in the bracket that holds the index.

    Brackets are cut at approximate quantiles of the distinct values (a mergeable
    sketch, so partial aggregates), but counted exactly: a rough cut makes brackets
    uneven, never a result wrong.  Rows are dealt by value, no task sees a group whole;
    the window over a group's brackets has at most ``BRACKETS`` rows.
    """
    rows = join_stats(hist, sizes, g, spread="value")
    at = [i / BRACKETS for i in range(1, BRACKETS)]
    # merged, as the rows must be the streamed side: the other way round a task buffers a cuts array per row
    cuts = rows.groupBy(*g).agg(F.percentile_approx("value", at, 10 * BRACKETS).alias("cuts")).hint("merge")
    dealt = (join_stats(rows, cuts, g, spread="value")
             # the smallest values (and nulls, which sort first) are in bracket 0
             .withColumn("bracket", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("value"))), F.lit(0)))
             .drop("cuts"))
    counts = (dealt.groupBy(*g, "bracket").agg(F.sum("c").alias("c"), F.first("at").alias("at"))
              .withColumn("before", F.lit(0)))
    chosen = _at_index(counts, g, ["bracket"]).select(*g, "bracket", (F.col("cum") - F.col("c")).alias("before"))
    return join_stats(dealt, chosen, [*g, "bracket"], spread="value").drop("bracket")


def p05_by_group(tx: DataFrame, length: str = WINDOW_LOW_VALUES, slide: str | None = None,
                 key: str = KEY) -> DataFrame:
    """The exact index percentile per (key, window).

    Rows are first reduced to a histogram ``(group, value) -> count`` with a
    partial aggregate.  The value at index ``floor(0.05 n)`` is then found by an
    ordered scan over the group's distinct values, or, in a group of over
    ``SCAN_VALUES`` of them, over those of the one value bracket that holds the
    index (``_bracketed``).  A count of the groups' rows tells beforehand whether that
    branch is needed.  Null values sort first.
    """
    g = [key, *WINDOW_COLS]
    pane = pane_seconds(tx, length, slide)
    if pane:
        per_pane = with_pane(tx, pane).groupBy(key, PANE, "value").agg(F.count(F.lit(1)).alias("c"))
        hist = assign_windows(per_pane, length, slide, time_col=PANE).groupBy(*g, "value").agg(F.sum("c").alias("c"))
    else:
        hist = assign_windows(tx, length, slide).groupBy(*g, "value").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*g)

    def scanned(rows: DataFrame) -> DataFrame:
        rows = (rows.withColumn("n", F.sum("c").over(whole)).withColumn("at", p05_index(F.col("n")))
                .withColumn("before", F.lit(0).cast("long")))
        return _at_index(rows, g, ["value"]).select(*g, "value", "n", "at")

    # a group has at most as many distinct values as rows
    if low_value_stats(tx, length, slide, key).where(F.col("n") > F.lit(SCAN_VALUES)).isEmpty():
        found = scanned(hist)
    else:
        sizes = (hist.groupBy(*g).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("values"))
                 .withColumn("at", p05_index(F.col("n"))))
        large = sizes.where(F.col("values") > F.lit(SCAN_VALUES)).select(*g, "n", "at")
        found = scanned(join_stats(hist, large.select(*g), g, spread="value", how="left_anti")).unionByName(
            _at_index(_bracketed(hist, large, g), g, ["value"]).select(*g, "value", "n", "at"))
    return found.select(*g, "n", F.col("at").alias("p05_index"), F.col("value").alias("p05_value"),
                        (F.col("value") < F.lit(LOW_VALUE_THRESHOLD).cast(VALUE_TYPE)).alias("flagged"))
