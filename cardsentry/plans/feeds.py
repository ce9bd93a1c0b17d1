"""Backtest feeds: the data half of the reference's chart scripts (C1–C4).

Each feed covers every card; pass ``cards=[...]`` to restrict it (the filter
is applied before any shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import days_since_epoch
from ..operators.alerts import above_limit
from ..operators.skew import join_stats
from ..schema import CHART_LOW_VALUE, LOCATION_REASON_PATTERN, VALUE_TYPE


def _cards(df: DataFrame, cards, col: str = "card_id") -> DataFrame:
    return df if cards is None else df.where(F.col(col).isin(list(cards)))


def first_limit_per_card(tx: DataFrame) -> DataFrame:
    """The limit on each card's first row (by ts, then seq): a partial
    aggregate (``min_by``), one small row per card crosses the shuffle."""
    return tx.groupBy("card_id").agg(F.min_by("lim", F.struct("ts", "seq")).alias("limit0"))


def feed_above_limit(tx: DataFrame, cards=None) -> DataFrame:
    """(card, ts, value, limit0, value > limit0) with limit0 from the card's first row."""
    tx = _cards(tx, cards)
    lim0 = first_limit_per_card(tx)
    return (join_stats(tx, lim0, ["card_id"])
            .select("card_id", "seq", "ts", "value", "limit0",
                    above_limit("value", "limit0").alias("above_limit0")))


def feed_low_values(tx: DataFrame, cards=None, low_value: str = CHART_LOW_VALUE) -> DataFrame:
    """(card, ts, value, value < 0.5): the chart's own threshold, not the detector's."""
    return _cards(tx, cards).select(
        "card_id", "seq", "ts", "value",
        (F.col("value") < F.lit(low_value).cast(VALUE_TYPE)).alias("is_low"))


def feed_positions(tx: DataFrame, cards=None) -> DataFrame:
    """(card, lon, lat, days since epoch) for position-over-time charts."""
    return _cards(tx, cards).select("card_id", "seq", "lon", "lat",
                                    days_since_epoch("ts").alias("days"))


def alerts_by_reason(alerts: DataFrame, pattern: str = LOCATION_REASON_PATTERN) -> DataFrame:
    """Alerts whose reason matches a regular expression (search, not full match)."""
    return alerts.where(F.col("fraud_reason").rlike(pattern))


def feed_location_alerts(alerts: DataFrame, cards=None,
                         pattern: str = LOCATION_REASON_PATTERN) -> DataFrame:
    """Location alerts with (card, lon, lat, days since epoch)."""
    hits = _cards(alerts_by_reason(alerts, pattern), cards)
    return hits.select("card_id", "seq", "lon", "lat", days_since_epoch("ts").alias("days"),
                       "fraud_reason")
