"""Alert projections: derived flag (P3), alert wrapping (P2), union (U1),
nested alert struct (S4 input) and recursive flattening to dotted names (P1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ALERT_COLUMNS, TX_COLUMNS


def above_limit(value="value", lim="lim") -> Column:
    """``value > limit``, strict; decimal against int compares exactly."""
    v = F.col(value) if isinstance(value, str) else value
    lm = F.col(lim) if isinstance(lim, str) else lim
    return v > lm


def to_alerts(rows: DataFrame, reason, extra: list[str] | None = None) -> DataFrame:
    """Wrap transaction rows into flat alerts ``(tx columns, above_limit, fraud_reason)``.

    ``reason`` is a constant string or a column expression.
    """
    reason_col = reason if isinstance(reason, Column) else F.lit(reason)
    cols = [F.col(c) for c in TX_COLUMNS] + [above_limit().alias("above_limit"),
                                             reason_col.alias("fraud_reason")]
    cols += [F.col(c) for c in (extra or [])]
    return rows.select(*cols)


def union_alerts(*alerts: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Bag union (UNION ALL) of alert streams; a row may alert once per detector.
    ``extra`` columns (e.g. the window bounds) are kept when every input has them."""
    cols = ALERT_COLUMNS + list(extra or [])
    return reduce(lambda a, b: a.unionByName(b), [a.select(*cols) for a in alerts])


def transaction_struct(prefix: str = "", ts_as_text: bool = False) -> Column:
    """The wire-form transaction record ``{cardId, timestamp, value, userId,
    limit, localization{latitude, longitude}, aboveLimit}``; with
    ``ts_as_text`` the timestamp is ISO_LOCAL_DATE_TIME text (for JSON)."""
    from ..functions.timefmt import iso_local_datetime_text
    p = prefix
    ts = iso_local_datetime_text(F.col(p + "ts")) if ts_as_text else F.col(p + "ts")
    return F.struct(
        F.col(p + "card_id").alias("cardId"),
        ts.alias("timestamp"),
        F.col(p + "value").alias("value"),
        F.col(p + "user_id").alias("userId"),
        F.col(p + "lim").alias("limit"),
        F.struct(F.col(p + "lat").alias("latitude"), F.col(p + "lon").alias("longitude")).alias("localization"),
        above_limit(F.col(p + "value"), F.col(p + "lim")).alias("aboveLimit"),
    )


def nested_alerts(alerts: DataFrame) -> DataFrame:
    """Flat alerts -> ``(transaction STRUCT, fraudReason STRING)``."""
    return alerts.select(transaction_struct().alias("transaction"),
                         F.col("fraud_reason").alias("fraudReason"))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Recursively flatten struct columns to ``parent.child`` names: one
    projection, computed from the schema, no UDF."""
    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            yield ref.alias(sep.join(path))
    cols = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


def flat_alert_layout(alerts: DataFrame) -> DataFrame:
    """The nine-column alert layout of the CSV export (dotted names, with
    ``isAboveLimit`` as the serializer names the derived getter)."""
    nested = nested_alerts(alerts)
    flat = flatten(nested)
    return flat.withColumnRenamed("transaction.aboveLimit", "isAboveLimit").select(
        "`transaction.cardId`", "`transaction.timestamp`", "`transaction.value`",
        "`transaction.userId`", "`transaction.limit`",
        "`transaction.localization.latitude`", "`transaction.localization.longitude`",
        "isAboveLimit", "fraudReason")
