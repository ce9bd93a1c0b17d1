"""JSON decode of transaction messages (S2) and encode of alerts (S4).

Decode: ``from_json`` with every scalar read as STRING (a JSON ``"5"`` and
``5`` both become ``'5'``), then ``try_cast`` to the typed schema.  Amounts keep
their scale (DECIMAL(38,18): 0.999 stays below 1.0).  A row that does not parse
or misses a field goes to the quarantine output with the raw text; unknown
fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.alerts import transaction_struct
from ..schema import ALERT, WIDE_VALUE_TYPE, WIRE_SCHEMA

from ..functions.timefmt import iso_local_datetime_text


# alerts as text fields, like transactions
ALERT_WIRE_SCHEMA = T.StructType([
    T.StructField("transaction", T.StructType(
        [T.StructField(f.name, f.dataType if f.name == "localization" else T.StringType())
         for f in ALERT["transaction"].dataType.fields])),
    T.StructField("fraudReason", T.StringType())])


def decode_transactions(raw: DataFrame, value_col: str = "value", seq_col: str | None = "seq",
                        fail_fast: bool = False, round_to: int | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text into transaction rows.

    Returns ``(good, quarantine)``; ``good`` has the internal columns
    (seq, card_id, ts, value, user_id, lim, lat, lon) plus any other column of
    ``raw`` (e.g. ``event_ts``), ``quarantine`` has the raw text and a reason.
    ``round_to`` rounds amounts HALF_UP to that many decimals, as the producer
    rounds its own; by default they stay as they are.
    """
    text = F.col(value_col).cast("string")
    schema = T.StructType(WIRE_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    parsed = raw.withColumn("_j", F.from_json(text, schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    j = lambda f: F.col("_j." + f)
    amount = j("value").try_cast(WIDE_VALUE_TYPE)
    if round_to is not None:
        amount = F.round(amount, round_to).cast(WIDE_VALUE_TYPE)
    typed = parsed.select(
        "*",
        j("cardId").try_cast("int").alias("card_id"),
        j("timestamp").try_cast("timestamp_ntz").alias("ts"),
        amount.alias("value_typed"),
        j("userId").try_cast("int").alias("user_id"),
        j("limit").try_cast("int").alias("lim"),
        j("localization.latitude").alias("lat"),
        j("localization.longitude").alias("lon"),
    )
    problem = (F.when(F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull(), F.lit("unparsable"))
               .when(F.col("card_id").isNull(), F.lit("cardId"))
               .when(F.col("ts").isNull(), F.lit("timestamp"))
               .when(F.col("value_typed").isNull(), F.lit("value"))
               .when(F.col("user_id").isNull(), F.lit("userId"))
               .when(F.col("lim").isNull(), F.lit("limit"))
               .when(F.col("lat").isNull() | F.col("lon").isNull(), F.lit("localization")))
    typed = typed.withColumn("_problem", problem)
    if fail_fast:
        typed = typed.withColumn("_problem", F.when(F.col("_problem").isNotNull(),
                                                    F.raise_error(F.concat(F.lit("bad transaction: "),
                                                                           F.col("_problem")))))
    keep = [c for c in raw.columns if c not in (value_col,)]
    good = (typed.where(F.col("_problem").isNull())
            .select(*([F.col(seq_col).alias("seq")] if seq_col else []),
                    "card_id", "ts", F.col("value_typed").alias("value"), "user_id", "lim", "lat", "lon",
                    *[F.col(c) for c in keep if c not in (seq_col, "card_id", "ts", "user_id", "lim",
                                                            "lat", "lon", "value")]))
    quarantine = typed.where(F.col("_problem").isNotNull()).select(
        text.alias("_corrupt_record"), F.col("_problem").alias("reason"))
    return good, quarantine


def encode_transactions(tx: DataFrame) -> DataFrame:
    """The producer's wire form: ids, value, limit and time as JSON strings,
    coordinates as numbers.  Column ``value`` holds the JSON text."""
    body = F.struct(
        F.col("card_id").cast("string").alias("cardId"),
        iso_local_datetime_text("ts").alias("timestamp"),
        # at least two decimals, no zeros after the amount's own
        F.regexp_replace(F.col("value").cast("string"), r"(\.\d\d\d*?)0+$", "$1").alias("value"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("lim").cast("string").alias("limit"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("localization"))
    return tx.select("seq", F.to_json(body).alias("value"))


def alert_json(alerts: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat alerts -> one JSON text per alert (column ``value``), shaped like
    the reference's alert messages (``aboveLimit`` included)."""
    # Timestamps are rendered as ISO_LOCAL_DATE_TIME text first (seconds
    # always, fraction only when non-zero): no to_json format option does that.
    body = F.struct(transaction_struct(ts_as_text=True).alias("transaction"),
                    F.col("fraud_reason").alias("fraudReason"))
    return alerts.select(*[F.col(c) for c in (keep or [])], F.to_json(body).alias("value"))


def decode_alerts(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Alert messages -> ``(good, quarantine)``: flat alert rows, and the texts that do not parse.

    Other columns of ``raw`` (such as ``seq``) are kept."""
    text = F.col(value_col).cast("string")
    parsed = raw.withColumn("_j", F.from_json(text, ALERT_WIRE_SCHEMA))
    t = lambda f: F.col("_j.transaction." + f)
    typed = parsed.select(
        *[F.col(c) for c in raw.columns if c != value_col], text.alias("_corrupt_record"),
        t("cardId").try_cast("int").alias("card_id"),
        t("timestamp").try_cast("timestamp_ntz").alias("ts"),
        t("value").try_cast(WIDE_VALUE_TYPE).alias("value"),
        t("userId").try_cast("int").alias("user_id"),
        t("limit").try_cast("int").alias("lim"),
        t("localization.latitude").alias("lat"),
        t("localization.longitude").alias("lon"),
        t("aboveLimit").try_cast("boolean").alias("above_limit"),
        F.col("_j.fraudReason").alias("fraud_reason"))
    whole = F.lit(True)
    for c in ("card_id", "ts", "value", "user_id", "lim", "lat", "lon", "fraud_reason"):
        whole = whole & F.col(c).isNotNull()
    return typed.where(whole).drop("_corrupt_record"), typed.where(~whole).select("_corrupt_record")
