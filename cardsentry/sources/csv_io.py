"""CSV layouts of the reference's dump scripts (S5–S8).

* transactions: ``cardId,timestamp,value,userId,limit,localization.latitude,localization.longitude``
* alerts: the nine ``transaction.*`` / ``isAboveLimit`` / ``fraudReason`` columns

Reading uses an explicit schema (no inference) and parses each transaction's timestamp by
its own shape (ISO text with or without a fraction, and other date forms); dotted header names are kept as column names.
Rows that do not parse are returned apart, with the reason.
Writing flattens first (CSV cannot hold structs) and writes one header per file;
``max_rows`` caps the rows of a file (off by default; the dump scripts flush
every ``CSV_FLUSH_ROWS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import parse_timestamp_mixed, parse_timestamp_ntz
from ..operators.alerts import flat_alert_layout, flatten
from ..schema import ALERT_CSV_HEADER, TX_CSV_HEADER, WIDE_VALUE_TYPE

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
_TX_CSV_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in TX_CSV_HEADER])
_ALERT_CSV_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ALERT_CSV_HEADER])


def _q(name: str) -> F.Column:
    return F.col(f"`{name}`")


def typed_transactions(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of text columns in the transaction layout, plus ``seq`` -> (good, quarantine)."""
    typed = raw.select(
        "seq",
        _q("cardId").try_cast("int").alias("card_id"),
        parse_timestamp_mixed(_q("timestamp")).alias("ts"),
        _q("value").try_cast(WIDE_VALUE_TYPE).alias("value"),
        _q("userId").try_cast("int").alias("user_id"),
        _q("limit").try_cast("int").alias("lim"),
        _q("localization.latitude").try_cast("double").alias("lat"),
        _q("localization.longitude").try_cast("double").alias("lon"),
        F.to_json(F.struct(*[_q(c) for c in TX_CSV_HEADER])).alias("_corrupt_record"),
    )
    names = dict(zip(("card_id", "ts", "value", "user_id", "lim", "lat", "lon"), TX_CSV_HEADER))
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(n)) for c, n in names.items()])
    typed = typed.withColumn("reason", reason)
    return (typed.where(F.col("reason").isNull()).drop("_corrupt_record", "reason"),
            typed.where(F.col("reason").isNotNull()).select("_corrupt_record", "reason"))


def read_transactions_csv(spark: SparkSession, path: str, stream: bool = False) -> tuple[DataFrame, DataFrame]:
    """Transactions CSV -> (good, quarantine), from a folder or as a file stream.  The layout has no id, so ``seq``
    is a hash of the row: the same wherever and whenever the row is read.
    Rows that repeat in all columns share it, which the detectors allow for."""
    reader = spark.readStream if stream else spark.read
    raw = reader.schema(_TX_CSV_SCHEMA).option("header", True).csv(path)
    return typed_transactions(raw.withColumn("seq", F.xxhash64(*[_q(c) for c in TX_CSV_HEADER])))


def read_alerts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Alerts CSV -> flat alert rows (``seq`` unknown: NULL)."""
    raw = spark.read.schema(_ALERT_CSV_SCHEMA).option("header", True).csv(path)
    return raw.select(
        F.lit(None).cast("long").alias("seq"),
        _q("transaction.cardId").try_cast("int").alias("card_id"),
        parse_timestamp_ntz(_q("transaction.timestamp")).alias("ts"),
        _q("transaction.value").try_cast(WIDE_VALUE_TYPE).alias("value"),
        _q("transaction.userId").try_cast("int").alias("user_id"),
        _q("transaction.limit").try_cast("int").alias("lim"),
        _q("transaction.localization.latitude").try_cast("double").alias("lat"),
        _q("transaction.localization.longitude").try_cast("double").alias("lon"),
        _q("isAboveLimit").try_cast("boolean").alias("above_limit"),
        _q("fraudReason").alias("fraud_reason"),
    )


def transactions_csv_layout(tx: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Internal rows -> the seven-column transaction layout (after the columns to ``keep``)."""
    nested = tx.select(
        *(keep or []),
        F.col("card_id").alias("cardId"), F.col("ts").alias("timestamp"), "value",
        F.col("user_id").alias("userId"), F.col("lim").alias("limit"),
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("localization"))
    return flatten(nested)


def write_csv(df: DataFrame, path: str, mode: str = "append", max_rows: int = 0) -> None:
    (df.write.mode(mode).option("header", True)
     .option("timestampNTZFormat", TIMESTAMP_FORMAT)
     .option("maxRecordsPerFile", max_rows).csv(path))


def write_transactions_csv(tx: DataFrame, path: str, mode: str = "append", max_rows: int = 0) -> None:
    write_csv(transactions_csv_layout(tx), path, mode, max_rows)


def write_alerts_csv(alerts: DataFrame, path: str, mode: str = "append", max_rows: int = 0) -> None:
    write_csv(flat_alert_layout(alerts), path, mode, max_rows)
