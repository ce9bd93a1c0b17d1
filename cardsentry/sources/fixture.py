"""The ``tx`` fixture: the driver's ``events`` table mapped onto the
transaction schema (FIXTURES.md, F5).

This is only a column mapping (one projection, no shuffle): it gives rows in
the schema the detectors expect and does none of their work.  The detectors
run unchanged on any data of that schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import VALUE_TYPE


def transactions_from_events(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    second_card = F.when(k % 10 == 0, F.lit(7000)).otherwise(F.lit(0))
    lat_jitter = (F.when(k >= 85, F.lit(2.0) + (k - 85) * F.lit(0.1))
                  .otherwise((k - 42) * F.lit(0.003)))
    return events.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") + second_card).cast("int").alias("card_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("value").cast(VALUE_TYPE).alias("value"),
        F.col("user_id").cast("int").alias("user_id"),
        (F.lit(20) + F.col("user_id") % 21).cast("int").alias("lim"),
        (F.lit(-60.0) + ((F.col("user_id") * 37) % 120).cast("double") + lat_jitter).alias("lat"),
        (F.lit(-170.0) + ((F.col("user_id") * 73) % 340).cast("double")
         + (k % 7 - 3) * F.lit(0.01)).alias("lon"),
    )


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of one scale-factor folder."""
    return transactions_from_events(load_table(spark, sf_dir, "events"))
