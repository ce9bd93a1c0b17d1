"""Kafka source and sink (S1, S3) as thin option builders.

The ``kafka`` data source ships as a separate Spark package
(``spark-sql-kafka-0-10``); it is not on this machine's classpath and no
broker may be started here, so these builders are untested against a broker.
Decoding and encoding are shared with the file paths and are tested there.

Source semantics: one topic, from the earliest offset; event time is the
record timestamp; arrival order ``seq`` packs (partition, offset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ALERT_TOPIC, SOURCE_TOPIC
from .json_codec import alert_json, decode_transactions

OFFSET_BITS = 40   # seq = partition << 40 | offset: unique and ordered per partition


def source_options(bootstrap_servers: str, topic: str = SOURCE_TOPIC,
                   starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def sink_options(bootstrap_servers: str, topic: str = ALERT_TOPIC) -> dict:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def kafka_records_to_transactions(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kafka rows (key, value, partition, offset, timestamp, ...) -> (good, quarantine)."""
    fits = F.col("offset") < F.lit(1 << OFFSET_BITS)
    framed = records.select(
        F.when(fits, F.col("partition").cast("long") * F.lit(1 << OFFSET_BITS) + F.col("offset"))
        .otherwise(F.raise_error(F.lit("offset does not fit the packed arrival order"))).alias("seq"),
        F.col("timestamp").alias("event_ts"),
        F.col("value").cast("string").alias("value"))
    return decode_transactions(framed)


def read_transactions_stream(spark: SparkSession, bootstrap_servers: str, topic: str = SOURCE_TOPIC,
                             **kw) -> tuple[DataFrame, DataFrame]:
    records = spark.readStream.format("kafka").options(**source_options(bootstrap_servers, topic, **kw)).load()
    return kafka_records_to_transactions(records)


def write_alerts(alerts: DataFrame, bootstrap_servers: str, topic: str = ALERT_TOPIC) -> None:
    """Batch write of alert JSON to a topic (no record key, as in the reference)."""
    alert_json(alerts).write.format("kafka").options(**sink_options(bootstrap_servers, topic)).save()
