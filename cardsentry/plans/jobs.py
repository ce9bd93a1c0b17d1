"""Runnable jobs: the detection job over files (batch) or a stream.

    python -m cardsentry batch  --input tx.json --format json --output alerts/
    python -m cardsentry stream --input in/ --format json --output alerts/ [--kafka host:9092]
    python -m cardsentry stream --kafka host:9092 --quarantine bad/        (topic to topic)
    python -m cardsentry export --kafka host:9092 --output csv/            (topic to CSV)
    python -m cardsentry trailing --input in/ --format csv --output alerts/

Inputs: ``json`` (the producer's messages, one per line), ``csv`` (the dump
layout), ``parquet`` (internal columns).  Batch output is Parquet written
with overwrite, so a re-run after a lost executor or driver replaces rather
than duplicates.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TX_SCHEMA
from ..sources.csv_io import read_transactions_csv
from ..sources.json_codec import decode_transactions
from .detection import fraud_alerts


def read_transactions(spark: SparkSession, path: str, fmt: str) -> tuple[DataFrame, DataFrame | None]:
    """(transactions, quarantine) from a batch source."""
    if fmt == "json":
        # seq is a hash of the message: the same in every scan of the input
        return decode_transactions(spark.read.text(path).select(F.xxhash64("value").alias("seq"), "value"))
    if fmt == "csv":
        return read_transactions_csv(spark, path)
    if fmt == "parquet":
        return spark.read.parquet(path).select(*TX_SCHEMA.fieldNames()), None
    raise ValueError(f"unknown format {fmt}")


def run_batch(spark: SparkSession, input_path: str, fmt: str, output_path: str) -> None:
    tx, quarantine = read_transactions(spark, input_path, fmt)
    fraud_alerts(tx).write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/alerts")
    if quarantine is not None:
        quarantine.write.mode("overwrite").parquet(f"{output_path.rstrip('/')}/quarantine")


def stream_transactions(spark: SparkSession, input_path: str, fmt: str, kafka: str | None = None,
                        starting_offsets: str = "earliest") -> tuple[DataFrame, DataFrame | None]:
    """(transactions, messages that do not parse) as streams; files that appear below ``input_path``, or the topic."""
    from ..sources.kafka import read_transactions_stream
    if kafka:
        return read_transactions_stream(spark, kafka, starting_offsets=starting_offsets)
    if fmt == "json":
        # A file stream has no offsets: seq (the tie-break among equal
        # timestamps) is a hash of the message, stable across micro-batches.
        raw = spark.readStream.format("text").load(input_path)
        return decode_transactions(raw.select(F.xxhash64("value").alias("seq"), "value"))
    if fmt == "csv":
        return read_transactions_csv(spark, input_path, stream=True)
    if fmt == "parquet":
        return spark.readStream.schema(spark.read.parquet(input_path).schema).parquet(input_path), None
    raise ValueError(f"unknown format {fmt}")


def _quarantine(bad: DataFrame | None, output_path: str, quarantine: str | None) -> str | None:
    if bad is None:
        return None
    if not quarantine and not output_path:
        raise ValueError("name a quarantine folder: without one, messages that do not parse would vanish")
    return quarantine or f"{output_path.rstrip('/')}-quarantine"


def run_stream(spark: SparkSession, input_path: str, fmt: str, output_path: str,
               kafka: str | None = None, checkpoint: str | None = None, delay: str = "0 seconds",
               trigger: dict | None = None, starting_offsets: str = "earliest", quarantine: str | None = None):
    """Start the detection stream: alerts to ``output_path``, or to the alert topic if that is empty.

    Bad messages go to ``quarantine`` (default ``<output>-quarantine``; required
    from topic to topic) by the same query, so none vanishes unreported."""
    from ..streaming.detect import parquet_sink, start_detection
    from ..streaming.sinks import kafka_alert_sink
    tx, bad = stream_transactions(spark, input_path, fmt, kafka, starting_offsets)
    sink = kafka_alert_sink(kafka) if kafka and not output_path else parquet_sink(output_path)
    aside = _quarantine(bad, output_path, quarantine)
    return start_detection(tx, sink, checkpoint_location=checkpoint, delay=delay, trigger=trigger,
                           bad=bad, bad_sink=parquet_sink(aside) if aside else None)


def run_export(spark: SparkSession, input_path: str, fmt: str, output_path: str, kafka: str | None = None,
               checkpoint: str | None = None, trigger: dict | None = None, starting_offsets: str = "latest"):
    """Start the dump of transactions (a topic's, or new files') to CSV files in the seven-column layout."""
    from ..streaming.sinks import start_csv_export
    tx, _ = stream_transactions(spark, input_path, fmt, kafka, starting_offsets)
    return start_csv_export(tx, output_path, "transactions", checkpoint, trigger)


def run_trailing(spark: SparkSession, input_path: str, fmt: str, output_path: str, kafka: str | None = None,
                 checkpoint: str | None = None, delay: str = "0 seconds", trigger: dict | None = None,
                 starting_offsets: str = "earliest"):
    """Start the trailing-24 h rule on a stream; its alerts are appended as Parquet."""
    from ..session import ensure_checkpoint_dir
    from ..streaming.trailing import trailing_repeat_stream
    tx, _ = stream_transactions(spark, input_path, fmt, kafka, starting_offsets)
    state = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/cardsentry_trailing"
    writer = (trailing_repeat_stream(tx, delay).writeStream.format("parquet").outputMode("append")
              .option("path", output_path).option("checkpointLocation", state))
    return (writer.trigger(**trigger) if trigger else writer).start()


def main(argv=None) -> None:
    from ..session import CLUSTER_CONF, get_session
    from ..tables import drop_stashed
    p = argparse.ArgumentParser(prog="cardsentry")
    p.add_argument("mode", choices=["batch", "stream", "export", "trailing"])
    p.add_argument("--input", required=False, default="")
    p.add_argument("--format", default="json", choices=["json", "csv", "parquet"])
    p.add_argument("--output", default="")
    p.add_argument("--kafka", default=None)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--delay", default="0 seconds")
    p.add_argument("--quarantine", default=None)
    p.add_argument("--starting-offsets", default=None, choices=["earliest", "latest"])
    a = p.parse_args(argv)
    # settings given to spark-submit win over these
    spark = get_session(extra=CLUSTER_CONF)
    if a.mode == "batch":
        run_batch(spark, a.input, a.format, a.output)
        drop_stashed(spark)
        return
    # a dump starts at the end of the topic, detection at its begin
    offsets = a.starting_offsets or ("latest" if a.mode == "export" else "earliest")
    if a.mode == "stream":
        query = run_stream(spark, a.input, a.format, a.output, a.kafka, a.checkpoint, a.delay, None, offsets, a.quarantine)
    elif a.mode == "export":
        query = run_export(spark, a.input, a.format, a.output, a.kafka, a.checkpoint, None, offsets)
    else:
        query = run_trailing(spark, a.input, a.format, a.output, a.kafka, a.checkpoint, a.delay, None, offsets)
    query.awaitTermination()
