"""Sinks for the streaming jobs (S3, S5, S6).

* ``kafka_alert_sink``: alert JSON to a topic from ``foreachBatch``
  (at-least-once, as Spark's Kafka sink is; the reference set no guarantee).
* ``start_csv_export``: a stream of transactions or alerts appended to CSV in
  the dump scripts' layouts, one header per file; ``max_rows`` caps a file's rows
  (off by default).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.alerts import flat_alert_layout
from ..schema import ALERT_TOPIC
from ..session import ensure_checkpoint_dir
from ..sources.csv_io import transactions_csv_layout
from ..sources.kafka import write_alerts
from .detect import parquet_sink

__all__ = ["parquet_sink", "kafka_alert_sink", "start_csv_export"]


def kafka_alert_sink(bootstrap_servers: str, topic: str = ALERT_TOPIC) -> Callable[[DataFrame, int], None]:
    def write(alerts: DataFrame, batch_id: int) -> None:
        write_alerts(alerts, bootstrap_servers, topic)
    return write


def start_csv_export(stream: DataFrame, path: str, layout: str = "transactions",
                     checkpoint_location: str | None = None, trigger: dict | None = None,
                     query_name: str | None = None, max_rows: int = 0):
    """Append a stream to CSV files; ``layout`` is ``transactions`` or ``alerts``."""
    flat = transactions_csv_layout(stream) if layout == "transactions" else flat_alert_layout(stream)
    name = query_name or f"csv_export_{layout}"
    ckpt = checkpoint_location or f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/{name}"
    writer = (flat.writeStream.format("csv").outputMode("append").queryName(name)
              .option("header", True).option("maxRecordsPerFile", max_rows)
              .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
              .option("checkpointLocation", ckpt).option("path", path))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
