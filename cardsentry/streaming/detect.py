"""Structured Streaming driver for the three detectors.

Plan (one streaming query):

    source → withWatermark(event_ts, delay)
           → groupBy(window, user) : count, rows of the user's day      (D1 + D3 fused, O3)
           ∪ groupBy(window, card) : count, rows below 1.0 only          (D2, O2 state)
           → append mode: a (key, window) leaves state exactly once, when
             the watermark passes the window end (late rows are dropped)
           → foreachBatch: explode the closed windows that can alert and run
             the batch detector functions on them, then hand alerts to a sink.

Nothing filters rows between the watermark and the aggregates (Catalyst would
push such a filter below ``EventTimeWatermark`` and the watermark would then
advance only on the filtered rows); selection is done by conditional
aggregation (``collect_list(when(..))``) instead.

Because each closed window is complete, the alerts equal those of the batch
detectors on the same rows, minus windows still open at the end of input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_micros
from ..operators.above_limit import detect_above_limit
from ..operators.alerts import above_limit, to_alerts, union_alerts
from ..operators.clustering import one_cluster_box
from ..operators.location import detect_location_jump
from ..operators.low_values import p05_index
from ..operators.windows import duration_seconds
from ..plans.detection import group_location_alerts
from ..schema import (ABOVE_LIMIT_ALLOWED, ABOVE_LIMIT_SKIP, LOW_VALUE_THRESHOLD, REASON_LOW_VALUES, TX_COLUMNS, VALUE_TYPE,
                      WINDOW_ABOVE_LIMIT, WINDOW_LOCATION, WINDOW_LOW_VALUES)
from ..session import ensure_checkpoint_dir

WindowSpec = tuple[str, str | None]


def with_event_time(tx: DataFrame) -> DataFrame:
    """Add ``event_ts`` (TIMESTAMP) from the payload time read as UTC, for
    sources without a record timestamp (files).  Session-zone independent."""
    if "event_ts" in tx.columns:
        return tx
    return tx.withColumn("event_ts", F.timestamp_micros(epoch_micros("ts")))


def _rows() -> Column:
    return F.struct(*TX_COLUMNS)


def windowed_state(stream: DataFrame, delay: str = "0 seconds",
                   above_limit_window: WindowSpec = (WINDOW_ABOVE_LIMIT, None),
                   low_values_window: WindowSpec = (WINDOW_LOW_VALUES, None),
                   location_window: WindowSpec = (WINDOW_LOCATION, None)) -> DataFrame:
    """The stateful part: closed (key, window) groups tagged by detector.

    Output: ``tag, window_start, window_end, n, rows ARRAY<STRUCT<tx>>``.
    """
    s = with_event_time(stream).withWatermark("event_ts", delay)
    low = F.col("value") < F.lit(LOW_VALUE_THRESHOLD).cast(VALUE_TYPE)
    above = F.col("value") > F.col("lim")

    def agg(key: str, spec: WindowSpec, tag: str, rows: Column) -> DataFrame:
        w = F.window("event_ts", spec[0], spec[1] or spec[0])
        return (s.groupBy(w.alias("w"), F.col(key).alias("key"))
                .agg(F.count(F.lit(1)).alias("n"), F.collect_list(rows).alias("rows"))
                .select(F.lit(tag).alias("tag"), F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), "n", "rows"))

    parts = []
    if _same(above_limit_window, location_window):
        parts.append(agg("user_id", location_window, "user", _rows()))
    else:
        parts.append(agg("user_id", above_limit_window, "above", F.when(above, _rows())))
        parts.append(agg("user_id", location_window, "location", _rows()))
    parts.append(agg("card_id", low_values_window, "low", F.when(low, _rows())))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _same(a: WindowSpec, b: WindowSpec) -> bool:
    """Same (length, slide)?  Unparsable specs count as different (no fusion)."""
    la, sa = duration_seconds(a[0]), duration_seconds(a[1] or a[0])
    lb, sb = duration_seconds(b[0]), duration_seconds(b[1] or b[0])
    return None not in (la, sa, lb, sb) and (la, sa) == (lb, sb)


def alerts_from_closed_windows(groups: DataFrame,
                               above_limit_window: WindowSpec = (WINDOW_ABOVE_LIMIT, None),
                               location_window: WindowSpec = (WINDOW_LOCATION, None)) -> DataFrame:
    """Run the detectors on closed windows (the micro-batch of ``windowed_state``)."""
    def rows_of(some: DataFrame) -> DataFrame:
        return some.select("window_start", "window_end", F.explode("rows").alias("r")).select("window_start", "window_end", "r.*")

    if _same(above_limit_window, location_window):
        # A group is one row here, so those that cannot alert stay out before their rows are taken apart:
        # D1 needs more above-limit rows than it skips, D3 more than one cluster.
        user = groups.where(F.col("tag") == "user")
        n_above = F.size(F.filter("rows", lambda r: above_limit(r["value"], r["lim"])))
        lat, lon = F.col("rows.lat"), F.col("rows.lon")
        one = one_cluster_box(F.array_min(lat), F.array_max(lat), F.array_min(lon), F.array_max(lon))
        known = F.col("user_id").isNotNull()
        d13 = detect_above_limit(rows_of(user.where(n_above > max(ABOVE_LIMIT_ALLOWED, ABOVE_LIMIT_SKIP))).where(known), *above_limit_window) \
            .unionByName(group_location_alerts(rows_of(user.where(~one)).where(known), location_window))
    else:
        d13 = detect_above_limit(rows_of(groups.where(F.col("tag") == "above")), *above_limit_window) \
            .unionByName(detect_location_jump(rows_of(groups.where(F.col("tag") == "location")), *location_window))
    flagged = groups.where((F.col("tag") == "low") & (F.size("rows") > p05_index(F.col("n"))))
    d2 = to_alerts(rows_of(flagged), REASON_LOW_VALUES, extra=["window_start", "window_end"])
    return union_alerts(d13, d2, extra=["window_start", "window_end"])


def parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Idempotent per micro-batch: a retried batch overwrites its own folder."""
    def write(alerts: DataFrame, batch_id: int) -> None:
        alerts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def start_detection(stream: DataFrame, sink: Callable[[DataFrame, int], None],
                    checkpoint_location: str | None = None, delay: str = "0 seconds",
                    trigger: dict | None = None, query_name: str = "cardsentry_alerts",
                    above_limit_window: WindowSpec = (WINDOW_ABOVE_LIMIT, None),
                    low_values_window: WindowSpec = (WINDOW_LOW_VALUES, None),
                    location_window: WindowSpec = (WINDOW_LOCATION, None),
                    bad: DataFrame | None = None, bad_sink: Callable[[DataFrame, int], None] | None = None):
    """Start the streaming detection job; returns the ``StreamingQuery``.

    Messages that do not parse (``bad``: text and reason) travel in the same query
    and go to ``bad_sink`` before the batch's alerts: a micro-batch is committed
    when both are written, and a failing sink stops the job.

    The checkpoint defaults to ``<spark.checkpoint.dir>/<query_name>``, the
    shared folder the cluster names, so a restarted driver resumes.
    """
    spark = stream.sparkSession
    ckpt = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{query_name}"
    state = windowed_state(stream, delay, above_limit_window, low_values_window, location_window)
    if (bad is None) != (bad_sink is None):
        raise ValueError("bad messages and their sink go together")
    if bad is not None:
        state = state.unionByName(bad.select(F.lit("bad").alias("tag"), "_corrupt_record", "reason"), allowMissingColumns=True)

    def handle(groups: DataFrame, batch_id: int) -> None:
        # The closed windows feed several branches: persist them so the
        # stateful micro-batch is computed once (the foreachBatch pattern).
        groups.persist()
        try:
            if bad_sink is not None:
                bad_sink(groups.where("tag = 'bad'").select("_corrupt_record", "reason"), batch_id)
            alerts = alerts_from_closed_windows(groups, above_limit_window, location_window)
            # the count computes all of the micro-batch's state; where no window closed, no detector runs
            closed = groups.where("tag <> 'bad'").count()
            sink(alerts if closed else alerts.limit(0), batch_id)
        finally:
            groups.unpersist()

    writer = (state.writeStream.outputMode("append").queryName(query_name)
              .option("checkpointLocation", ckpt).foreachBatch(handle))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
