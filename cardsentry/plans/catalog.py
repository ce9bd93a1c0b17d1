"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole ``events`` table mapped to
transactions.

Output conventions (so results compare exactly with the DuckDB oracle):
``value`` leaves as DOUBLE (the 2-dp decimal converted once), timestamps as
TIMESTAMP_NTZ, computed doubles rounded to 6 decimals, every computed column
aliased.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import destination_point, haversine_km, initial_bearing_deg
from ..functions.timefmt import format_2dp, local_datetime_text, parse_timestamp_pattern, utc_wall_clock
from ..operators.above_limit import above_limit_ranked, detect_above_limit
from ..operators.alerts import above_limit, flat_alert_layout, flatten
from ..operators.location import (clustered_groups, detect_location_jump, suspects_with_nearest,
                                  velocity_checks)
from ..operators.clustering import cluster_summary
from ..operators.low_values import detect_low_values, p05_by_group
from ..operators.skew import join_stats
from ..operators.trailing import detect_trailing_repeat
from ..operators.windows import WINDOW_COLS
from ..schema import ALERT_COLUMNS, TX_CSV_HEADER, TX_SCHEMA, VALUE_TYPE
from ..sources.fixture import load_tx
from ..sources.csv_io import TIMESTAMP_FORMAT, transactions_csv_layout, typed_transactions
from ..sources.json_codec import alert_json, decode_alerts, decode_transactions, encode_transactions
from .detection import fraud_alerts
from .feeds import (alerts_by_reason, feed_above_limit, feed_location_alerts, feed_low_values,
                    feed_positions)

Query = Callable[[SparkSession, str], DataFrame]


def _out(df: DataFrame, cols: list[str]) -> DataFrame:
    """Select ``cols``; DECIMAL value becomes DOUBLE."""
    return df.select(*[F.col(c).cast("double").alias(c) if c == "value" else F.col(c) for c in cols])


def _r6(c) -> F.Column:
    """Round to 6 decimals; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


ALERT_OUT = ALERT_COLUMNS
WINDOWED_ALERT_OUT = ALERT_COLUMNS + WINDOW_COLS


# -- detectors ---------------------------------------------------------------
def q_detect_low_values(spark, sf):
    return _out(detect_low_values(load_tx(spark, sf)), WINDOWED_ALERT_OUT)


def q_detect_above_limit(spark, sf):
    return _out(detect_above_limit(load_tx(spark, sf)), WINDOWED_ALERT_OUT)


def q_above_limit_sliding_12h(spark, sf):
    return _out(detect_above_limit(load_tx(spark, sf), "24 hours", "12 hours"), WINDOWED_ALERT_OUT)


def q_detect_location_jump(spark, sf):
    return _out(detect_location_jump(load_tx(spark, sf)), WINDOWED_ALERT_OUT)


def q_low_values_sliding_84h(spark, sf):
    return _out(detect_low_values(load_tx(spark, sf), "7 days", "84 hours"), WINDOWED_ALERT_OUT)


def q_location_sliding_12h(spark, sf):
    return _out(detect_location_jump(load_tx(spark, sf), "1 day", "12 hours"), WINDOWED_ALERT_OUT)


def _stream_folder(spark, name: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cardsentry/{name}/{uuid.uuid4().hex}"


def q_stream_fraud_alerts(spark, sf, slices: int | None = None):
    """The streaming job end to end: the ``events`` table replayed in event-time
    order, watermark + windowed state + foreachBatch detection, run to the end
    of input (``availableNow``) into the shared checkpoint folder; the emitted
    alerts are those of every window that closed."""
    from ..sources.fixture import load_table, transactions_from_events
    from ..streaming.detect import parquet_sink, start_detection
    from ..streaming.replay import replay
    from pyspark.sql import types as T
    base = _stream_folder(spark, "stream_fraud_alerts")
    replay(load_table(spark, sf, "events"), "ts", f"{base}/in",
           lambda stream: start_detection(
               transactions_from_events(stream), parquet_sink(f"{base}/alerts"),
               checkpoint_location=f"{base}/state", trigger={"availableNow": True},
               query_name=f"stream_fraud_alerts_{base[-8:]}"),
           slices)
    out_schema = T.StructType(TX_SCHEMA.fields + [
        T.StructField("above_limit", T.BooleanType()), T.StructField("fraud_reason", T.StringType()),
        T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType())])
    alerts = spark.read.schema(out_schema).parquet(f"{base}/alerts")
    alerts = (alerts.withColumn("window_start", utc_wall_clock("window_start"))
              .withColumn("window_end", utc_wall_clock("window_end")))
    return _out(alerts, WINDOWED_ALERT_OUT)


def q_stream_trailing_24h_repeat(spark, sf, slices: int | None = None):
    """The keyed-state trailing rule (``applyInPandasWithState`` with an
    event-time time-out) over the ``events`` table replayed in event-time order."""
    from ..sources.fixture import load_table, transactions_from_events
    from ..streaming.replay import replay
    from ..streaming.trailing import alert_schema, trailing_repeat_stream
    base = _stream_folder(spark, "stream_trailing")
    replay(load_table(spark, sf, "events"), "ts", f"{base}/in",
           lambda stream: (trailing_repeat_stream(transactions_from_events(stream)).writeStream.format("parquet")
                           .outputMode("append").option("path", f"{base}/alerts")
                           .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()),
           slices)
    schema = alert_schema(TX_SCHEMA)
    return _out(spark.read.schema(schema).parquet(f"{base}/alerts"), schema.fieldNames())


def q_fraud_alerts(spark, sf):
    return _out(fraud_alerts(load_tx(spark, sf)), ALERT_OUT)


def q_trailing_24h_repeat(spark, sf):
    return _out(detect_trailing_repeat(load_tx(spark, sf)), ALERT_OUT)


# -- building blocks ---------------------------------------------------------
def q_above_limit_after_k(spark, sf):
    rows = above_limit_ranked(load_tx(spark, sf))
    return rows.select("user_id", *WINDOW_COLS, "seq", "ts", F.col("n").cast("long").alias("n"))


def q_p05_by_card_week(spark, sf):
    p = p05_by_group(load_tx(spark, sf))
    return p.select("card_id", *WINDOW_COLS, F.col("n").cast("long").alias("n"), "p05_index",
                    F.col("p05_value").cast("double").alias("p05_value"), "flagged")


def q_geo_clusters(spark, sf):
    g = ["user_id", *WINDOW_COLS]
    s = cluster_summary(clustered_groups(load_tx(spark, sf)), g)
    return s.select("user_id", "window_start", "cid", F.col("n").cast("int").alias("n"),
                    _r6("centre_lat").alias("centre_lat"), _r6("centre_lon").alias("centre_lon"))


def q_main_cluster(spark, sf):
    c = clustered_groups(load_tx(spark, sf))
    return (c.select("user_id", "window_start", "main_cid", "main_n", "n_clusters")
            .dropDuplicates(["user_id", "window_start"]))


def q_nearest_in_time(spark, sf):
    s = suspects_with_nearest(load_tx(spark, sf))
    return s.select("user_id", "window_start", "seq", "ts",
                    F.col("near.seq").alias("near_seq"), F.col("near.ts").alias("near_ts"),
                    F.col("near_key").cast("long").alias("near_key"))


def q_velocity_checks(spark, sf):
    v = velocity_checks(load_tx(spark, sf))
    return v.select("seq", F.col("near.seq").alias("near_seq"), _r6("distance_km").alias("distance_km"),
                    "hours", _r6("velocity").alias("velocity"), "is_fraud")


def q_reason_text(spark, sf):
    v = velocity_checks(load_tx(spark, sf))
    return v.select("seq", format_2dp(F.col("hours")).alias("hours_text"),
                    format_2dp(F.col("velocity")).alias("velocity_text"),
                    format_2dp(F.col("distance_km")).alias("distance_text"),
                    local_datetime_text(F.col("near.ts")).alias("main_ts_text"),
                    local_datetime_text(F.col("ts")).alias("suspect_ts_text"))


# -- scalar functions over whole tables ---------------------------------------
def _with_home(tx: DataFrame) -> DataFrame:
    """Each row with its card's first position (min_by: a partial aggregate)."""
    home = tx.groupBy("card_id").agg(
        F.min_by(F.struct("lat", "lon"), F.struct("ts", "seq")).alias("home"))
    return join_stats(tx, home, ["card_id"])


def q_haversine_km(spark, sf):
    t = _with_home(load_tx(spark, sf))
    d = haversine_km(F.col("home.lat"), F.col("home.lon"), F.col("lat"), F.col("lon"))
    return t.select("seq", "card_id", _r6(d).alias("km_from_first"))


def q_destination_point(spark, sf):
    t = _with_home(load_tx(spark, sf))
    d = haversine_km(F.col("home.lat"), F.col("home.lon"), F.col("lat"), F.col("lon"))
    b = initial_bearing_deg(F.col("home.lat"), F.col("home.lon"), F.col("lat"), F.col("lon"))
    p = destination_point(F.col("home.lat"), F.col("home.lon"), b, d)
    return t.select("seq", _r6(p["latitude"]).alias("dest_lat"), _r6(p["longitude"]).alias("dest_lon"))


# -- filters / projections -----------------------------------------------------
def q_filter_above_limit(spark, sf):
    return _out(load_tx(spark, sf).where(above_limit()), ["seq", "card_id", "ts", "value", "lim"])


def q_filter_low_value(spark, sf):
    tx = load_tx(spark, sf)
    return _out(tx.where(F.col("value") < F.lit("1.0").cast(VALUE_TYPE)),
                ["seq", "card_id", "ts", "value"])


def q_above_limit_flag(spark, sf):
    tx = load_tx(spark, sf).withColumn("above_limit", above_limit())
    return _out(tx, ["seq", "value", "lim", "above_limit"])


def q_json_roundtrip(spark, sf):
    good, _ = decode_transactions(encode_transactions(load_tx(spark, sf)))
    return _out(good, ["seq", "card_id", "ts", "value", "user_id", "lim", "lat", "lon"])


def q_tx_flat(spark, sf):
    good, _ = decode_transactions(encode_transactions(load_tx(spark, sf)))
    nested = good.select("seq", F.struct(
        "card_id", "ts", "value", "user_id", "lim",
        F.struct(F.col("lat").alias("latitude"), F.col("lon").alias("longitude")).alias("localization"),
    ).alias("tx"))
    flat = flatten(nested, sep="_")
    return flat.select("seq", *[F.col(c).cast("double").alias(c) if c == "tx_value" else F.col(c)
                                for c in flat.columns if c != "seq"])


def q_alert_json(spark, sf):
    return alert_json(fraud_alerts(load_tx(spark, sf)), keep=["seq"])


def q_alerts_flat(spark, sf):
    flat = flat_alert_layout(fraud_alerts(load_tx(spark, sf)))
    return flat.select(*[F.col(f"`{c}`").cast("double").alias(c.replace(".", "_"))
                         if c == "transaction.value" else F.col(f"`{c}`").alias(c.replace(".", "_"))
                         for c in flat.columns])


def q_alert_decode(spark, sf):
    """Alert messages read back into alert rows."""
    good, _ = decode_alerts(alert_json(fraud_alerts(load_tx(spark, sf)), keep=["seq"]))
    return _out(good, ALERT_OUT)


def q_csv_roundtrip(spark, sf):
    """Every transaction as a CSV line of the dump layout, parsed and typed again."""
    tx = load_tx(spark, sf)
    layout = transactions_csv_layout(tx, keep=["seq"])
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in TX_CSV_HEADER]), {"timestampNTZFormat": TIMESTAMP_FORMAT})
    schema = ", ".join(f"`{c}` string" for c in TX_CSV_HEADER)
    back = layout.select("seq", F.from_csv(line, schema).alias("r"))
    good, _ = typed_transactions(back.select("seq", *[F.col(f"r.`{c}`").alias(c) for c in TX_CSV_HEADER]))
    return _out(good, ["seq", "card_id", "ts", "value", "user_id", "lim", "lat", "lon"])


def q_producer_time(spark, sf):
    """Event times written and parsed in the producer's ``yyyy-MM-dd HH:mm:ss`` form (whole seconds)."""
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return load_tx(spark, sf).select("seq", text.alias("ts_text"), parse_timestamp_pattern(text).alias("ts_parsed"))


MIXED_FORMS = ["yyyy-MM-dd HH:mm:ss.SSSSSS", "M/d/yyyy H:mm:ss", "yyyy/M/d H:mm", "MMM d, yyyy HH:mm:ss", "d MMMM yyyy",
               "yyyyMMdd'T'HHmmss", "MM/dd/yyyy hh:mm:ss a"]


def q_csv_mixed_times(spark, sf):
    """Every transaction as a CSV line whose timestamp has one of several date forms (by seq), parsed and typed again."""
    tx = load_tx(spark, sf)
    form = F.pmod("seq", F.lit(len(MIXED_FORMS)))
    text = F.coalesce(*[F.when(form == i, F.date_format("ts", f)) for i, f in enumerate(MIXED_FORMS)])
    layout = transactions_csv_layout(tx.withColumn("ts", text), keep=["seq"])
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in TX_CSV_HEADER]))
    schema = ", ".join(f"`{c}` string" for c in TX_CSV_HEADER)
    back = layout.select("seq", F.from_csv(line, schema).alias("r"))
    good, _ = typed_transactions(back.select("seq", *[F.col(f"r.`{c}`").alias(c) for c in TX_CSV_HEADER]))
    return _out(good, ["seq", "card_id", "ts", "value", "user_id", "lim", "lat", "lon"])


def q_fixed_centre_clusters(spark, sf):
    """Leader clustering whose centres stay at their first point."""
    g = ["user_id", *WINDOW_COLS]
    s = cluster_summary(clustered_groups(load_tx(spark, sf), update_centre=False), g)
    return s.select("user_id", "window_start", "cid", F.col("n").cast("int").alias("n"),
                    _r6("centre_lat").alias("centre_lat"), _r6("centre_lon").alias("centre_lon"))


def q_feed_busiest_card(spark, sf):
    """The low-value feed of one card, found by equality: the card with the most rows (least id on ties)."""
    tx = load_tx(spark, sf)
    first = tx.groupBy("card_id").count().orderBy(F.col("count").desc(), "card_id").first()
    return _out(feed_low_values(tx, cards=[first["card_id"]] if first else []), ["card_id", "seq", "ts", "value", "is_low"])


def q_alerts_by_reason(spark, sf):
    return _out(alerts_by_reason(fraud_alerts(load_tx(spark, sf))), ALERT_OUT)


# -- backtest feeds ------------------------------------------------------------
def q_feed_above_limit(spark, sf):
    return _out(feed_above_limit(load_tx(spark, sf)),
                ["card_id", "seq", "ts", "value", "limit0", "above_limit0"])


def q_feed_low_values(spark, sf):
    return _out(feed_low_values(load_tx(spark, sf)), ["card_id", "seq", "ts", "value", "is_low"])


def q_feed_positions(spark, sf):
    return feed_positions(load_tx(spark, sf))


def q_feed_location_alerts(spark, sf):
    return feed_location_alerts(fraud_alerts(load_tx(spark, sf)))


QUERIES: dict[str, Query] = {
    "detect_low_values": q_detect_low_values,
    "detect_above_limit": q_detect_above_limit,
    "above_limit_sliding_12h": q_above_limit_sliding_12h,
    "detect_location_jump": q_detect_location_jump,
    "low_values_sliding_84h": q_low_values_sliding_84h,
    "location_sliding_12h": q_location_sliding_12h,
    "fraud_alerts": q_fraud_alerts,
    "stream_fraud_alerts": q_stream_fraud_alerts,
    "stream_trailing_24h_repeat": q_stream_trailing_24h_repeat,
    "trailing_24h_repeat": q_trailing_24h_repeat,
    "above_limit_after_k": q_above_limit_after_k,
    "p05_by_card_week": q_p05_by_card_week,
    "geo_clusters": q_geo_clusters,
    "main_cluster": q_main_cluster,
    "nearest_in_time": q_nearest_in_time,
    "velocity_checks": q_velocity_checks,
    "reason_text": q_reason_text,
    "haversine_km": q_haversine_km,
    "destination_point": q_destination_point,
    "filter_above_limit": q_filter_above_limit,
    "filter_low_value": q_filter_low_value,
    "above_limit_flag": q_above_limit_flag,
    "json_roundtrip": q_json_roundtrip,
    "tx_flat": q_tx_flat,
    "alert_json": q_alert_json,
    "alerts_flat": q_alerts_flat,
    "alerts_by_reason": q_alerts_by_reason,
    "alert_decode": q_alert_decode,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_mixed_times": q_csv_mixed_times,
    "producer_time": q_producer_time,
    "fixed_centre_clusters": q_fixed_centre_clusters,
    "feed_busiest_card": q_feed_busiest_card,
    "feed_above_limit": q_feed_above_limit,
    "feed_low_values": q_feed_low_values,
    "feed_positions": q_feed_positions,
    "feed_location_alerts": q_feed_location_alerts,
}
