"""Batch = stream: the streaming driver emits, window by window, exactly the
alerts of the batch detectors (minus windows still open at end of input)."""

from pyspark.sql import functions as F

from cardsentry.sources.fixture import load_tx
from cardsentry.sources.json_codec import decode_transactions, encode_transactions
from cardsentry.streaming.detect import parquet_sink, start_detection, windowed_state

import pytest

from conftest import SF001, SF01


def _write_daily_json(spark, tx, folder):
    """The fixture as JSON messages, one folder per week in time order (what a
    topic dump would look like)."""
    week = F.date_trunc("week", "ts").cast("date").alias("d")
    days = [r[0] for r in tx.select(week).distinct().orderBy("d").collect()]
    enc = encode_transactions(tx).join(tx.select("seq", week), "seq")
    for i, d in enumerate(days):
        (enc.where(F.col("d") == F.lit(d)).select(F.concat_ws("\t", F.col("seq").cast("string"), "value"))
         .coalesce(1).write.text(f"{folder}/part{i:03d}"))
    return len(days)


def test_stream_equals_batch(spark, scratch):
    tx = load_tx(spark, SF01)
    src = f"{scratch}/in"
    _write_daily_json(spark, tx, src)
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").load(src))
    framed = raw.select(F.split("value", "\t").getItem(0).cast("long").alias("seq"),
                        F.split("value", "\t").getItem(1).alias("value"))
    good, _ = decode_transactions(framed)
    out = f"{scratch}/alerts"
    q = start_detection(good, parquet_sink(out), checkpoint_location=f"{scratch}/ckpt",
                        trigger={"availableNow": True})
    q.awaitTermination(600)
    assert q.exception() is None
    streamed = spark.read.parquet(out).select("seq", "fraud_reason")

    max_ts = tx.agg(F.max("ts")).first()[0]
    from cardsentry.operators.above_limit import detect_above_limit
    from cardsentry.operators.location import detect_location_jump
    from cardsentry.operators.low_values import detect_low_values
    batch = (detect_above_limit(tx).unionByName(detect_low_values(tx)).unionByName(detect_location_jump(tx))
             .where(F.col("window_end") <= F.lit(max_ts)).select("seq", "fraud_reason"))
    s_rows = sorted(map(tuple, streamed.collect()))
    b_rows = sorted(map(tuple, batch.collect()))
    assert len(s_rows) > 0
    assert s_rows == b_rows


def test_no_filter_below_watermark(spark, scratch):
    """Plan guard: no row filter between the watermark and the aggregates."""
    tx = load_tx(spark, SF01)
    path = f"{scratch}/tx"
    tx.write.parquet(path)
    stream = spark.readStream.schema(tx.schema).parquet(path)
    state = windowed_state(stream)
    plan = spark._jvm.PythonSQLUtils.explainString(state._jdf.queryExecution(), "extended")
    plan = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "EventTimeWatermark" in plan
    below = plan.split("EventTimeWatermark")[1:]
    for part in below:
        # Only IsNotNull-style filters may appear beneath the watermark.
        for line in part.splitlines():
            if "Filter" in line:
                assert "isnotnull" in line.lower() and "<" not in line and ">" not in line, line


def _weekly_stream(spark, tx, scratch):
    src = f"{scratch}/in"
    _write_daily_json(spark, tx, src)
    raw = (spark.readStream.format("text").option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").load(src))
    framed = raw.select(F.split("value", "\t").getItem(0).cast("long").alias("seq"),
                        F.split("value", "\t").getItem(1).alias("value"))
    good, _ = decode_transactions(framed)
    return good


def test_trailing_rule_stream_equals_batch(spark, scratch):
    from cardsentry.operators.trailing import detect_trailing_repeat
    from cardsentry.streaming.trailing import trailing_repeat_stream
    tx = load_tx(spark, SF01)
    alerts = trailing_repeat_stream(_weekly_stream(spark, tx, scratch))
    q = (alerts.writeStream.format("parquet").outputMode("append")
         .option("path", f"{scratch}/w1").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = sorted(map(tuple, spark.read.parquet(f"{scratch}/w1").select("seq", "fraud_reason").collect()))
    want = sorted(map(tuple, detect_trailing_repeat(tx).select("seq", "fraud_reason").collect()))
    assert len(got) == 3882 and got == want


def test_late_rows_are_dropped_and_counted(spark, scratch):
    """A row older than the watermark is dropped (the reference drops it too).

    Spark compares late events with the watermark of the previous batch (the
    model that allows several stateful operators), so the late row comes two
    batches after the rows that moved the watermark."""
    from cardsentry.schema import TX_SCHEMA
    import datetime as dt
    from decimal import Decimal
    path = f"{scratch}/late"
    day = lambda d, s: (s, 1, dt.datetime(2024, 6, d, 12), Decimal("5.00"), 1, 100, 0.0, 0.0)
    spark.createDataFrame([day(3, 1)], TX_SCHEMA).coalesce(1).write.parquet(f"{path}/a")
    spark.createDataFrame([day(4, 2)], TX_SCHEMA).coalesce(1).write.parquet(f"{path}/b")
    spark.createDataFrame([day(1, 3)], TX_SCHEMA).coalesce(1).write.parquet(f"{path}/c")
    stream = spark.readStream.schema(TX_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    state = windowed_state(stream)
    q = (state.writeStream.format("memory").queryName("late_probe").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped >= 1
    kept = spark.sql("select explode(rows) as r from late_probe").select("r.seq").collect()
    assert 3 not in {r.seq for r in kept}


def test_csv_export_stream(spark, scratch):
    from cardsentry.sources.csv_io import read_transactions_csv
    from cardsentry.streaming.sinks import start_csv_export
    from conftest import SF001
    tx = load_tx(spark, SF001)
    tx.write.parquet(f"{scratch}/tx")
    stream = spark.readStream.schema(tx.schema).parquet(f"{scratch}/tx")
    q = start_csv_export(stream, f"{scratch}/csv", checkpoint_location=f"{scratch}/ck",
                         trigger={"availableNow": True})
    q.awaitTermination(300)
    back, bad = read_transactions_csv(spark, f"{scratch}/csv")
    assert bad.count() == 0
    assert back.count() == tx.count()


def test_stream_job_entry_point(spark, scratch):
    """``python -m cardsentry stream`` path: parquet files in, alerts out."""
    from cardsentry.plans.jobs import run_stream
    from conftest import SF001
    tx = load_tx(spark, SF001)
    tx.write.parquet(f"{scratch}/in")
    q = run_stream(spark, f"{scratch}/in", "parquet", f"{scratch}/out",
                   checkpoint=f"{scratch}/ck", trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.parquet(f"{scratch}/out").count() > 0


def test_alert_csv_export_stream(spark, scratch):
    from cardsentry.plans.detection import fraud_alerts
    from cardsentry.sources.csv_io import read_alerts_csv
    from cardsentry.streaming.sinks import start_csv_export
    from conftest import SF001
    alerts = fraud_alerts(load_tx(spark, SF001))
    alerts.write.parquet(f"{scratch}/alerts_in")
    stream = spark.readStream.schema(alerts.schema).parquet(f"{scratch}/alerts_in")
    q = start_csv_export(stream, f"{scratch}/csv", layout="alerts", checkpoint_location=f"{scratch}/ck",
                         trigger={"availableNow": True})
    q.awaitTermination(300)
    back = read_alerts_csv(spark, f"{scratch}/csv")
    cols = ["card_id", "ts", "value", "above_limit", "fraud_reason"]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, alerts.select(*cols).collect()))


@pytest.mark.parametrize("slices", [1, 4, 9])
def test_streams_do_not_depend_on_files_or_slices(spark, scratch, slices):
    """A folder of 40 shuffled files gives what the single file gives, at any number of slices."""
    from cardsentry.plans.catalog import q_stream_fraud_alerts, q_stream_trailing_24h_repeat
    events = spark.read.parquet(f"{SF001}/events.parquet")
    events.repartition(40, F.hash("event_id")).write.parquet(f"{scratch}/events.parquet")
    for query in (q_stream_fraud_alerts, q_stream_trailing_24h_repeat):
        want = sorted(map(str, query(spark, SF001, 1).collect()))
        got = sorted(map(str, query(spark, scratch, slices).collect()))
        assert want and got == want


def _messages(scratch):
    import json
    import os
    good = {"cardId": "1", "value": "0.31", "userId": "1", "limit": "20", "localization": {"latitude": 1.0, "longitude": 2.0}}
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.json", "w") as f:
        for day in (1, 2, 20):
            f.write(json.dumps(dict(good, timestamp=f"2024-06-{day:02d}T12:00:03")) + "\n")
        f.write("{broken\n")
        f.write(json.dumps({"cardId": "x"}) + "\n")


def test_alerts_and_bad_messages_leave_in_one_query(spark, scratch):
    from cardsentry.plans.jobs import run_stream
    _messages(scratch)
    running = len(spark.streams.active)
    q = run_stream(spark, f"{scratch}/in", "json", f"{scratch}/out", checkpoint=f"{scratch}/ck", trigger={"availableNow": True})
    assert len(spark.streams.active) <= running + 1
    q.awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(f"{scratch}/out-quarantine").collect()) == ["cardId", "unparsable"]
    assert spark.read.parquet(f"{scratch}/out").count() == 2


def test_a_failing_quarantine_stops_the_job(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    from cardsentry.plans import jobs
    from cardsentry.streaming.detect import parquet_sink, start_detection
    _messages(scratch)
    tx, bad = jobs.stream_transactions(spark, f"{scratch}/in", "json")

    def broken(rows, batch_id):
        raise OSError("no space left")

    q = start_detection(tx, parquet_sink(f"{scratch}/out"), f"{scratch}/ck", trigger={"availableNow": True}, query_name="failing", bad=bad, bad_sink=broken)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()
    with pytest.raises(ValueError):
        jobs._quarantine(bad, "", None)
    with pytest.raises(ValueError):
        jobs.stream_transactions(spark, f"{scratch}/in", "xml")


def test_csv_stream_export_and_trailing_jobs(spark, scratch):
    from cardsentry.plans.jobs import run_export, run_stream, run_trailing
    from cardsentry.sources.csv_io import read_transactions_csv, write_transactions_csv
    from cardsentry.sources.fixture import load_tx
    from conftest import SF001
    tx = load_tx(spark, SF001)
    write_transactions_csv(tx, f"{scratch}/csv")
    now = {"availableNow": True}
    run_stream(spark, f"{scratch}/csv", "csv", f"{scratch}/out", checkpoint=f"{scratch}/a", trigger=now).awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() > 0 and spark.read.parquet(f"{scratch}/out-quarantine").count() == 0
    run_export(spark, f"{scratch}/csv", "csv", f"{scratch}/dump", checkpoint=f"{scratch}/b", trigger=now).awaitTermination()
    assert read_transactions_csv(spark, f"{scratch}/dump")[0].count() == tx.count()
    run_trailing(spark, f"{scratch}/csv", "csv", f"{scratch}/trailing", checkpoint=f"{scratch}/c", trigger=now).awaitTermination()
    assert spark.read.parquet(f"{scratch}/trailing").count() > 0


def test_replay_slices_follow_the_rows_and_leave_no_copy(spark, scratch, monkeypatch):
    import os
    from cardsentry.streaming import replay as module
    events = spark.read.parquet(f"{SF001}/events.parquet")
    monkeypatch.setattr(module, "SLICE_ROWS", 150)
    sizes = []

    def start(stream):
        return (stream.writeStream.foreachBatch(lambda rows, batch_id: sizes.append(rows.count()))
                .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())

    module.replay(events, "ts", f"{scratch}/in", start)
    n = events.count()
    assert sum(sizes) == n and len(sizes) == -(-n // 150) > module.SLICES and max(sizes) < 2 * 150
    assert not os.path.exists(f"{scratch}/in")
