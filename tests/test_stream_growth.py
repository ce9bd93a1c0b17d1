"""What a replayed stream costs follows its rows: one scan of the table for all slices, one call of the state function per shard."""

import datetime as dt
from decimal import Decimal

import pytest

from cardsentry.operators.trailing import detect_trailing_repeat
from cardsentry.schema import TX_SCHEMA
from cardsentry.streaming.trailing import trailing_repeat_stream


def _tx(spark, users=40):
    """Rows of several days; users, times and values may be missing, (ts, seq) may repeat."""
    rows = []
    for u in range(users):
        for i in range(6):
            at = dt.datetime(2024, 6, 1 + i // 2, (u * 7 + i * 5) % 24, (u * i) % 60)
            rows.append((u * 10 + i, u, at, Decimal("30.00") if (u + i) % 3 else Decimal("1.00"), u, 20, 1.0, 2.0))
    late = dt.datetime(2024, 6, 2, 1)
    rows += [rows[0], (9001, 1, late, None, 1, 20, 1.0, 2.0), (9002, 1, None, Decimal("30.00"), 1, 20, 1.0, 2.0), (9003, 1, late, Decimal("30.00"), 1, None, 1.0, 2.0)]
    rows += [(9010 + i, 1, late + dt.timedelta(hours=i), Decimal("30.00"), None, 20, 1.0, 2.0) for i in range(3)]
    return spark.createDataFrame(rows, TX_SCHEMA)


@pytest.mark.parametrize("min_count", [1, 2, 3])
def test_trailing_stream_calls_follow_shards_and_give_the_batch_rows(spark, scratch, min_count):
    from cardsentry.streaming.replay import replay
    tx = _tx(spark)
    states = []

    def start(stream):
        q = (trailing_repeat_stream(stream, min_count=min_count, shards=3).writeStream.format("parquet").outputMode("append")
             .option("path", f"{scratch}/w1").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        states.extend(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators)
        return q

    replay(tx, "ts", f"{scratch}/in", start, 3)
    got = sorted(map(str, spark.read.parquet(f"{scratch}/w1").collect()))
    known = tx if min_count > 1 else tx.where("ts is not null")
    assert got and got == sorted(map(str, detect_trailing_repeat(known, min_count=min_count).collect()))
    assert max(states) <= 3 and (min_count == 1 or max(states) > 0)


def test_only_above_limit_rows_reach_the_state_and_all_rows_the_watermark(spark, scratch):
    tx = _tx(spark)
    tx.write.parquet(f"{scratch}/tx")
    out = trailing_repeat_stream(spark.readStream.schema(tx.schema).parquet(f"{scratch}/tx"))
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "extended")
    plan = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    above, below = plan.split("EventTimeWatermark")
    assert any("Filter" in line and "value" in line for line in above.splitlines())
    assert "Filter" not in below


def test_replay_scans_the_table_once_for_all_slices(spark, scratch):
    from cardsentry.streaming.replay import replay
    tx = _tx(spark)
    n, read = tx.count(), spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            read.add(len(f))
            yield f

    def start(stream):
        return (stream.writeStream.format("parquet").option("path", f"{scratch}/out")
                .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())

    replay(tx.mapInPandas(counted, tx.schema), "ts", f"{scratch}/in", start, 6)
    # once for the bounds of the slices, once to deal the rows
    assert read.value == 2 * n
    assert sorted(map(str, spark.read.parquet(f"{scratch}/out").collect())) == sorted(map(str, tx.collect()))


def test_closed_windows_that_cannot_alert_stay_out_of_the_detectors(spark):
    """Same alerts as from all rows; groups are picked by their arrays before their rows are taken apart."""
    from pyspark.sql import functions as F

    from cardsentry.operators.windows import assign_windows
    from cardsentry.plans.detection import user_day_alerts
    from cardsentry.schema import TX_COLUMNS
    from cardsentry.streaming.detect import alerts_from_closed_windows
    rows = []
    for u in range(30):
        for i in range(u % 9):
            at = dt.datetime(2024, 6, 3, 5, i * 6)
            far = 2.0 if u % 2 and i % 3 == 2 else 0.0
            rows.append((u * 10 + i, u, at, Decimal("30.00"), u, 20 if u % 4 else 99, 10.0 + far, 20.0))
    rows += [(900, 1, dt.datetime(2024, 6, 3, 5), Decimal("30.00"), 1, 20, None, 20.0), rows[-1]]
    rows += [(910 + i, 1, dt.datetime(2024, 6, 3, i), Decimal("30.00"), None, 20, 10.0 * (i % 2), 20.0) for i in range(6)]
    tx = spark.createDataFrame(rows, TX_SCHEMA)
    w = assign_windows(tx, "1 day")
    groups = (w.groupBy("window_start", "window_end", "user_id").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(*TX_COLUMNS)).alias("rows"))
              .select(F.lit("user").alias("tag"), "window_start", "window_end", "n", "rows"))
    out = alerts_from_closed_windows(groups, ("24 hours", None), ("1 day", None))
    got, want = (sorted(map(str, d.select("seq", "fraud_reason", "window_start").collect())) for d in (out, user_day_alerts(tx)))
    assert got == want and len({x.split("fraud_reason=")[1][:20] for x in got}) == 2
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "array_min(" in plan and "MapInPandas" in plan


def test_micro_batches_without_closed_windows_run_no_detector(spark, scratch):
    from cardsentry.streaming.detect import start_detection
    tx = _tx(spark).where("ts < '2024-06-01 20:00:00'")
    tx.coalesce(1).write.parquet(f"{scratch}/in")
    seen = []

    def sink(alerts, batch_id):
        plan = spark._jvm.PythonSQLUtils.explainString(alerts._jdf.queryExecution(), "simple")
        seen.append((alerts.count(), "MapInPandas" in plan))

    q = start_detection(spark.readStream.schema(tx.schema).parquet(f"{scratch}/in"), sink, f"{scratch}/ck", trigger={"availableNow": True}, query_name="no_closed_windows")
    q.awaitTermination()
    assert q.exception() is None and seen and set(seen) == {(0, False)}
