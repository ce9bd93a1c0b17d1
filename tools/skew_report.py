"""Reproduce the README's skew evidence: one user holds a third of all rows;
report shuffle records read per task (max / median) per stage, from Spark's
event log.  Usage: python tools/skew_report.py [sf_dir] [scratch_dir]"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NAMES = ["detect_above_limit", "detect_low_values", "trailing_24h_repeat", "detect_location_jump"]


def main() -> None:
    import zstandard
    from pyspark.sql import functions as F

    from cardsentry.plans.catalog import QUERIES
    from cardsentry.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    run = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-report-")
    spark = get_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": run,
                                                "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    hot.repartition(8).write.parquet(f"{run}/skew/events.parquet")
    for name in NAMES:
        spark.sparkContext.setJobDescription(name)
        QUERIES[name](spark, f"{run}/skew").write.format("noop").mode("overwrite").save()
    spark.stop()

    log = glob.glob(f"{run}/eventlog*/events_*")[0]
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(open(log, "rb").read())) as r:
        lines = r.read().decode().splitlines()
    desc, reads = {}, {}
    for line in lines:
        e = json.loads(line)
        if e["Event"] == "SparkListenerStageSubmitted":
            desc[e["Stage Info"]["Stage ID"]] = (e.get("Properties") or {}).get("spark.job.description", "")
        elif e["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in e:
            got = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            reads.setdefault(e["Stage ID"], []).append(got)
    for sid in sorted(reads):
        recs = reads[sid]
        if desc.get(sid) and max(recs) > 0:
            print(f"{desc[sid]:22s} stage {sid:3d} tasks {len(recs):3d} "
                  f"max {max(recs):7d} median {int(statistics.median(recs)):7d} total {sum(recs):8d}")


if __name__ == "__main__":
    main()
