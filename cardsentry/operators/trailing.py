"""Trailing-24h repeat (W1), the keyed-state rule of the reference's draft job.

Per user, in arrival order (``ts``, then ``seq``): an above-limit row is an
alert when, counting itself, at least 2 above-limit rows of the user lie at
most 24 h before it (inclusive: exactly 24 h still counts).

Plan: "at least k rows in the last 24 h, counting this one" is the same as "the
(k-1)-th above-limit row before it in (ts, seq) order is at most 24 h old", so
one ``lag`` over the user's above-limit rows decides it: one sort, linear, ties
included.  To keep a hot user from landing whole in one task, rows are
partitioned by (user, bucket of time).  A bucket has ``bucket_hours``; a user with
more than ``bucket_rows`` above-limit rows gets as many buckets as that asks for, of
equal width between its first and last row.  What a bucket needs to know of the
ones before is the user's last k-1 rows: the last k-1 rows of every bucket (cut by a
row limit per group, which Spark plans on the map side) are put in order, and each is
copied, as read-only context, into the at most k-1 next buckets that can see it.
Results do not depend on the buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_micros
from ..schema import REASON_TRAILING_PREFIX, REASON_TRAILING_SUFFIX, TRAILING_MIN_COUNT
from .alerts import above_limit, to_alerts
from .skew import join_stats

KEY = "user_id"
BUCKET_ROWS = 200_000


def trailing_hits(tx: DataFrame, key: str = KEY, min_count: int = TRAILING_MIN_COUNT, hours: int = 24,
                  bucket_hours: int = 24, bucket_rows: int | None = None) -> DataFrame:
    """Above-limit rows of the key with at least ``min_count`` above-limit rows
    in the trailing ``hours`` (inclusive), counting the row and earlier arrivals."""
    above = tx.where(above_limit())
    back = min_count - 1
    if back <= 0:
        return above
    limit = bucket_rows or BUCKET_ROWS
    t = epoch_micros("ts")
    usual = F.floor(t / F.lit(bucket_hours * 3_600_000_000)).cast("long")
    counts = above.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_t0"), F.max(t).alias("_t1"))
    hot = counts.where(F.col("_n") > F.lit(limit))
    if hot.limit(1).count():
        wide = F.ceil((F.col("_t1") - F.col("_t0") + 1) / F.ceil(F.col("_n") / F.lit(limit))).cast("long")
        dealt = join_stats(above, hot.select(key, "_t0", wide.alias("_wide")), [key], how="left")
        own = F.floor((t - F.col("_t0")) / F.col("_wide")).cast("long")
        rows = dealt.withColumn("_bucket", F.coalesce(own, usual)).drop("_t0", "_wide")
    else:
        rows = above.withColumn("_bucket", usual)
    rows = rows.withColumn("_ctx", F.lit(False))
    last = Window.partitionBy(key, "_bucket").orderBy(F.col("ts").desc(), F.col("seq").desc())
    tail = rows.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") <= back).drop("_rn")
    # in the order of all tails, a row is one of the last k-1 before the buckets of its next k-1 rows
    user = Window.partitionBy(key).orderBy("_bucket", "ts", "seq")
    ahead = F.array_distinct(F.array(*[F.lead("_bucket", j).over(user) for j in range(1, back + 1)]))
    context = (tail.withColumn("_ahead", ahead).withColumn("_next", F.explode("_ahead"))
               .where(F.col("_next") > F.col("_bucket"))
               .withColumn("_bucket", F.col("_next")).withColumn("_ctx", F.lit(True)).drop("_ahead", "_next"))
    # context comes first: a bucket's rows are later than any of an earlier bucket
    order = Window.partitionBy(key, "_bucket").orderBy("ts", "seq")
    before = F.lag("ts", back).over(order)
    dealt = rows.unionByName(context).withColumn("_before", before)
    young = (epoch_micros("ts") - epoch_micros("_before")) <= F.lit(hours * 3_600_000_000)
    return dealt.where(~F.col("_ctx") & young).drop("_bucket", "_ctx", "_before")


def detect_trailing_repeat(tx: DataFrame, key: str = KEY, min_count: int = TRAILING_MIN_COUNT,
                           hours: int = 24, bucket_hours: int = 24, bucket_rows: int | None = None) -> DataFrame:
    """Flat alerts of the trailing rule (no window columns: it is not windowed)."""
    rows = trailing_hits(tx, key, min_count, hours, bucket_hours, bucket_rows)
    reason = F.concat(F.lit(REASON_TRAILING_PREFIX), F.col("user_id").cast("string"),
                      F.lit(REASON_TRAILING_SUFFIX))
    return to_alerts(rows, reason)
