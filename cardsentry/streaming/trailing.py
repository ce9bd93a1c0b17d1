"""Trailing-24h repeat (W1) on a stream: keyed state with a time-out (X7).

Per user the state holds the times of the last ``min_count - 1`` above-limit
rows; an above-limit row alerts when the oldest of them is at most 24 h old.  Only
above-limit rows go to the state; they are picked above the watermark, which
follows all rows.

Users are dealt to ``shards`` by hash, and a shard is one key of the state: a call of
the state function costs some milliseconds however few rows it gets, so its calls
follow the shards and the micro-batches, not the users, and it works on all users of
its shard at once.  A time is dropped from the state once the watermark is 24 h past
it, a shard without times is removed (event-time time-out, the TTL).  More users
ask for more shards; a checkpoint keeps the number it was begun with.

Within a micro-batch the rows of a user are taken in (ts, seq) order, so for
in-order input the alerts equal the batch rule's.  State per user is a few
numbers; one shard's above-limit rows of a single micro-batch are sorted together, so
a trigger size (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) bounds that step.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions.timefmt import epoch_micros
from ..schema import (REASON_TRAILING_PREFIX, REASON_TRAILING_SUFFIX, TRAILING_MIN_COUNT, TX_SCHEMA)
from .detect import with_event_time

cloudpickle.register_pickle_by_value(sys.modules[__name__])



def alert_schema(tx: T.StructType) -> T.StructType:
    """Flat alert columns with the transaction's own types."""
    return T.StructType([tx[f.name] for f in TX_SCHEMA.fields]
                        + [T.StructField("above_limit", T.BooleanType()), T.StructField("fraud_reason", T.StringType())])


STATE = T.StructType([T.StructField("held_users", T.ArrayType(T.LongType())),
                      T.StructField("held_us", T.ArrayType(T.LongType()))])
SHARDS = 1024
NO_USER = -(1 << 62)        # rows without a user id are a user of their own


def _trailing_step(min_count: int, window_us: int):
    import numpy as np
    import pandas as pd

    cols = [f.name for f in TX_SCHEMA.fields]
    back = min_count - 1

    def step(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        held = ([], [])
        if state.exists:
            held = state.get
        batch = pd.concat(list(pdfs), ignore_index=True)
        arrival = np.lexsort((batch["seq"].to_numpy(), batch["_t"].to_numpy()))
        n_held = len(held[0])
        user = np.concatenate([np.array(held[0], np.int64), batch["_user"].to_numpy()[arrival]])
        t = np.concatenate([np.array(held[1], np.int64), batch["_t"].to_numpy()[arrival]])
        # user by user: the held times, then the new rows in arrival order
        at = np.argsort(user, kind="stable")
        user, t = user[at], t[at]
        # the (min_count - 1)-th above-limit row before a row decides
        hit = np.zeros(len(at), bool)
        if back <= 0:
            hit[:] = True
        else:
            hit[back:] = (user[back:] == user[:-back]) & (t[back:] - t[:-back] <= window_us)
        out = arrival[at[hit & (at >= n_held)] - n_held]
        keep = np.zeros(len(at), bool)
        if back > 0:
            keep[-back:] = True
            keep[:-back] = user[back:] != user[:-back]
        # rows to come are later than the watermark: they see no time that is 24 h before it
        watermark = state.getCurrentWatermarkMs() or 0
        if watermark > 0:
            keep &= t + window_us >= watermark * 1000
        if keep.any():
            state.update((user[keep].tolist(), t[keep].tolist()))
            # a time-out may not precede the current watermark
            state.setTimeoutTimestamp(max((int(t[keep].max()) + window_us) // 1000 + 1, watermark + 1, 1))
        elif state.exists:
            state.remove()
        if len(out):
            yield batch.iloc[out][cols]

    return step


def trailing_repeat_stream(stream: DataFrame, delay: str = "0 seconds",
                           min_count: int = TRAILING_MIN_COUNT, hours: int = 24, shards: int = SHARDS) -> DataFrame:
    """Streaming W1 alerts (flat alert columns); run with output mode append."""
    s = with_event_time(stream).withWatermark("event_ts", delay)
    # a predicate that reads the event time stays above the watermark
    above = F.coalesce(F.col("value") > F.when(F.col("event_ts").isNotNull(), F.col("lim")), F.lit(False))
    rows = s.where(above).select(
        "event_ts", *[f.name for f in TX_SCHEMA.fields], epoch_micros("ts").alias("_t"),
        F.coalesce(F.col("user_id").cast("long"), F.lit(NO_USER)).alias("_user"),
        F.pmod(F.xxhash64("user_id"), F.lit(shards)).alias("_shard"))
    schema = alert_schema(s.schema)
    hits = (rows.groupBy("_shard")
            .applyInPandasWithState(_trailing_step(min_count, hours * 3_600_000_000), T.StructType(schema.fields[:-2]), STATE,
                                    "append", GroupStateTimeout.EventTimeTimeout))
    reason = F.concat(F.lit(REASON_TRAILING_PREFIX), F.col("user_id").cast("string"), F.lit(REASON_TRAILING_SUFFIX))
    return hits.select("*", F.lit(True).alias("above_limit"), reason.alias("fraud_reason"))
