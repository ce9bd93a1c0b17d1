"""Nearest-in-time match (J1): for every probe row, the reference row of the
same group with the least ``|Δt|`` in *whole seconds* (truncated), ties to
the earliest timestamp and then the earliest arrival.

Because the key is truncated, the nearest reference on each side is not
enough: with a probe at t, references at t−10.9 s and t−10.2 s both have key
10 and the earlier one wins.  Two ordered scans over the group solve it
exactly, with no join and no pairs:

1. in arrival order (ts, seq), running ``last`` forward gives ``prev`` (the
   latest reference at or before the probe) and backward gives ``next`` (the
   first reference after it); their whole-second distances are ``kb`` and
   ``ka``.  (References sharing the probe's ts land on either side; both
   have key 0 and step 2 still returns the earliest of them.)
2. if the earlier side wins (``kb <= ka``) the answer is the earliest
   reference with ts ≥ t − (kb+1) s + 1 µs: a second backward running ``last``
   from a probe moved to that instant.

The scans are window functions over *segments*: a group of many rows is cut into
stretches of time of equal width, as many as its row count asks for
(``with_segments``), and each is scanned by itself.  What a segment needs to know
of the others is one row either way: the last reference before it and the first
one after it.  Those come from one small row per segment (partial aggregates) and
are put into the segment as context rows, so no join touches the data.  Step 2
looks up the moved probe in the segment of the instant it moved to.  A group of
few rows is one segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_micros

ORDER = ["ts", "seq"]
REF_FIELDS = ["ts", "seq", "lat", "lon"]
SEGMENT_ROWS = 200_000
MAX_SEGMENTS = 1024
MIN_SEGMENT_US = 2_000_000


def with_segments(df: DataFrame, segment_rows: int = 0, min_us: int = MIN_SEGMENT_US) -> DataFrame:
    """Replace a group's ``_rows``, ``_t0``, ``_t1`` (row count, first and last instant) by what ``nearest_in_time`` cuts it with.

    Rows of one instant stay together; segments are at least ``min_us`` wide.
    A table without these columns has no large group and is left as it is."""
    if "_rows" not in df.columns:
        return df
    span = F.col("_t1") - F.col("_t0") + 1
    wanted = F.least(F.ceil(F.col("_rows") / F.lit(segment_rows or SEGMENT_ROWS)), F.floor(span / F.lit(min_us)), F.lit(MAX_SEGMENTS))
    return (df.withColumn("_k", F.greatest(wanted, F.lit(1)).cast("long"))
            .withColumn("_wide", F.ceil(span / F.col("_k")).cast("long")).drop("_rows", "_t1"))


def _segment(micros: F.Column) -> F.Column:
    at = F.floor((micros - F.col("_t0")) / F.col("_wide")).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(at, F.col("_k") - 1))


def _context(df: DataFrame, group_cols: list[str], ref: F.Column, columns: list[str]) -> DataFrame:
    """The reference rows next to each segment of a group with several: the last one before it and the first one after it."""
    cut = [*group_cols, "_k", "_t0", "_wide"]
    row = F.when(ref, F.struct(*dict.fromkeys([*ORDER, *columns])))
    ends = df.where(F.col("_k") > 1).groupBy(*cut, "_seg").agg(F.min(row).alias("_min"), F.max(row).alias("_max"))
    # segments without rows too: a moved probe may fall into one
    every = ends.select(*cut).distinct().withColumn("_seg", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    ends = every.join(ends, [*cut, "_seg"], "left")
    up, down = (Window.partitionBy(*group_cols).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_seg"), F.col("_seg").desc()))
    both = F.array(F.last("_max", ignorenulls=True).over(up), F.last("_min", ignorenulls=True).over(down))
    found = ends.select(*cut, "_seg", both.alias("_both")).select(*cut, "_seg", F.explode("_both").alias("_row")).where(F.col("_row").isNotNull())
    return found.select("_row.*", *[c for c in [*cut, "_seg"] if c not in columns], F.lit(True).alias("_ctx"))


def nearest_in_time(df: DataFrame, group_cols: list[str], is_ref: str = "is_main",
                    carry: list[str] | None = None, keep_all: bool = False) -> DataFrame:
    """Return the non-reference rows of ``df`` with struct ``near`` (the
    chosen reference row: ts, seq, lat, lon and ``carry`` fields) and
    ``near_key`` (whole seconds between).  With ``keep_all`` every row is
    returned (``near`` is NULL on reference rows and where a group has none).
    Groups are cut into segments if ``df`` comes from ``with_segments``."""
    segmented = "_k" in df.columns
    fields = REF_FIELDS + [c for c in (carry or []) if c not in REF_FIELDS]
    ref = F.col(is_ref)
    ref_struct = F.when(ref, F.struct(*fields))
    t_us = epoch_micros("ts")

    base = df
    by, by2 = group_cols, group_cols
    if segmented:
        base = base.withColumn("_seg", _segment(t_us)).withColumn("_ctx", F.lit(False))
        base = base.unionByName(_context(base, group_cols, ref, df.columns))
        by, by2 = [*group_cols, "_seg"], [*group_cols, "_seg2"]
    base = base.withColumn("_t_us", t_us)
    fwd = arrival_window(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bwd = (Window.partitionBy(*by).orderBy(F.col("ts").desc(), F.col("seq").desc())
           .rowsBetween(Window.unboundedPreceding, -1))
    step1 = (base
             .withColumn("_prev", F.last(ref_struct, ignorenulls=True).over(fwd))
             .withColumn("_next", F.last(ref_struct, ignorenulls=True).over(bwd)))
    kb = F.floor((F.col("_t_us") - epoch_micros("_prev.ts")) / F.lit(1_000_000)).cast("long")
    ka = F.floor((epoch_micros("_next.ts") - F.col("_t_us")) / F.lit(1_000_000)).cast("long")
    step1 = step1.withColumn("_kb", kb).withColumn("_ka", ka)
    before_wins = F.col("_prev").isNotNull() & (F.col("_next").isNull() | (F.col("_kb") <= F.col("_ka")))
    step1 = step1.withColumn("_probe", ~ref & before_wins)

    # Scan 2: probes move to the earliest instant still inside their key.
    probe_us = F.col("_t_us") - (F.col("_kb") + 1) * F.lit(1_000_000) + 1
    sort_us = F.when(F.col("_probe"), probe_us).otherwise(F.col("_t_us"))
    kind2 = F.when(F.col("_probe"), F.lit(0)).when(ref, F.lit(1)).otherwise(F.lit(2))
    step2 = step1.withColumn("_sort_us", sort_us).withColumn("_kind2", kind2)
    if segmented:
        step2 = step2.withColumn("_seg2", F.when(F.col("_ctx"), F.col("_seg")).otherwise(_segment(F.col("_sort_us"))))
    bwd2 = (Window.partitionBy(*by2)
            .orderBy(F.col("_sort_us").desc(), F.col("_kind2").desc(), F.col("seq").desc())
            .rowsBetween(Window.unboundedPreceding, -1))
    step2 = step2.withColumn("_first_in_key", F.last(ref_struct, ignorenulls=True).over(bwd2))

    near = F.when(F.col("_probe"), F.col("_first_in_key")).otherwise(F.col("_next"))
    key = F.when(F.col("_probe"), F.col("_kb")).otherwise(F.col("_ka"))
    has_near = ~ref & (F.col("_prev").isNotNull() | F.col("_next").isNotNull())
    if keep_all:
        out = (step2.withColumn("near", F.when(has_near, near))
               .withColumn("near_key", F.when(has_near, key)))
    else:
        out = step2.where(has_near).withColumn("near", near).withColumn("near_key", key)
    if segmented:
        out = out.where(~F.col("_ctx")).drop("_seg", "_seg2", "_ctx", "_k", "_t0", "_wide")
    return out.drop("_t_us", "_prev", "_next", "_kb", "_ka", "_probe",
                    "_sort_us", "_kind2", "_first_in_key")


def arrival_window(group_cols: list[str]):
    """The group in arrival order, (ts, seq); window functions of other
    operators that use this spec share its sort."""
    return Window.partitionBy(*group_cols).orderBy("ts", "seq")
