"""Event-time window assignment (length, slide), aligned to 1970-01-01.

``assign_windows`` adds ``window_start`` / ``window_end``; a sliding window
(slide < length) repeats a row once per window it falls into, exactly like
``window()`` inside a ``groupBy``.  Every detector takes ``length`` and
``slide`` and groups by ``(key, window_start, window_end)``.

Sliding windows share **panes**: stretches of gcd(length, slide), of which every
window is a whole number.  Rows are reduced once per pane (``with_pane``), the
small pane rows are repeated per window (``assign_windows`` over ``pane_start``),
and a window's verdict goes back to the rows by pane (``panes_of_windows``), so no
row is repeated before its window is known to matter.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_COLS = ["window_start", "window_end"]
PANE = "pane_start"

_UNITS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600,
          "day": 86400, "week": 604800}


def duration_seconds(text: str) -> float | None:
    """Duration text such as ``"24 hours"``, ``"1 day"``, ``"3.5 days"`` in
    seconds; ``None`` if any part is not understood."""
    parts = re.findall(r"\s*(\d+(?:\.\d+)?)\s*([a-z]+)\s*", text.lower())
    if not parts or "".join(f"{n}{u}" for n, u in parts) != re.sub(r"\s+", "", text.lower()):
        return None
    total = 0.0
    for num, unit in parts:
        unit = unit[:-1] if unit.endswith("s") else unit
        if unit not in _UNITS:
            return None
        total += float(num) * _UNITS[unit]
    return total


def assign_windows(df: DataFrame, length: str, slide: str | None = None,
                   time_col: str = "ts") -> DataFrame:
    if "window_start" in df.columns:      # already windowed upstream (streaming groups)
        return df
    w = F.window(time_col, length, slide or length)
    return (df.withColumn("_w", w)
            .withColumn("window_start", F.col("_w.start"))
            .withColumn("window_end", F.col("_w.end"))
            .drop("_w"))


def pane_seconds(df: DataFrame, length: str, slide: str | None = None) -> int | None:
    """Pane of a sliding window in whole seconds; ``None`` where panes bring nothing
    (tumbling, already windowed) or the texts are not whole seconds."""
    if "window_start" in df.columns:
        return None
    long, step = duration_seconds(length), duration_seconds(slide or length)
    if not long or not step or long == step or long % 1 or step % 1:
        return None
    return math.gcd(int(long), int(step))


def with_pane(df: DataFrame, seconds: int, time_col: str = "ts") -> DataFrame:
    return df.withColumn(PANE, F.window(time_col, f"{seconds} seconds").getField("start"))


def panes_of_windows(windows: DataFrame, seconds: int) -> DataFrame:
    """One row per (window, pane in it)."""
    pane = F.make_dt_interval(secs=F.lit(seconds))
    return windows.withColumn(PANE, F.explode(F.sequence("window_start", F.col("window_end") - pane, pane)))
