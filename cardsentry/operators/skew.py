"""Joins of rows with one-row-per-key statistics that split a hot key.

AQE splits a skewed sort-merge join only between two plain shuffles; here one
side is an aggregate, so a hot key's rows would meet in one task.  Each key's
rows are dealt over ``salts`` tasks and the (narrow) statistics row is copied to
all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def join_stats(rows: DataFrame, stats: DataFrame, on: list[str], spread: str | Column = "seq",
               how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``rows`` with ``stats`` (one row per ``on``); ``spread`` tells the rows of a key apart."""
    spread = F.col(spread) if isinstance(spread, str) else spread
    left = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
    right = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
