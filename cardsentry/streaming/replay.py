"""A bounded table as a stream in event-time order.

A file stream hands out files in the order of their modification times, which
need not be the order of the events in them.  With a watermark that follows the
largest event time, every file after the first micro-batch could then be late.
``replay`` cuts the table into slices of event time and feeds them one after the
other: one pass over the table deals its rows to the slices in the shared checkpoint
folder, then each slice is copied to the folder that the query reads, the query reads
what is new there, and only then the next slice follows.  A slice has
about ``SLICE_ROWS`` rows however large the table is, each row is read from the table
once for all slices, and the copies are deleted
when the last one is read.  Results do not depend on how many files the table has,
how they are ordered, or how many slices are made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..tables import drop_folder

SLICES = 4                  # at least
SLICE_ROWS = 5_000_000
SLICE = "_slice"


def slice_bounds(table: DataFrame, ts: str, slices: int) -> list:
    """Event times that cut the table into about equal slices (approximate quantiles)."""
    if slices <= 1:
        return []
    at = [i / slices for i in range(1, slices)]
    row = table.select(F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp")), at, max(1000, 10 * slices)).alias("q")).first()
    return sorted(set(row["q"] or []))


def replay(table: DataFrame, ts: str, folder: str, start: Callable[[DataFrame], StreamingQuery],
           slices: int | None = None) -> None:
    """Run the query that ``start(stream)`` returns over the whole table, slice by slice.

    ``start`` must use the ``availableNow`` trigger and one fixed checkpoint
    location, so that each call goes on where the last one stopped.  The number of
    slices follows the row count where it is not given.
    """
    spark = table.sparkSession
    if slices is None:
        slices = max(SLICES, -(-table.count() // SLICE_ROWS))
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    bounds = slice_bounds(table, ts, slices)
    # the number of bounds before a row; rows without an event time go first, they never open a window
    before = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < micros)) if bounds else F.lit(0)
    dealt = f"{folder}-slices"
    table.withColumn(SLICE, before).write.partitionBy(SLICE).parquet(dealt)
    with_slice = T.StructType([*table.schema.fields, T.StructField(SLICE, T.IntegerType())])
    for k in range(len(bounds) + 1):
        rows = spark.read.schema(with_slice).parquet(dealt).where(F.col(SLICE) == k).drop(SLICE)
        rows.write.mode("append").parquet(folder)
        query = start(spark.readStream.schema(table.schema).parquet(folder))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
    drop_folder(spark, dealt)
    drop_folder(spark, folder)
