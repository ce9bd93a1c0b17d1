"""Tables in the cluster's shared folder, and joins that survive a hot key.

The shared folder is the one the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import io
import os
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def _located(spark: SparkSession, path: str):
    """A path and its file system, as the session is configured."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    A zip of its modules goes to the shared folder and from there to every
    executor (``addPyFile``), so a session may start in any folder.  A package that
    was itself loaded from a zip has been shipped by whoever did so.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or not os.path.isdir(PACKAGE):
        return
    held, name = io.BytesIO(), os.path.basename(PACKAGE)
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(PACKAGE)):
            for file in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, file)
                with open(full, "rb") as f:
                    z.writestr(zipfile.ZipInfo(os.path.join(name, os.path.relpath(full, PACKAGE))), f.read())
    data = held.getvalue()
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}.zip"
    where, files = _located(spark, path)
    out = files.create(where)
    out.write(data)
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


class Scratch:
    """Intermediate tables of one operator call, written as Parquet in the shared folder.

    A written table cuts the lineage and outlives lost executors.  Leaving the
    ``with`` block deletes every table that was not kept.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._paths: list[str] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        for path in self._paths:
            self._delete(path)

    def _delete(self, path: str) -> None:
        where, files = _located(self.spark, path)
        files.delete(where, True)

    def stash(self, df: DataFrame, label: str, keep: bool = False) -> DataFrame:
        """Write ``df`` and read it back; ``keep`` leaves it for lazy results that read it later."""
        self._n += 1
        path = f"{self.root}/{self._n:02d}-{label}"
        df.write.parquet(path)
        if not keep:
            self._paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)


def salted_join(rows: DataFrame, stats: DataFrame, on: Sequence[str], spread: Column, salts: int = 16, how: str = "inner") -> DataFrame:
    """Join rows with one-row-per-key ``stats``, each key's rows dealt over ``salts`` tasks.

    ``spread`` is an integer that differs between the rows of a key.  Every
    stats row is copied ``salts`` times, so ``stats`` should be narrow.
    """
    left = rows.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
    right = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


MAX_BROADCAST_ROWS = 20_000


def stats_join(rows: DataFrame, stats: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join with a written table of narrow per-key rows: broadcast if its row count is small, else salted."""
    if stats.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(stats), key, "left")
    return salted_join(rows, stats, [key], spread, how="left")


MAX_BROADCAST_IDS = 1_000_000


def small(table: DataFrame, rows: int = MAX_BROADCAST_IDS) -> bool:
    """Whether a written table of a few numbers a row is small enough to broadcast (8 to 40 MB)."""
    return table.limit(rows + 1).count() <= rows


def text_print() -> Column:
    """Fingerprint of a row's text, which tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def drop_rows(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text fingerprint are in the written table ``lost(doc_id, fp)``.

    A small table is broadcast, so that the texts stay where they are; beyond
    ``MAX_BROADCAST_IDS`` rows both sides are shuffled.  Null doc_ids stay, and so
    do other texts under a doc_id that is listed.
    """
    id_, fp = fresh(docs, "lost"), fresh(docs, "print")
    lost = lost.select(F.col("doc_id").alias(id_), "fp")
    lost = F.broadcast(lost) if small(lost) else lost
    keyed = docs.withColumn(fp, text_print())
    return keyed.join(lost, (keyed["doc_id"].cast("long") == lost[id_]) & (keyed[fp] == lost["fp"]), "left_anti").drop(fp)


def about(rows: DataFrame, hashed: Column, n: int) -> DataFrame:
    """About ``n`` rows, chosen by a hash column; all of them if there are no more.  Nothing is sorted or gathered."""
    total = rows.count()
    if total <= n:
        return rows
    return rows.where(F.pmod(hashed, F.lit(1_000_000_000)) < F.lit(1_000_000_000 * n // total))
