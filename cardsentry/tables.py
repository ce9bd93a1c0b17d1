"""Intermediate tables in the cluster's shared folder.

``stash`` writes a DataFrame below the folder that ``spark.checkpoint.dir`` names
and reads it back: the lineage is cut there, a lost executor costs no step before
it, and a result that several plans need is computed once.  The tables of an
application lie in one folder of its own, which ``drop_stashed`` deletes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cardsentry-{spark.sparkContext.applicationId}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever file system its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def drop_stashed(spark: SparkSession) -> None:
    """Delete all tables that this application stashed; results that still read them are void then."""
    drop_folder(spark, _folder(spark))
