"""Intermediate tables in the folder that ``spark.checkpoint.dir`` names.

A job that reads a result more than once, or cuts its lineage, writes it here. All tables of one application lie in one folder, so
that whatever a job could not delete (because the frame it returns is read later) goes with ``clear`` when the application is done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from urbanlens.session import checkpoint_subdir


def folder(spark: SparkSession) -> str:
    return checkpoint_subdir(spark, f"scratch/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written as Parquet and read back: computed once, whoever reads it and whichever executor is lost."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` that nothing will read again."""
    _delete(df.sparkSession, df._scratch_path)


def clear(spark: SparkSession) -> None:
    """Delete all of this application's intermediate tables; frames that read them must have been written or collected."""
    _delete(spark, folder(spark))
