"""Loads of result batches that can be repeated (S8-S10, K5), and rows that a load rejects.

Result tables are partitioned by ``batch_nr``. A load writes all of its rows to scratch tables first, so that nothing is touched
while something can still fail to compute; takes back the batch's commit mark; overwrites the batch's partition of every
table; and sets the mark, a lineage row, last. Run again, after a crash at any point or for a batch that is there already, it ends in the
same tables: each row once. Readers (:func:`loaded`) see batches with a mark only, so never half of one. Two loads of one batch must not
run at the same time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.sources.io import JOB_LOAD
from urbanlens.sources.scratch import forget, stored


def conformed(df: DataFrame, target: DataFrame) -> DataFrame:
    """``df`` with the columns of ``target`` but its partition ``batch_nr``, by name and cast to their types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields if f.name != "batch_nr"])


def _overwrite(spark: SparkSession, table: str, partition: str, df: DataFrame) -> None:
    """Replace one partition, by nothing if ``df`` is empty."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT * FROM {{df}}", df=df)


def load_batch(spark: SparkSession, db: str, batch_nr: int, frames: Mapping[str, DataFrame], mark: DataFrame) -> None:
    """Load ``frames`` (by table name) as batch ``batch_nr`` of the tables of ``db``; ``mark`` is the lineage row of the load."""
    staged = {name: stored(conformed(df, spark.table(f"{db}.{name}")), f"load-{name}") for name, df in frames.items()}
    own = f"batch_nr = {int(batch_nr)}"
    spark.sql(f"ALTER TABLE {db}.data_lineage DROP IF EXISTS PARTITION ({own}, job_nr = {JOB_LOAD})")
    for name, df in staged.items():
        _overwrite(spark, f"{db}.{name}", own, df)
    _overwrite(spark, f"{db}.data_lineage", f"{own}, job_nr = {JOB_LOAD}", conformed(mark, spark.table(f"{db}.data_lineage")).drop("job_nr"))
    for df in staged.values():
        forget(df)


def committed(spark: SparkSession, db: str) -> DataFrame:
    """``batch_nr`` of the batches whose load is done."""
    return spark.table(f"{db}.data_lineage").where(F.col("job_nr") == JOB_LOAD).select("batch_nr").distinct()


def loaded(spark: SparkSession, db: str, name: str) -> DataFrame:
    """The rows of a result table that belong to finished loads."""
    return spark.table(f"{db}.{name}").join(committed(spark, db), "batch_nr", "left_semi")


def checked_on_load(rows: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """F21 with reasons: ``raw`` (the columns of ``kinds`` as they came), all columns with these cast, and ``reasons``, why casts failed.

    A null stays null and is no reason; a text that can't be read, or a number that the type can't hold, is one.
    """
    def reason(name: str, kind: str) -> Column:
        return F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), F.lit(f"{name}: not {kind}"))

    reasons = F.array_compact(F.array(*[reason(n, k) for n, k in kinds.items()]))
    typed = [F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in rows.columns]
    return rows.select(F.struct(*[F.col(n).cast("string").alias(n) for n in kinds]).alias("raw"), *typed, reasons.alias("reasons"))


def accepted(checked: DataFrame) -> DataFrame:
    """The typed rows without a reason against them."""
    return checked.where(F.size("reasons") == 0).drop("raw", "reasons")


def rejected(checked: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the rejected values as they came, and the reasons, joined by ``"; "``."""
    return checked.where(F.size("reasons") > 0).select(*keep, "raw.*", F.array_join("reasons", "; ").alias("reasons"))
