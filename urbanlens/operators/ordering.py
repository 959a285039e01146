"""Distributed row numbers.

``row_number`` over a window sends a whole group to one task, and over no group all rows. Here rows are range-partitioned by the wanted
order and sorted within their partitions; a row's place is its place in its partition plus the sizes of the partitions
before it, of which there are as many as partitions. Equal rows are told apart by where they were read, so that a third of all rows
being alike does not make one partition of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.sources.scratch import stored

#: ``monotonically_increasing_id``: the partition above these bits, the place in it below.
_BITS = 33


def placed(rows: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """``rows`` and each row's place, from 0, among all rows in the given order. Runs a job: the ranges must be the same for all readers."""
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read_at = rows.withColumn("_read_at", F.monotonically_increasing_id())
    ranged = read_at.repartitionByRange(shards, *order, F.col("_read_at")).sortWithinPartitions(*order, F.col("_read_at"))
    ranged = stored(ranged.drop("_read_at").withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", _BITS)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = sizes.select("_part", F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    return (ranged.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_at") - F.shiftleft(F.col("_part"), _BITS)).drop("_part", "_before", "_at"))


def numbered(rows: DataFrame, within: list[str], *order: Column, name: str = "n") -> DataFrame:
    """``rows`` and each row's number, from 1, within its group (null keys are groups) in the given order.

    A group's first place comes from a partial aggregate and is joined back; no group goes to one task, a hot one is split by
    the join. Which of fully equal rows comes first is not defined, and makes no difference.
    """
    table = placed(rows, *(F.col(c).asc_nulls_first() for c in within), *order, name="_place")
    first = table.groupBy(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(within))).agg(F.min("_place").alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(within)]
    return table.join(first, same).withColumn(name, F.col("_place") - F.col("_first") + 1).select(*rows.columns, name)
