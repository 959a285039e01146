"""Ranking operators: top-n per group, keep-first dedup, first n, latest snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[str | Column],
                    n: int, rank_col: str | None = "rn") -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (which must break ties).

    ``row_number() <= n`` lets Catalyst insert a map-side ``WindowGroupLimit``,
    so each input partition ships at most ``n`` rows per group to the shuffle:
    a group holding a third of all rows stays cheap.
    """
    keys = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= F.lit(n))
    if rank_col:
        return out.withColumnRenamed("_rn", rank_col)
    return out.drop("_rn")


def dedup_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """A5: one row per key, the first in ``order`` (first seen wins).

    ``row_number() = 1`` gets a map-side ``WindowGroupLimit``, so a key with millions of
    copies leaves each partition once. String keys are compared by their SHA-256:
    sorting and shuffling use 64 characters, not whole texts, and a text that the
    caller does not select is never shuffled. Null keys are one key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kinds = dict(df.dtypes)
    narrow = {f"_key{i}": F.sha2(F.col(c), 256) if kinds[c] == "string" else F.col(c) for i, c in enumerate(keys)}
    w = Window.partitionBy(*narrow).orderBy(*_order(order))
    kept = df.withColumns(narrow).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return kept.select(*keys, *[c for c in df.columns if c not in keys])


def first_n(df: DataFrame, n: int | None, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in an explicit order (``None`` keeps all)."""
    if n is None:
        return df
    return df.orderBy(*_order(order)).limit(n)


def latest_snapshot(df: DataFrame, version) -> DataFrame:
    """S11 for tables: rows of the newest version only.

    The newest version is a scalar subquery (one aggregate, no join, no
    shuffle of the rows), then a plain filter.
    """
    v = F.col(version) if isinstance(version, str) else version
    newest = df.select(v.alias("_v")).agg(F.max("_v")).scalar()
    return df.where(v == newest)
