"""DataFrame operators over posts and documents (filters, counts, concat)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions._util import as_col


def filter_language(df: DataFrame, lang_col: str = "lang", lang: str = "en") -> DataFrame:
    """P5: keep rows of one language (pushed to the Parquet scan)."""
    return df.where(F.col(lang_col) == F.lit(lang))


def keyword_match(text, word: str):
    """Whole-word, case-insensitive match of ``word`` in ``text``.

    Words are runs of ``[a-z0-9]`` after lower-casing; no ``\\b`` (engines
    disagree on it next to accented letters).
    """
    w = word.lower()
    if not re.fullmatch("[a-z0-9]+", w):
        raise ValueError(f"a keyword is one word of letters and digits, not {word!r}")
    low = F.lower(as_col(text))
    # the cheap test first: most texts don't hold the letters at all
    return low.contains(w) & low.rlike(rf"(?:\A|[^a-z0-9]){w}(?:[^a-z0-9]|\z)")


def filter_keyword(df: DataFrame, text_col: str, word: str) -> DataFrame:
    """Keep rows whose text holds ``word`` as a whole word."""
    return df.where(keyword_match(text_col, word))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """P10: drop null and empty strings."""
    # a column that is computed would be pushed into the filter and computed there again; what a Generate gives is not
    once = df.select(*[F.explode_outer(F.array(c)).alias(c) if c == col else F.col(c) for c in df.columns])
    return once.where(F.col(col) != F.lit(""))


def word_count(df: DataFrame, tokens_col: str, word_col: str = "token",
               count_col: str = "cnt", by: list[str] | None = None) -> DataFrame:
    """A2: occurrences per word (optionally per group), empty words dropped.

    ``explode`` keeps rows in their partitions; the count is a hash aggregate
    with a map-side partial step, so a word that makes up a third of all
    tokens is collapsed before the shuffle.
    """
    keys = list(by or [])
    # explode_outer: a plain explode makes Catalyst add a size(tokens) > 0
    # filter below the projection, which evaluates the token expression twice
    exploded = df.select(*keys, F.explode_outer(F.col(tokens_col)).alias(word_col))
    return (exploded.where(F.col(word_col).isNotNull() & (F.col(word_col) != F.lit("")))
            .groupBy(*keys, word_col).agg(F.count(F.lit(1)).alias(count_col)))


def concat_by(df: DataFrame, key: str, text: str, order_col: str,
              chunk_rows: int = 1000, sep: str = " ",
              out_col: str = "text") -> DataFrame:
    """A1: text joined per key in ``order_col`` order, as bounded chunks.

    One string per key does not scale (a key may hold a third of all rows),
    so the concatenation is emitted as ``(key, chunk, n_rows, text)`` where
    ``chunk = floor(order_col / chunk_rows)``. ``order_col`` must be an
    integral, unique column, which bounds every chunk to ``chunk_rows`` rows.
    Joining the chunk texts of a key in chunk order with ``sep`` gives the
    whole concatenation. Null keys form their own group. Null texts add nothing,
    and a chunk of null texts alone stays, as an empty string with no rows.
    """
    chunk = F.floor(F.col(order_col) / F.lit(chunk_rows)).cast("long")
    pieces = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                  F.col(text).alias("t"))))
    return (df.groupBy(key, chunk.alias("chunk"))
            .agg(F.count(text).alias("n_rows"),
                 F.concat_ws(sep, F.transform(pieces, lambda p: p["t"])).alias(out_col)))


def concat_in_order(df: DataFrame, key: str, text: str, *order: Column, chunk_rows: int = 1000, sep: str = " ", out_col: str = "text") -> DataFrame:
    """A1 in any order: text joined per key, as chunks ``(key, chunk, n_rows, text)`` of ``chunk_rows`` consecutive rows.

    Rows are numbered by a range partition with prefix sums (:func:`urbanlens.operators.ordering.numbered`), so the order needs no unique
    integer column and a key that holds a third of all rows is in no task alone. Null keys form a group; null texts are rows
    that add nothing (``n_rows`` counts the others). Rows equal in ``order`` stand in an order that is not defined, so a full order gives defined
    chunks. Building the plan runs the job that numbers the rows.
    """
    from urbanlens.operators.ordering import numbered

    rows = numbered(df, [key], *order, name="_n")
    pieces = F.sort_array(F.collect_list(F.struct("_n", F.col(text).alias("t"))))
    return (rows.groupBy(key, F.floor((F.col("_n") - 1) / F.lit(chunk_rows)).cast("long").alias("chunk"))
            .agg(F.count(text).alias("n_rows"), F.concat_ws(sep, F.transform(pieces, lambda p: p["t"])).alias(out_col)))


def union_batches(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (no dedup, no shuffle)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
