"""Topic operators: stem the counted vocabulary, top-k words, topic string."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions.stem import stem_words
from urbanlens.operators import ranking

# --- fixed values -----------------------------------------------------------
# Words dropped from the weekly topic list after the top-5 cut.
DEFAULT_EXCLUDE = ("london",)
TOP_K = 5
# ----------------------------------------------------------------------------


def stem_join(counts: DataFrame, stems: DataFrame, word_col: str = "token",
              stem_col: str = "stem") -> DataFrame:
    """Attach a stem to each distinct word from a ``(token, stem)`` table.

    Words missing from the table keep themselves as stem. Spark broadcasts the
    stem table when its size in bytes allows, and shuffles both sides otherwise.
    """
    table = stems.select(F.col("token").alias("_st_token"), F.col("stem").alias("_st_stem"))
    joined = counts.join(table, counts[word_col] == table["_st_token"], "left")
    return (joined.withColumn(stem_col, F.coalesce(F.col("_st_stem"), F.col(word_col)))
            .drop("_st_token", "_st_stem"))


def stem_vocabulary(counts: DataFrame, word_col: str = "token", stem_col: str = "stem",
                    stems: DataFrame | None = None) -> DataFrame:
    """stem of each distinct counted word.

    Either joins a ready ``(token, stem)`` table (J4) or applies the Porter2
    expressions. ``counts`` is already one row per word, so each distinct
    word is stemmed once, however often it occurs.
    """
    if stems is not None:
        return stem_join(counts, stems, word_col, stem_col)
    return stem_words(counts, word_col, stem_col)


def counts_by_stem(counts: DataFrame, word_col: str = "token", count_col: str = "cnt",
                   stems: DataFrame | None = None, out_col: str = "token", by: str | None = None) -> DataFrame:
    """Re-count by stem: ``count(stem) = sum(count(token))`` over its words (per ``by`` if given)."""
    stemmed = stem_vocabulary(counts, word_col, "_stem", stems)
    return (stemmed.groupBy(*([by] if by else []), F.col("_stem").alias(out_col))
            .agg(F.sum(count_col).alias(count_col)))


def topics_per_group(counts: DataFrame, by: str, k: int = TOP_K, exclude=DEFAULT_EXCLUDE, word_col: str = "token",
                     count_col: str = "cnt", sep: str = ", ", out_col: str = "topics") -> DataFrame:
    """T1 + P11 + A7 for every group: ``(by, topics)``; excluded words go after the cut.

    ``row_number() <= k`` gets a map-side ``WindowGroupLimit``; at most ``k`` rows of a group are gathered. A group
    all of whose words are excluded keeps an empty string.
    """
    top = ranking.top_n_per_group(counts, by, [F.desc(count_col), F.asc(word_col)], k)
    word = F.when(~F.col(word_col).isin(list(exclude or ())), F.col(word_col))
    ranked = F.sort_array(F.collect_list(F.struct(F.col("rn"), word.alias("w"))))
    return top.groupBy(by).agg(F.concat_ws(sep, F.transform(ranked, lambda x: x["w"])).alias(out_col))


def top_topics(counts: DataFrame, k: int = TOP_K, exclude=DEFAULT_EXCLUDE,
               exclude_when: str = "after", word_col: str = "token",
               count_col: str = "cnt") -> DataFrame:
    """T1 + P11: the ``k`` most frequent words, ties broken by word.

    With ``exclude_when="after"`` (the original behaviour) excluded words are
    removed after the cut, so fewer than ``k`` may remain; ``"before"``
    removes them first. Planned as ``TakeOrderedAndProject`` (no full sort).
    """
    excl = list(exclude or ())
    src = counts
    if excl and exclude_when == "before":
        src = src.where(~F.col(word_col).isin(excl))
    top = src.orderBy(F.desc(count_col), F.asc(word_col)).limit(k)
    if excl and exclude_when == "after":
        top = top.where(~F.col(word_col).isin(excl))
    return top


def topics_string(top: DataFrame, word_col: str = "token", count_col: str = "cnt",
                  sep: str = ", ", reference_format: bool = False,
                  out_col: str = "topics") -> DataFrame:
    """One row, the words joined by ``sep`` in descending count order.

    ``reference_format=True`` keeps the original trailing separator.
    ``top`` is bounded (k rows), so gathering it into one array is safe.
    """
    ordered = F.sort_array(F.collect_list(F.struct((-F.col(count_col)).alias("k"),
                                                   F.col(word_col).alias("w"))))
    joined = F.concat_ws(sep, F.transform(ordered, lambda x: x["w"]))
    if reference_format:
        joined = F.when(F.size(ordered) > 0, F.concat(joined, F.lit(sep))).otherwise(F.lit(""))
    return top.agg(joined.alias(out_col))


def run_date(now: dt.datetime | dt.date) -> dt.date:
    """the day of the run."""
    return now.date() if isinstance(now, dt.datetime) else now


def topics_row(top: DataFrame, now: dt.datetime | dt.date, **kwargs) -> DataFrame:
    """F10 + A7: ``(date, topics)`` with the run date passed in, never read."""
    return topics_string(top, **kwargs).select(F.lit(run_date(now)).alias("date"), "topics")
