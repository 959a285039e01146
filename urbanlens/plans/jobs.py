"""Composed jobs K1-K6: the pipeline's steps as DataFrame plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import text as tf
from urbanlens.operators import text as tops
from urbanlens.operators import topics as top_ops


def topic_tokens(posts: DataFrame, text_col: str = "tweets", out_col: str = "tokens",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean, lower, collapse, tokenize, drop stop words."""
    # tokens are lower case already, so the stop list is matched as is
    tokens = tf.remove_stop_words(tf.tokenize(tf.topic_text(text_col)),
                                  tuple(w.lower() for w in tf.ENGLISH_STOP_WORDS),
                                  case_sensitive=True)
    return posts.select(*keep, tokens.alias(out_col))


def word_counts(posts: DataFrame, text_col: str = "tweets", by: list[str] | None = None) -> DataFrame:
    """A2 over the topic tokens: ``(token, cnt)``."""
    toks = topic_tokens(posts, text_col, keep=tuple(by or ()))
    return tops.word_count(toks, "tokens", by=by)


def topic_job(posts: DataFrame, now: dt.datetime | dt.date, text_col: str = "tweets",
              stems: DataFrame | None = None, k: int = top_ops.TOP_K,
              exclude=top_ops.DEFAULT_EXCLUDE, exclude_when: str = "after",
              reference_format: bool = False) -> DataFrame:
    """K2: one row ``(date, topics)``: the k most frequent stemmed words.

    Plan: scan -> expressions -> explode -> partial count -> shuffle on word
    -> stem the distinct counted words -> small shuffle on stem ->
    TakeOrderedAndProject -> one-row string aggregate. Counting words before
    stemming is exact: count(stem) = sum of the counts of its words.
    """
    counts = word_counts(posts, text_col)
    by_stem = top_ops.counts_by_stem(counts, stems=stems)
    top = top_ops.top_topics(by_stem, k=k, exclude=exclude, exclude_when=exclude_when)
    return top_ops.topics_row(top, now, reference_format=reference_format)


def topic_job_by(posts: DataFrame, now: dt.datetime | dt.date, by: str = "station", text_col: str = "tweets",
                 stems: DataFrame | None = None, k: int = top_ops.TOP_K, exclude=top_ops.DEFAULT_EXCLUDE) -> DataFrame:
    """K2 for every station: ``(date, <by>, topics)``, the ``k`` most frequent stems of its posts."""
    counts = top_ops.counts_by_stem(word_counts(posts, text_col, by=[by]), stems=stems, by=by)
    return top_ops.topics_per_group(counts, by, k, exclude).select(F.lit(top_ops.run_date(now)).alias("date"), by, "topics")


def sentiment_job(posts: DataFrame, lexicon: DataFrame, key: str = "post_id",
                  text_col: str = "tweets", boosters=None, negators=None, idioms=None,
                  places: int = 2) -> DataFrame:
    """K1: ``(post_id, date, station, tweets, sentiment)`` with cleaned text.

    Scores are computed from ``(post, position, word)`` rows that carry only
    the small columns; the cleaned text rides on one row of each post, so posts are read
    and cleaned once. ``places`` is the rounding of the reported score (2 in the original job).
    """
    from urbanlens.operators import sentiment as S

    cleaned = posts.select(key, "date", "station", tf.clean_text(text_col).alias("tweets"))
    scored = S.sentiment_score(
        cleaned, key, "tweets", lexicon,
        boosters=S.BOOSTERS if boosters is None else boosters,
        negators=S.NEGATORS if negators is None else negators,
        idioms=S.SPECIAL_CASES if idioms is None else idioms,
        carry=("date", "station"), places=4, display_places=None, keep_text=True)
    shown = S.two_places("compound") if places == 2 else F.round("compound", places)
    return scored.select(key, "date", "station", "tweets", shown.alias("sentiment"))


def collect_posts(posts: DataFrame, stations: DataFrame, km: float = 1.0,
                  keyword: str | None = "london", lang: str | None = "en",
                  per_station: int = 10, max_stations: int | None = None,
                  station_order: str = "Station") -> DataFrame:
    """K3: the newest ``per_station`` posts within ``km`` of each station.

    Re-aims the remote geo search: stored posts are filtered by language and
    keyword (pushed to the scan), radius-joined to the stations and cut per station
    with ``row_number``; they meet the newest posts of each cell first, so not all pairs are
    made (:func:`urbanlens.operators.geo.first_n_within`). A post near two
    stations appears once per station, as in the original per-station loop.
    """
    from urbanlens.operators import geo, ranking

    centers = ranking.first_n(stations, max_stations, [station_order])
    src = posts
    if lang is not None:
        src = tops.filter_language(src, "lang", lang)
    if keyword is not None:
        src = tops.filter_keyword(src, "tweets", keyword)
    top = geo.first_n_within(src.select("post_id", "date", "lat", "lon"), centers.select("Station", "Latitude", "Longitude"),
                             "Station", [F.desc("date"), F.asc("post_id")], per_station, km=km)
    # texts join the few that are left; ``post_id`` identifies a post
    return top.join(src.select("post_id", "tweets"), "post_id").select("post_id", "tweets", "date", F.col("Station").alias("station"))


def station_view(listings: DataFrame, scored: DataFrame, km: float = 1.0) -> DataFrame:
    """K6: housing prices within ``km`` of each station beside the mood of its posts."""
    from urbanlens.operators import listings as L

    return L.station_view(listings, scored, km)


def load_results(spark, sentiment_path: str, topics_path: str, db: str, now: dt.datetime, listings_path: str | None = None,
                 bad_rows: str = "stop") -> None:
    """K5: load the newest sentiment and topic batches (and listings) as one batch of the result tables, marked by a lineage row.

    The batch is the day of ``now``: loading it again, after a failure or not, leaves each row once. Rows whose date or score can't
    be read stop the load before anything is written, or, with ``bad_rows="set_aside"``, go to the table ``rejected`` with the reasons.
    """
    from urbanlens.sources import io, loads

    io.ensure_tables(spark, db)
    scored, frames = io.read_latest(spark, sentiment_path), {}
    if bad_rows == "set_aside":
        checked = loads.checked_on_load(scored, {"date": "timestamp", "sentiment": "decimal(5,2)"})
        frames["sentiment"] = loads.accepted(checked)
        bad = loads.rejected(checked, "tweets", "station")
        frames["rejected"] = bad.select(F.lit(sentiment_path).alias("origin"), F.to_json(F.struct("tweets", "date", "station", "sentiment")).alias("row"), "reasons")
    else:
        frames["sentiment"] = io.cast_on_load(scored, strict=True)
    frames["topics"] = io.read_latest(spark, topics_path)
    sources = [sentiment_path, topics_path]
    if listings_path:
        frames["listings"] = io.read_listings(spark, listings_path)
        sources.append(listings_path)
    targets = ", ".join(f"{db}.{name}" for name in frames)
    mark = io.lineage_row(spark, io.JOB_LOAD, io.STEP_LOAD, ", ".join(sources), f"db: {targets}", now)
    loads.load_batch(spark, db, int(now.strftime("%Y%m%d")), frames, mark)
