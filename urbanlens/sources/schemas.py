"""Explicit schemas for every declared input and result table."""

from __future__ import annotations

from pyspark.sql import types as T

POSTS = T.StructType([
    T.StructField("post_id", T.LongType()),
    T.StructField("tweets", T.StringType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("station", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

# The station file's header is Latitude,Longitude,Station,Zone (Zone dropped).
STATIONS_CSV = T.StructType([
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    T.StructField("Station", T.StringType()),
    T.StructField("Zone", T.DoubleType()),
])

PAGES = T.StructType([
    T.StructField("page_no", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

LISTINGS = T.StructType([
    T.StructField("ad_id", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("bedrooms", T.IntegerType()),
    T.StructField("bathrooms", T.IntegerType()),
    T.StructField("living_rooms", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("subway_station", T.StringType()),
])

SCORED_POSTS = T.StructType([
    T.StructField("date", T.TimestampType()),
    T.StructField("station", T.StringType()),
    T.StructField("tweets", T.StringType()),
    T.StructField("sentiment", T.DoubleType()),
])

TOPICS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("topics", T.StringType()),
])

LINEAGE = T.StructType([
    T.StructField("batch_nr", T.LongType()),
    T.StructField("job_nr", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("step_airflow", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("destination", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("valence", T.DoubleType()),
])
BOOSTERS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("increment", T.DoubleType()),
])
NEGATORS = T.StructType([T.StructField("token", T.StringType())])
STEMS = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("stem", T.StringType()),
])


def check_columns(df, schema: T.StructType, name: str) -> None:
    """Fail early when a declared input lacks a column or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"{name}: missing column {f.name!r}")
        if have[f.name] != f.dataType:
            raise ValueError(f"{name}: column {f.name!r} is {have[f.name].simpleString()},"
                             f" expected {f.dataType.simpleString()}")
