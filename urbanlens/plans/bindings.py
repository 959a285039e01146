"""Bindings from the driver's tables to the pipeline's inputs.

The driver tables (``documents``, ``customer``, ``supplier``, ``part``,
``pages``, ``events`` ...) stand in for collected posts, stations and result
pages. Every binding is a Spark projection of those tables, so the work of
each query grows with them. The DuckDB oracles use the same formulas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
POSTS_EPOCH_SECONDS = 1704067200          # 2024-01-01 00:00:00 UTC
LAT_BASE, LAT_MUL, LAT_MOD = 51.40, 7919, 30000
LON_BASE, LON_MUL, LON_MOD = -0.61, 104729, 86000
COORD_SCALE = 100000.0
# ----------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def synthetic_lat(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.lit(LAT_BASE) + (k * F.lit(LAT_MUL) % F.lit(LAT_MOD)) / F.lit(COORD_SCALE)


def synthetic_lon(key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.lit(LON_BASE) + (k * F.lit(LON_MUL) % F.lit(LON_MOD)) / F.lit(COORD_SCALE)


def posts_from_documents(documents: DataFrame) -> DataFrame:
    """documents -> posts ``(post_id, tweets, date, station, lang, lat, lon)``."""
    return documents.select(
        F.col("doc_id").alias("post_id"),
        F.col("text").alias("tweets"),
        F.timestamp_seconds(F.lit(POSTS_EPOCH_SECONDS) + F.col("doc_id") * F.lit(3600)).alias("date"),
        F.col("source").alias("station"),
        F.col("lang"),
        synthetic_lat("doc_id").alias("lat"),
        synthetic_lon("doc_id").alias("lon"),
    )


def stations_from_supplier(supplier: DataFrame) -> DataFrame:
    """supplier -> station centers ``(Station, Latitude, Longitude)``."""
    return supplier.select(
        F.col("s_name").alias("Station"),
        synthetic_lat("s_suppkey").alias("Latitude"),
        synthetic_lon("s_suppkey").alias("Longitude"),
    )


def points_from_customer(customer: DataFrame) -> DataFrame:
    """customer -> points ``(point_id, lat, lon)``."""
    return customer.select(
        F.col("c_custkey").alias("point_id"),
        synthetic_lat("c_custkey").alias("lat"),
        synthetic_lon("c_custkey").alias("lon"),
    )


def global_places(rows: DataFrame, key: str) -> DataFrame:
    """Any table with a key -> places ``(place_id, lat, lon)`` over the whole globe, a third of them at one place beside the pole."""
    k = F.col(key)
    return rows.select(k.alias("place_id"),
                       F.when(k % 3 == 0, F.lit(89.5)).otherwise((k * 7919 % 18001 - 9000) / F.lit(100.0)).alias("lat"),
                       F.when(k % 3 == 0, F.lit(179.9)).otherwise((k * 104729 % 36001 - 18000) / F.lit(100.0)).alias("lon"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_documents(table(spark, sf_dir, "documents"))


def scored_text_from_documents(documents: DataFrame) -> DataFrame:
    """documents -> scored posts as a load reads them, dates and scores as text, some of them unreadable."""
    k = F.col("doc_id")
    date = F.when(k % 19 == 0, F.lit("yesterday")).otherwise(
        F.date_format(F.timestamp_seconds(F.lit(POSTS_EPOCH_SECONDS) + k * F.lit(3600)), "yyyy-MM-dd HH:mm:ss"))
    score = F.when(k % 13 == 0, F.lit("n/a")).when(k % 17 == 0, F.lit("1234.5")).otherwise(F.format_string("%.2f", (k % 201 - 100) / F.lit(100.0)))
    return documents.select(k.alias("post_id"), F.col("text").alias("tweets"), date.alias("date"), F.col("source").alias("station"), score.alias("sentiment"))


# --- listing bindings (from ``part``) ---------------------------------------
# fixed values of the synthetic listing cards
CARDS_PER_PAGE = 25
RAIL_EVERY, NO_TRANSPORT_EVERY = 5, 23
POA_EVERY, PCM_EVERY, BAD_DISTANCE_EVERY, NONE_EVERY = 11, 13, 17, 7
SOURCES = 20


def ad_number(k) -> Column:
    """Ad number of a part: one in ten consecutive parts repeats an ad."""
    return k - F.floor(k / F.lit(10)).cast("long")


def price_text(k, retail) -> Column:
    grouped = F.format_number(F.floor(retail * F.lit(100)).cast("long"), 0)
    return (F.when(k % POA_EVERY == 0, F.lit("POA"))
            .when(k % PCM_EVERY == 0, F.lit("£1,200 pcm"))
            .otherwise(F.concat(F.lit("£"), grouped)))


def distance_text(k, size) -> Column:
    return F.when(k % BAD_DISTANCE_EVERY == 0, F.lit("Oxford")).otherwise(
        F.concat((size / 10).cast("int").cast("string"), F.lit("."), (size % 10).cast("string"),
                 F.lit(" miles src"), (k % SOURCES).cast("string")))


def raw_listings_from_part(part: DataFrame) -> DataFrame:
    """part -> raw listing text fields ``(p_partkey, href, price_text, distance_text, rooms_text)``."""
    k, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        "p_partkey",
        F.concat(F.lit("/for-sale/details/"), ad_number(k).cast("string"), F.lit("/?x=1")).alias("href"),
        price_text(k, F.col("p_retailprice")).alias("price_text"),
        distance_text(k, size).alias("distance_text"),
        F.when(k % NONE_EVERY == 0, F.lit("None")).otherwise((size % 5 + 1).cast("string")).alias("rooms_text"),
    )


def card_html(k, name, price, icon, dist, size) -> Column:
    n_feat = k % 4
    feats = F.concat(
        F.when(n_feat >= 1, F.concat(F.lit('<div class="card-feature">'), (size % 5 + 1).cast("string"), F.lit("</div>"))).otherwise(F.lit("")),
        F.when(n_feat >= 2, F.concat(F.lit('<div class="card-feature">'), (size % 3 + 1).cast("string"), F.lit("</div>"))).otherwise(F.lit("")),
        F.when(n_feat >= 3, F.concat(F.lit('<div class="card-feature">'), (size % 2 + 1).cast("string"), F.lit("</div>"))).otherwise(F.lit("")),
    )
    transport = F.when(k % NO_TRANSPORT_EVERY == 0, F.lit("")).otherwise(F.concat(
        F.lit('<div class="card-transport"><span data-testid="'), icon, F.lit('"></span><p class="card-text">'),
        dist, F.lit('</p><span data-testid="london_underground"></span></div>')))
    return F.concat(
        F.lit('<div class="listing-card"><a class="card-link" href="/for-sale/details/'),
        ad_number(k).cast("string"), F.lit('/?x=1">view</a><p class="card-address">'), name,
        F.lit('</p><p class="card-price">'), price, F.lit("</p>"), transport,
        F.lit('<div class="card-features">'), feats, F.lit("</div></div>"))


def nested_card_html(k, name, price, icon, dist, size) -> Column:
    """A card as pages write them: wrappers of the same element name, comments, either quote or none, references, a script."""
    quote = F.when(k % 2 == 0, F.lit("'")).otherwise(F.lit('"'))
    feature = lambda n: F.concat(F.lit("<div class="), quote, F.lit("x card-feature"), quote, F.lit("><div class=icon><div></div></div>"), n.cast("string"), F.lit("</div>"))
    feats = F.concat(*[F.when(k % 4 >= i + 1, feature(size % m + 1)).otherwise(F.lit("")) for i, m in enumerate((5, 3, 2))])
    transport = F.when(k % NO_TRANSPORT_EVERY == 0, F.lit('<!-- <div class="card-transport"><p class="card-text">9 miles none</p></div> -->')).otherwise(F.concat(
        F.lit('<DIV data-n="a>b" class='), quote, F.lit("card-transport wide"), quote, F.lit("><div><div class=pad></div></div><span data-testid="), quote, icon, quote,
        F.lit("></span><div><p class=card-text>"), dist, F.lit("</p></div><span data-testid=london_underground></span></DIV>")))
    return F.concat(
        F.lit("<div\nid=c"), k.cast("string"), F.lit(" class="), quote, F.lit("listing-card"), quote, F.lit("><div><a href="), quote, F.lit("/for-sale/details/"),
        ad_number(k).cast("string"), F.lit("/?x=1&amp;y=2"), quote, F.lit(" class=card-link>view</a></div><script>var s = '</div>';</script><p class="), quote, F.lit("card-address"), quote,
        F.lit("><b>"), name, F.lit("</b> &eacute;&#33;</p><div class=box><p class=card-price>"), F.replace(price, F.lit("£"), F.lit("&pound;")), F.lit("</p></div>"), transport,
        F.lit("<div class=card-features>"), feats, F.lit("</div></div>"))


def card_pages_from_part(part: DataFrame, card=card_html) -> DataFrame:
    """part -> result pages ``(page_no, url, html)``, 25 cards per page.

    The page at three quarters of the page range and the last page lack the
    pagination link, so the take-while stop falls inside the data at every
    scale. Grouping is per page (at most 25 cards), never wider.
    """
    k = F.col("p_partkey")
    icon = F.when(k % RAIL_EVERY == 0, F.lit("national_rail_station")).otherwise(F.lit("london_underground"))
    cards = part.select(
        (k / F.lit(CARDS_PER_PAGE)).cast("long").alias("page_no"), k.alias("k"),
        card(k, F.col("p_name"), price_text(k, F.col("p_retailprice")), icon,
                  distance_text(k, F.col("p_size")), F.col("p_size")).alias("card"))
    # pages are to come from as many tasks as a table of files would; they are small, and Spark would gather them in one
    shards = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = cards.repartition(shards, "page_no").groupBy("page_no").agg(
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("k", "card"))),
                                    lambda x: x["card"])).alias("body"))
    last = part.agg(F.max((k / F.lit(CARDS_PER_PAGE)).cast("long"))).scalar()
    stop = F.floor((last + F.lit(1)) * F.lit(3) / F.lit(4)).cast("long")
    nav = F.when((F.col("page_no") == stop) | (F.col("page_no") == last), F.lit("")).otherwise(
        F.lit('<a class="page-next" href="?pn=next">next</a>'))
    return pages.select(
        F.col("page_no").cast("int").alias("page_no"),
        F.concat(F.lit("https://listings.example/for-sale?pn="), F.col("page_no").cast("string")).alias("url"),
        F.concat(F.lit("<html><body><main>"), F.col("body"), F.lit("</main><nav>"), nav,
                 F.lit("</nav></body></html>")).alias("html"))
