"""Listing extraction from stored result pages.

Pages are rows ``(page_no, html)``. Cards and their fields are elements with a class, nested elements of the same name
included (:mod:`urbanlens.functions.html`), so the whole job is built-in expressions plus one keyed aggregate for the keep-first dedup. A
page's HTML is read once: what is cut out, narrow rows with the page's pagination flag, is written to the scratch folder, and the
stop page and the listings both come from there. Class names of the source site are generated and change, so they are
arguments (:class:`CardShape`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions import html as H
from urbanlens.functions import listings as lf
from urbanlens.operators import ranking
from urbanlens.sources.scratch import stored

Element = tuple[str, str]


@dataclass(frozen=True)
class CardShape:
    """Where each field is: ``(element name, class)``; the icon is the value of an attribute."""
    card: Element = ("div", "listing-card")
    link: Element = ("a", "card-link")
    address: Element = ("p", "card-address")
    price: Element = ("p", "card-price")
    transport: Element = ("div", "card-transport")
    icon_attribute: str = "data-testid"
    transport_text: Element = ("p", "card-text")
    feature: Element = ("div", "card-feature")
    next_page: Element = ("a", "page-next")


DEFAULT_SHAPE = CardShape()


def has_next_link(html, shape: CardShape = DEFAULT_SHAPE) -> Column:
    """Whether a page holds the pagination link."""
    return F.coalesce(H.visible(html).rlike("(?i)" + H.opening_with(*shape.next_page)), F.lit(False))


def take_pages_while(pages: DataFrame, has_nav, page_col: str = "page_no",
                     max_pages: int | None = None) -> DataFrame:
    """P12 + P13: pages before the first page without a pagination link.

    The stop page is a scalar subquery (``min`` over the pages lacking the
    link), so pages are filtered in place: no window, no shuffle of pages.
    Later pages are dropped even if they have the link; with no stop page
    every page is kept. ``max_pages``, a caller's bound and off by default, keeps the
    pages numbered up to it, as pages are numbered from 1.
    """
    flag = has_nav if not isinstance(has_nav, str) else F.col(has_nav)
    src = pages
    if max_pages is not None:
        src = src.where(F.col(page_col) <= F.lit(max_pages))
    stop = src.where(~flag).agg(F.min(page_col).cast("long")).scalar()
    return src.where(F.col(page_col) < F.coalesce(stop, F.lit((1 << 63) - 1)))


def extract_cards(pages: DataFrame, shape: CardShape = DEFAULT_SHAPE, page_col: str = "page_no", html_col: str = "html",
                  keep: tuple[str, ...] = (), outer: bool = False) -> DataFrame:
    """one row per card ``(page_no, keep.., card_no, card)`` in page order; ``card`` is the element's contents.

    With ``outer`` a page without cards gives one row with null ``card_no`` and ``card``.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    rows = pages.select(page_col, *keep, H.visible(html_col).alias("_visible"))
    return rows.select(page_col, *keep, explode(H.elements("_visible", *shape.card)).alias("card_no", "card"))


def card_fields(cards: DataFrame, shape: CardShape = DEFAULT_SHAPE) -> DataFrame:
    """Raw text fields of each card (empty string when a field is missing), and whether it has a transport block."""
    kept = [x for x in cards.columns if x != "card"]
    link, with_icon = f"(?is)({H.opening_with(*shape.link)})", f"(?is)(<[a-z][^\\s/>]*+(?=[^>]*\\s{shape.icon_attribute}\\s*=)[^>]*>)"
    inner = {"_transport": shape.transport, "_address": shape.address, "_price": shape.price}
    cards = cards.select("*", *[H.first_element("card", *e).alias(n) for n, e in inner.items()], H.all_elements("card", *shape.feature).alias("_features"),
                         F.regexp_extract("card", link, 1).alias("_link"))
    cards = cards.select("*", H.first_element("_transport", *shape.transport_text).alias("_station"), F.regexp_extract("_transport", with_icon, 1).alias("_icon"))

    def text(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    return cards.select(
        *kept,
        text(H.attribute("_link", "href")).alias("href"),
        text(H.element_text("_address")).alias("address"),
        text(H.element_text("_price")).alias("price_text"),
        F.col("_transport").isNotNull().alias("has_transport"),
        text(H.attribute("_icon", shape.icon_attribute)).alias("first_icon"),
        text(H.element_text("_station")).alias("transport_text"),
        H.element_texts("_features").alias("features"),
    )


def listings_from_pages(pages: DataFrame, site_prefix: str = "https://listings.example/", shape: CardShape = DEFAULT_SHAPE,
                        page_col: str = "page_no", max_pages: int | None = None) -> DataFrame:
    """K4: the nine listing columns, in the original order of checks.

    pages -> cards' fields and the pagination flag, written once -> take-while pagination -> price and first-icon filters
    and missing link/transport dropped -> ad id -> keep first card per ad id (page, then position) -> distance parse and
    filter -> typed columns. Building the plan runs the job that reads the pages.
    """
    rows = pages if max_pages is None else pages.where(F.col(page_col) <= F.lit(max_pages))
    rows = rows.select(F.col(page_col).alias("page_no"), "html", has_next_link("html", shape).alias("has_nav"))
    cards = card_fields(extract_cards(rows, shape, keep=("has_nav",), outer=True), shape)
    ok = (F.col("card_no").isNotNull() & lf.valid_price("price_text") & lf.first_icon_not("first_icon") & (F.col("href") != F.lit("")) & F.col("has_transport"))
    # of a page without the link one row stays whatever its cards are: it is where the run may stop
    mark = ~F.col("has_nav") & (F.coalesce("card_no", F.lit(0)) == 0)
    cards = stored(cards.withColumn("ok", ok).where(F.col("ok") | mark), "cards")
    cards = take_pages_while(cards, "has_nav").where("ok").withColumn("ad_id", lf.parse_ad_id("href"))
    first = ranking.dedup_first(cards, "ad_id", ["page_no", "card_no"])
    dist = lf.parse_distance("transport_text")
    out = first.select(
        "ad_id",
        lf.absolute_link(site_prefix, "href").alias("link"),
        lf.parse_price("price_text").alias("price"),
        lf.none_to_null(lf.positional_get("features", 0)).try_cast("int").alias("bedrooms"),
        lf.none_to_null(lf.positional_get("features", 1)).try_cast("int").alias("bathrooms"),
        lf.none_to_null(lf.positional_get("features", 2)).try_cast("int").alias("living_rooms"),
        "address",
        dist.alias("_d"),
    )
    return (out.where(F.col("_d").isNotNull())
            .select("ad_id", "link", "price", "bedrooms", "bathrooms", "living_rooms", "address",
                    F.col("_d.distance").alias("distance"),
                    F.col("_d.station").alias("subway_station")))


def extract_links(pages: DataFrame, key: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(key, pos, href)`` for every ``<a>`` with an ``href`` in a page, in order."""
    return pages.select(key, F.posexplode(H.links(html_col)).alias("pos", "href"))


def folded(name) -> Column:
    """A station's name without edge blanks and in lower case, as J2 compares names."""
    return F.lower(F.trim(F.col(name) if isinstance(name, str) else name))


def _price_sums(near: DataFrame, places: int) -> list[Column]:
    # summed exactly, divided once: the mean does not depend on how partitions are summed
    total = F.sum(F.col("price").cast("decimal(20,4)")).cast("double")
    return [F.round(total / F.count("price"), places).alias("avg_price"), F.count(F.lit(1)).alias("n_listings")]


def avg_price_by_station(listings: DataFrame, km: float = 1.0, places: int = 4) -> DataFrame:
    """A3: mean price and count per station over listings closer than ``km``.

    Listing distances are in miles; "less than 1 km" is strict.
    """
    from urbanlens.functions.geo import miles_to_km
    near = listings.where(miles_to_km(F.col("distance")) < F.lit(km))
    return near.groupBy(F.col("subway_station").alias("station")).agg(*_price_sums(near, places))


def station_view(listings: DataFrame, scored: DataFrame, km: float = 1.0, score_col: str = "compound",
                 places: int = 4) -> DataFrame:
    """J2 + K6: per station ``(station, avg_price, n_listings, avg_sentiment, n_posts)``.

    Names are folded *before* both aggregates, so spellings of one station are one row on either side; the name shown is the smallest
    trimmed spelling among the listings. Then two station-sized tables are joined; stations without posts keep their prices.
    """
    from urbanlens.functions.geo import miles_to_km
    from urbanlens.operators.sentiment import avg_sentiment_by
    near = listings.where(miles_to_km(F.col("distance")) < F.lit(km))
    housing = near.groupBy(folded("subway_station").alias("_k")).agg(
        F.min(F.trim("subway_station")).alias("station"), *_price_sums(near, places))
    mood = avg_sentiment_by(scored.withColumn("_k", folded("station")), "_k", score_col, places)
    return housing.join(mood, "_k", "left").drop("_k")
