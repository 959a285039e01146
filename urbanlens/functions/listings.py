"""Column functions for property listings (price, id, link, distance, rooms)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlens.functions._util import as_col
from urbanlens.functions.html import decode_entities, element_text  # noqa: F401  (part of this module's interface)

# --- fixed values -----------------------------------------------------------
VALID_PRICE_PATTERN = "^[£,0-9]+$"        # only pound sign, comma and digits
PRICE_STRIP_PATTERN = "[^0-9.]"           # what the number parser keeps
DISTANCE_SEPARATOR = " miles "
RAIL_ICON = "national_rail_station"
NONE_TEXT = "None"
# ----------------------------------------------------------------------------


def valid_price(price) -> Column:
    """Every character is ``£``, ``,`` or a digit (so ``POA``, ``£1.5`` fail).

    An empty price fails too (the original let it through and then crashed).
    """
    return F.coalesce(as_col(price).rlike(VALID_PRICE_PATTERN), F.lit(False))


def parse_price(price) -> Column:
    """keep digits and dots, read as a number; nothing left -> NULL."""
    digits = F.regexp_replace(as_col(price), PRICE_STRIP_PATTERN, "")
    return F.when(digits == F.lit(""), F.lit(None)).otherwise(digits).try_cast("double")


def parse_ad_id(href) -> Column:
    """the fourth ``/``-separated part of the link before ``?``."""
    path = F.split_part(as_col(href), F.lit("?"), F.lit(1))
    return F.split_part(path, F.lit("/"), F.lit(4))


def absolute_link(prefix: str, href) -> Column:
    """site prefix + href joined by exactly one slash."""
    h = F.regexp_replace(as_col(href), "^/+", "")
    return F.concat(F.lit(prefix.rstrip("/") + "/"), h)


def parse_distance(text) -> Column:
    """F16: ``"0.2 miles Oxford Circus"`` -> struct(distance=0.2, station="Oxford Circus").

    Split on ``" miles "``; parts 0 and 1 only. Without the separator the
    struct is NULL (P9 drops the row); a non-numeric part 0 gives a NULL
    distance.
    """
    parts = F.split(as_col(text), DISTANCE_SEPARATOR, -1)
    ok = F.size(parts) > 1
    return F.when(ok, F.struct(F.get(parts, 0).try_cast("double").alias("distance"),
                               F.get(parts, 1).alias("station")))


def positional_get(arr, i: int) -> Column:
    """element ``i`` (0-based) of an array, NULL when missing."""
    return F.get(as_col(arr), F.lit(i))


def none_to_null(c) -> Column:
    """The whole-cell text ``'None'`` becomes NULL."""
    return F.nullif(as_col(c), F.lit(NONE_TEXT))


def first_icon_not(icon, value: str = RAIL_ICON) -> Column:
    """Keep unless the first transport icon equals ``value``."""
    return F.coalesce(as_col(icon) != F.lit(value), F.lit(True))
