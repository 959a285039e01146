"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round maps each vertex's neighbours onto its smallest neighbour. Minima are taken with map-side combine and joined back as
written tables, so AQE can split a hub that a third of all edges touch; the number of rounds grows with the logarithm of the
size. Nothing but two numbers per round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import discard, materialize


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """One star step on ``(u, v)`` with u > v; the result has the same form and one row per edge."""
    if large:
        pairs = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    else:
        pairs = edges
    pairs = materialize(pairs, "cc-pairs") if large else pairs
    least = materialize(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
    joined = pairs.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    new = materialize(out.filter("u <> v").distinct(), "cc-edges")
    discard(least)
    if large:
        discard(pairs)
    return new


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``(a, b)`` edges that is not its component's smallest; edges go either way."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    state = _state(now)
    while state[0]:
        for large in (True, False):
            new = _star(now, large=large)
            discard(now)
            now = new
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
