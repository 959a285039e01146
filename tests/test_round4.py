"""Work that grows with the input: what is shuffled, computed once, or never made."""

import math
import random

import pytest
from pyspark.sql import functions as F

from urbanlens.functions import text as tf
from urbanlens.functions._util import rounded
from urbanlens.functions.geo import haversine_km
from urbanlens.operators import geo, ranking
from urbanlens.operators import sentiment as S
from urbanlens.operators import text as tops
from urbanlens.plans import queries as Q


def plan(df, optimized=False):
    query = df._jdf.queryExecution()
    return (query.optimizedPlan() if optimized else query.executedPlan()).toString()


@pytest.mark.parametrize("as_table", [False, True])
def test_words_meet_a_small_lexicon_without_a_shuffle(spark, as_table):
    """One exchange, of the sums by post: words are not shuffled for a lexicon or for idioms of unknown size."""
    posts = spark.createDataFrame([(1, "not so GOOD day"), (2, "the bad ass good"), (3, None), (4, "")], "id long, t string")
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    idioms = spark.createDataFrame(list(S.SPECIAL_CASES.items()), "phrase string, valence double") if as_table else S.SPECIAL_CASES
    out = S.sentiment_score(posts, "id", "t", lexicon, idioms=idioms)
    assert "SortMergeJoin" not in plan(out) and plan(out).count("Exchange hashpartitioning(id") == 1
    plain = S.sentiment_score(posts, "id", "t", lexicon)
    assert sorted(out.collect()) == sorted(plain.collect())


def test_upper_case_is_seen_from_the_whole_text(spark):
    words = ["A", "a", "1", "1A", "aB", "AB", "É", "é", "ß", "中", "A1", "!A!", "", "\tB", "_", "Ǆ", "ǅ"]
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 4))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    upper = F.exists(tf.split_words("t"), S.is_upper)
    assert df.where(upper & ~F.col("t").rlike(S.MAYBE_UPPER)).count() == 0
    assert df.where(F.col("t").rlike(S.MAYBE_UPPER)).count() < len(texts)


def test_shorter_cleaning_patterns_agree(spark):
    parts = ["@", "@@", "@bob", "a", "Z9", " ", "\t", "\n", "_", "!", "http://x.y/z", "://", "é", "中", "😀", "\x00", "\x7f", "/", ":", "[", "`", "{", "~"]
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(tf.clean_text("t") != F.regexp_replace("t", tf.CLEAN_PATTERN, "")).count() == 0
    assert df.where(tf.collapse_spaces("t") != F.regexp_replace("t", " +", " ")).count() == 0


def test_non_empty_computes_its_column_once(spark):
    df = spark.createDataFrame([(1, "@a"), (2, "b  c"), (3, None), (4, "")], "id long, x string")
    out = tops.non_empty(df.select("id", tf.topic_text("x").alias("t")), "t")
    assert out.columns == ["id", "t"]
    assert plan(out.select("id", F.length("t")), optimized=True).count("lower(") == 1
    assert [(r.id, r.t) for r in out.collect()] == [(2, "b c")]


def test_a_crowded_place_is_cut_into_blocks(spark, monkeypatch):
    """A third of both sides at one place: no piece of a cube holds all of its pairs."""
    monkeypatch.setattr(geo, "BLOCK", 16)
    at = lambda i: (51.5, -0.1) if i % 3 == 0 else (51.4 + i % 97 / 500, -0.5 + i % 89 / 200)
    p = spark.createDataFrame([(i, *at(i)) for i in range(600)], "pid long, lat double, lon double")
    c = spark.createDataFrame([(f"s{i}", *at(i)) for i in range(150)], "Station string, Latitude double, Longitude double")
    out = geo.radius_join(p, c, km=2.0)
    brute = p.crossJoin(c).where(geo.haversine_km("lat", "lon", "Latitude", "Longitude") <= 2.0)
    rows = sorted((r.pid, r.Station) for r in out.collect())
    assert rows == sorted((r.pid, r.Station) for r in brute.collect())
    cubes = [geo.in_cubes(rows, lat, lon, geo.cube_side(2.0), ("x", "y", "z")) for rows, lat, lon in ((p, "lat", "lon"), (c, "Latitude", "Longitude"))]
    pieces, centers = geo._blocks(*cubes)
    key = [*geo.CUBE, "_i", "_j"]
    assert pieces.groupBy(key).count().agg(F.max("count")).first()[0] < 60  # of 200 at one place
    assert pieces.select("pid", "_i").distinct().count() == p.count()
    assert centers.groupBy(key).count().agg(F.max("count")).first()[0] < 40


@pytest.mark.parametrize("depth", [1, 2, None])
def test_first_n_within_is_the_whole_join_cut(spark, depth):
    rnd = random.Random(11)
    posts = [(i, None if i % 40 == 0 else rnd.randint(0, 50), 51.4 + rnd.random() * 0.2, -0.3 + rnd.random() * 0.3 * (i % 2)) for i in range(900)] + [(900, 99, None, 0.0)]
    # two places of one name, a name that is null, and one that has nothing near
    centers = [(f"s{i % 20}", 51.4 + rnd.random() * 0.2, -0.3 + rnd.random() * 0.3) for i in range(25)] + [(None, 51.5, -0.3), ("far", 10.0, 10.0)]
    p = spark.createDataFrame(posts, "post_id long, date int, lat double, lon double")
    c = spark.createDataFrame(centers, "Station string, Latitude double, Longitude double")
    order = [F.desc("date"), F.asc("post_id")]
    got = geo.first_n_within(p, c, "Station", order, 7, km=3.0, depth=depth)
    want = ranking.top_n_per_group(geo.radius_join(p, c, km=3.0), "Station", order, 7, rank_col=None)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_first_n_within_makes_few_pairs(spark, monkeypatch):
    """Ten posts of each station are wanted of thousands near it."""
    p = spark.range(4000).select(F.col("id").alias("post_id"), F.col("id").alias("date"), (F.lit(51.5) + F.col("id") % 61 / 1e4).alias("lat"), (F.lit(0.1) + F.col("id") % 67 / 1e4).alias("lon"))
    c = spark.range(20).select(F.concat(F.lit("s"), "id").alias("Station"), (F.lit(51.5) + F.col("id") / 1e4).alias("Latitude"), F.lit(0.1).alias("Longitude"))
    made = []
    near = geo._near

    def counted(*args, **options):
        out = near(*args, **options)
        made.append(out.count())
        return out
    monkeypatch.setattr(geo, "_near", counted)
    assert geo.first_n_within(p, c, "Station", [F.desc("date")], 10, km=5.0).count() == 200
    assert sum(made) < 20 * 4000 / 5


def test_cast_on_load_is_the_scored_text(spark):
    out = Q.registry()["cast_on_load"](spark, "/root/testdata/sf0.001")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [
        ("tweets", "string"), ("date", "timestamp"), ("station", "string"), ("sentiment", "decimal(10,4)")]


@pytest.mark.parametrize("address", ["ann (at) site (dot) org", "ann[at]site.org", "ann at site dot org", "ann at site[.]org"])
def test_windows_with_an_address_written_out_are_looked_at(address):
    from urbanlens.llm import pii
    assert pii.plausible(0, address)
    for before in (0, 60, 100, 130, 500):
        text = "x" * before + " " + address + " " + "y" * 300
        at = text.index(address)
        assert any(s <= at and at + len(address) <= s + pii.WINDOW for s in pii.window_starts(text))
    assert not list(pii.window_starts("we met at noon and went home " * 20))


def test_rounded_is_round(spark):
    """Ties, numbers beside them, either sign, small and large, NaN and infinity."""
    rnd = random.Random(8)
    some = [rnd.uniform(-10 ** k, 10 ** k) for k in range(-8, 12) for _ in range(200)]
    ties = [(n + 0.5) / 10 ** k for k in (4, 6) for n in (-3, -1, 0, 1, 2, 7, 12345, 10 ** 9, *[rnd.randrange(-10 ** 9, 10 ** 9) for _ in range(300)])]
    beside = [math.nextafter(t, to) for t in ties for to in (-math.inf, math.inf)]
    odd = [0.0, -0.0, 1e-300, -1e-9, 1e300, -1e300, 2.0 ** 53, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(x,) for x in some + ties + beside + odd], "x double")
    for places in (0, 4, 6):
        other = df.where(~rounded(F.col("x"), places).eqNullSafe(F.round("x", places)))
        assert other.collect() == []


def test_pairs_compute_no_angles_of_one_place(spark, tmp_path):
    """What a distance needs of a place alone is not computed again for each pair, nor is a pair's distance made a decimal text; distances are those of the formula."""
    rnd = random.Random(9)
    place = lambda i: (i, rnd.choice([89.5, rnd.uniform(-90, 90)]), rnd.choice([179.9, rnd.uniform(-180, 180)]))
    p = spark.createDataFrame([place(i) for i in range(400)], "pid long, lat double, lon double")
    c = spark.createDataFrame([place(i) for i in range(200)], "cid long, Latitude double, Longitude double")
    out = geo.radius_join(p, c, km=500.0)
    above = plan(out).split("SortMergeJoin")[0]
    assert "SIN" in above and "COS(" not in above and "RADIANS" not in above
    brute = p.crossJoin(c).withColumn("distance_km", haversine_km("lat", "lon", "Latitude", "Longitude")).where("distance_km <= 500")
    assert sorted(out.collect()) == sorted(brute.collect()) and out.count() > 1000
    for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        spark.range(30).withColumnRenamed("id", key).write.parquet(str(tmp_path / f"{table}.parquet"))
    above = plan(Q.q_radius_join_global(spark, str(tmp_path))).split("SortMergeJoin")[0]
    assert "CASE WHEN" in above and "RADIANS" not in above
