import random

import pytest
from pyspark.sql import functions as F

from urbanlens.functions.geo import haversine_km
from urbanlens.operators import geo, ranking


def brute(spark, pts, ctr, km):
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    c = spark.createDataFrame(ctr, "Station string, Latitude double, Longitude double")
    d = haversine_km("lat", "lon", "Latitude", "Longitude")
    return {(r.pid, r.Station) for r in p.crossJoin(c).where(d <= km).collect()}


@pytest.mark.parametrize("km", [0.3, 1.0, 4.0])
def test_radius_join_equals_brute_force(spark, km):
    rnd = random.Random(7)
    pts = [(i, 51.4 + rnd.random() * 0.3, -0.6 + rnd.random() * 0.8) for i in range(3000)]
    ctr = [(f"s{i}", 51.4 + rnd.random() * 0.3, -0.6 + rnd.random() * 0.8) for i in range(60)]
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    c = spark.createDataFrame(ctr, "Station string, Latitude double, Longitude double")
    out = geo.radius_join(p, c, km=km)
    got = {(r.pid, r.Station) for r in out.collect()}
    assert got == brute(spark, pts, ctr, km)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_radius_edges(spark):
    # same point; just inside / outside 1 km north (1 km = 0.0089932 deg on R=6371.0088)
    ctr = [("a", 51.5, -0.1)]
    pts = [(1, 51.5, -0.1), (2, 51.5 + 0.0089930, -0.1), (3, 51.5 + 0.0089935, -0.1)]
    p = spark.createDataFrame(pts, "pid long, lat double, lon double")
    c = spark.createDataFrame(ctr, "Station string, Latitude double, Longitude double")
    got = {r.pid for r in geo.radius_join(p, c, km=1.0).collect()}
    assert got == {1, 2}


def test_radius_at_a_pole(spark):
    c = spark.createDataFrame([("p", 89.999, 0.0)], "Station string, Latitude double, Longitude double")
    p = spark.createDataFrame([(1, 89.999, 0.0), (2, 89.999, 180.0), (3, 89.9, 0.0)], "pid long, lat double, lon double")
    assert sorted(r.pid for r in geo.radius_join(p, c, km=1.0).collect()) == [1, 2]
    with pytest.raises(ValueError):
        geo.radius_join(p, c, km=0.0)


def test_dedup_first_one_per_key(spark):
    rows = [(i, f"t{i % 7}", i * 3 % 11) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, text string, v long")
    out = ranking.dedup_first(df, "text", ["id"]).collect()
    assert len(out) == 7
    assert {(r.text, r.id) for r in out} == {(f"t{k}", k) for k in range(7)}


def test_top_n_plan_has_group_limit(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    out = ranking.top_n_per_group(df, "g", [F.desc("id")], 2)
    assert sorted(r.id for r in out.collect()) == [994, 995, 996, 997, 998, 999]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "id int, v int")
    assert sorted(r.id for r in ranking.latest_snapshot(df, "v").collect()) == [2, 3]


@pytest.mark.parametrize("km", [50.0, 900.0, 12_000.0, 25_000.0])
def test_radius_join_anywhere(spark, km):
    """Poles, the antimeridian in either notation, and a third of the points at one place."""
    rnd = random.Random(int(km))
    odd = [(90.0, 0.0), (90.0, 137.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0), (10.0, 540.0), (89.9, 90.0), (89.9, -90.0), (0.0, 179.9), (0.0, -179.9)]
    at = lambda: (rnd.uniform(-90, 90), rnd.uniform(-180, 180))
    pts = [(i, *x) for i, x in enumerate([*odd, *(at() for _ in range(400)), *[(0.0, 179.99)] * 200])]
    ctr = [(f"s{i}", *x) for i, x in enumerate([*odd, *(at() for _ in range(30))])]
    p = spark.createDataFrame([*pts, (-1, None, 1.0), (-2, float("nan"), 1.0)], "pid long, lat double, lon double")
    c = spark.createDataFrame([*ctr, ("none", None, None)], "Station string, Latitude double, Longitude double")
    rows = geo.radius_join(p, c, km=km).collect()
    got = {(r.pid, r.Station) for r in rows}
    assert got == brute(spark, pts, ctr, km) and len(got) == len(rows) and got
