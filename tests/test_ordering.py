"""Row numbers without one task for a group."""
import random

from pyspark.sql import functions as F

from urbanlens.operators import text as tops
from urbanlens.operators.ordering import numbered, placed


def table(spark, n=900):
    rnd = random.Random(3)
    return [(rnd.choice(["hot", "hot", "hot", "a", None]), rnd.choice([1, 2, None]), rnd.randint(0, 5), f"t{i}") for i in range(n)]


def test_numbers_follow_the_order(spark):
    data = table(spark) + [("same", 1, 1, "x")] * 400  # a third of the rows are alike
    df = spark.createDataFrame(data, "k string, a int, b int, t string")
    got = numbered(df, ["k"], F.col("a").asc_nulls_first(), F.col("b").desc(), F.col("t")).collect()
    want = []
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, -r[2], r[3]))
        want += [(*r, i) for i, r in enumerate(own, 1)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_places(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert all(r.x == r.place for r in placed(df, F.col("x")).collect())
    assert [r.place for r in placed(df, F.col("x").desc(), name="place").where("x = 999").collect()] == [0]
    assert numbered(df.limit(0), ["x"], F.col("x")).count() == 0


def test_concat_in_order(spark):
    data = table(spark, 300) + [("n", 1, 1, None)]
    df = spark.createDataFrame(data, "k string, a int, b int, t string")
    out = tops.concat_in_order(df, "k", "t", F.col("a").asc_nulls_first(), F.col("b"), F.col("t"), chunk_rows=7).collect()
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
        parts = sorted((r.chunk, r.n_rows, r.text) for r in out if r.k == k)
        assert [c for c, _, _ in parts] == list(range(-(-len(own) // 7))) and max(n for _, n, _ in parts) <= 7
        assert " ".join(t for _, _, t in parts) == " ".join(r[3] for r in own if r[3] is not None)
