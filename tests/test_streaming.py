import tempfile

from pyspark.sql import functions as F

from urbanlens.streaming.incremental import run_incremental, stream_posts


def test_incremental_sentiment(spark):
    from urbanlens.operators import sentiment as S
    src = tempfile.mkdtemp(prefix="ul-in-")
    out = tempfile.mkdtemp(prefix="ul-out-") + "/r"
    posts = spark.createDataFrame([(1, "good day"), (2, "bad day")], "post_id long, tweets string")
    posts.write.mode("append").parquet(src)
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")

    def job(batch):
        return S.sentiment_score(batch, "post_id", "tweets", lex)

    stream = stream_posts(spark, src, posts.schema)
    q = run_incremental(stream, job, out, name=f"ul_test_{abs(hash(src))}")
    q.awaitTermination(120)
    got = {r.post_id: r.compound for r in spark.read.parquet(out).collect()}
    assert got[1] > 0 > got[2]
