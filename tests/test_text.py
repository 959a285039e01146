from pyspark.sql import functions as F

from urbanlens.functions import text as tf
from urbanlens.operators import text as tops

CLEAN_CASES = [
    ("Hi @bob_smith see https://t.co/ab?x=1 now!", "Hi smith see  now"),
    ("a\nb", "ab"),
    ("café don't", "caf dont"),
    ("http:// x", "http x"),
    ("x_http://y z", " z"),
    ("éhttp://q r", " r"),
    ("£10 😀 :)", "10  "),
    ("a\tb", "a\tb"),
    ("", ""),
    (None, None),
    ("name@mail.com", "namecom"),
]


def test_clean_text_edge_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEAN_CASES)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", tf.clean_text("t").alias("c")).collect()}
    for i, (_, want) in enumerate(CLEAN_CASES):
        assert got[i] == want, (CLEAN_CASES[i], got[i])


def test_clean_text_idempotent(spark):
    df = spark.createDataFrame([(t,) for t, _ in CLEAN_CASES], "t string")
    once = df.select(tf.clean_text("t").alias("c"))
    rows = once.select("c", tf.clean_text("c").alias("cc")).collect()
    assert all(r.c == r.cc for r in rows)


def test_tokenize(spark):
    df = spark.createDataFrame([(" lead  two\tTab ",), ("",), (None,)], "t string")
    got = [r.x for r in df.select(tf.tokenize("t").alias("x")).collect()]
    assert got == [["lead", "two", "tab"], [], None]


def test_stop_words_keep_duplicates(spark):
    df = spark.createDataFrame([(["i", "I", "don't", "dont", "tube", "tube"],)], "t array<string>")
    got = df.select(tf.remove_stop_words("t").alias("x")).first().x
    assert got == ["dont", "tube", "tube"]


def test_stop_list_is_spark_default():
    from pyspark.ml.feature import StopWordsRemover
    assert list(tf.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_bag_split(spark):
    df = spark.createDataFrame([("a,b.c-d  e",)], "t string")
    assert df.select(tf.bag_split("t").alias("x")).first().x == ["a", "b", "c", "d", "e"]


def test_word_count_sums_tokens(spark):
    df = spark.createDataFrame([(["a", "b", "a", ""],), (["b"],), ([],)], "t array<string>")
    counts = {r.token: r.cnt for r in tops.word_count(df, "t").collect()}
    assert counts == {"a": 2, "b": 2}


def test_concat_by_chunks_rebuild_whole(spark):
    rows = [(i, "s" if i % 3 else None, f"w{i}") for i in range(25)]
    df = spark.createDataFrame(rows, "o long, k string, t string")
    out = tops.concat_by(df, "k", "t", "o", chunk_rows=4).collect()
    for key in ("s", None):
        parts = sorted((r.chunk, r.text) for r in out if r.k == key)
        whole = " ".join(p for _, p in parts)
        assert whole == " ".join(t for o, k, t in rows if k == key)
    assert max(r.n_rows for r in out) <= 4
