import datetime as dt
import random

from porter2_plain import stem_word

from urbanlens.functions.stem import STEP2, STEP3, STEP4, stem_words
from urbanlens.operators import topics as T
from urbanlens.plans import jobs

PAIRS = {
    "consign": "consign", "consigned": "consign", "consistency": "consist",
    "consolation": "consol", "conspiracy": "conspiraci", "knackeries": "knackeri",
    "knives": "knive", "running": "run", "generously": "generous", "happiness": "happi",
    "caresses": "caress", "ponies": "poni", "ties": "tie", "agreed": "agre", "hopping": "hop",
    "relational": "relat", "conditional": "condit", "skies": "sky", "dying": "die",
    "proceeded": "proceed", "london": "london", "stations": "station", "travelling": "travel",
}


def test_porter2_pairs():
    for w, s in PAIRS.items():
        assert stem_word(w) == s, w


def test_expressions_stem_letter_by_letter(spark):
    rnd = random.Random(1)
    ends = [e for e, _ in (*STEP2, *STEP3)] + list(STEP4) + ["s", "es", "ies", "ied", "ed", "ing", "eed", "eedly", "ingly", "y", "e", "ll", "'s", "'", "'s'", "us", "ss", "tt", "iz", ""]
    words = [*PAIRS, "", "a", "is", "'tis", "yy", "syzygy", "sayyid", "gener", "communal", "arsenic", "inning", "succeed", "skies", "éclair", "naïveness", None]
    words += ["".join(rnd.choice("aeiouybcdlstwx'") for _ in range(rnd.randint(0, 6))) + rnd.choice(ends) + rnd.choice(ends) for _ in range(4000)]
    df = spark.createDataFrame([(w,) for w in words], "token string")
    got = {r.token: r.stem for r in stem_words(df).collect()}
    assert {w: got[w] for w in PAIRS} == PAIRS
    assert {w: s for w, s in got.items() if s != stem_word(w)} == {}


def test_top_topics_ties_and_exclusion(spark):
    counts = spark.createDataFrame(
        [("london", 9), ("tube", 5), ("bus", 5), ("rain", 4), ("park", 3), ("cafe", 3), ("zoo", 1)],
        "token string, cnt long")
    after = [r.token for r in T.top_topics(counts).orderBy("cnt", "token").collect()]
    assert sorted(after) == ["bus", "cafe", "rain", "tube"]          # london cut after top 5
    before = [r.token for r in T.top_topics(counts, exclude_when="before").collect()]
    assert sorted(before) == ["bus", "cafe", "park", "rain", "tube"]
    s = T.topics_string(T.top_topics(counts)).first().topics
    assert s == "bus, tube, rain, cafe"
    ref = T.topics_string(T.top_topics(counts), reference_format=True).first().topics
    assert ref == "bus, tube, rain, cafe, "


def test_topic_job_fewer_words(spark):
    posts = spark.createDataFrame([("Running trains!",), ("trains",)], "tweets string")
    row = jobs.topic_job(posts, dt.date(2024, 1, 1)).first()
    assert row.topics == "train, run" and row.date == dt.date(2024, 1, 1)


def test_topic_plan_two_exchanges(spark):
    posts = spark.createDataFrame([("a b c",)], "tweets string")
    plan = jobs.topic_job(posts, dt.date(2024, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Python" not in plan and "Arrow" not in plan
    # words, then stems; the string of the five words is gathered by a third, of one row
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange SinglePartition") <= 1
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert keys == ["_stem", "token"]
