"""Cases that the driver tables lack: page bounds, real-world HTML, keys, batches, rules of the sentiment model."""
import datetime as dt
import inspect
import tempfile

import pytest
from pyspark.sql import functions as F

from urbanlens.functions import listings as lf
from urbanlens.operators import listings as L
from urbanlens.operators import ranking
from urbanlens.operators import sentiment as S
from urbanlens.operators import text as tops
from urbanlens.plans import jobs
from urbanlens.plans import queries as Q
from urbanlens.sources import io

SF = "/root/testdata/sf0.001"


# --- listings

def test_page_bound_counts_from_one_and_is_off_by_default(spark):
    pages = spark.range(1, 302).select(F.col("id").cast("int").alias("page_no"), F.lit(True).alias("nav"))
    assert L.take_pages_while(pages, "nav").count() == 301
    assert L.take_pages_while(pages, "nav", max_pages=300).count() == 300
    assert inspect.signature(L.listings_from_pages).parameters["max_pages"].default is None


def test_real_world_html(spark):
    html = """<main><div id=x data-k='1' class='wide listing-card
      first'><a data-x="1" href='/for-sale/details/77/?a=1&amp;b=2' class="card-link big"><b>view</b></a>
      <p title="t" class="card-address">1 <i>King&#39;s</i> Road &amp; Co</p><P CLASS='card-price'>
<span>&pound;300,000</span></P>
      <div class="card-transport">
        <span class="i" data-testid='london_underground'></span>
        <p class="card-text">0.4 miles King&#x27;s
Cross</p></div><div class="card-features"><div class="card-feature"><b>3</b></div><div class='card-feature'>None</div></div></div>
      <a href="?pn=2" class="page-next">next</a></main>"""
    pages = spark.createDataFrame([(1, "u", html)], "page_no int, url string, html string")
    cards = L.card_fields(L.extract_cards(pages)).first()
    assert cards.href == "/for-sale/details/77/?a=1&b=2" and cards.address == "1 King's Road & Co"
    assert cards.price_text.strip() == "£300,000" and cards.first_icon == "london_underground"
    assert cards.transport_text == "0.4 miles King's\nCross" and cards.features == ["3", "None"]
    assert pages.select(L.has_next_link("html").alias("n")).first().n
    price = html.replace("\n<span>&pound;300,000</span>", "&pound;300,000")
    row = L.listings_from_pages(spark.createDataFrame([(1, "u", price)], pages.schema)).first()
    assert (row.ad_id, row.price, row.bedrooms, row.bathrooms, row.distance) == ("77", 300000.0, 3, None, 0.4)


def test_entities(spark):
    cases = {"a &amp; b": "a & b", "&amp;amp;": "&amp;", "&#163;&#xA3;&pound;": "£££", "&#128512;": "😀", "&unknown; &": "&unknown; &", "&#0;&#xD800;": "&#0;&#xD800;", "": "", "plain": "plain", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.d for r in df.select("t", lf.decode_entities("t").alias("d")).collect()} == cases


def test_station_view_folds_names_first(spark):
    listings = spark.createDataFrame([("Bank", 100.0, 0.1), ("bank ", 300.0, 0.2), ("Far", 1.0, 9.0), ("Oval", 5.0, 0.1)], "subway_station string, price double, distance double")
    scored = spark.createDataFrame([(" BANK", 0.5), ("bank", -0.1), ("bank", 0.2)], "station string, compound double")
    got = {r.station: (r.avg_price, r.n_listings, r.avg_sentiment, r.n_posts) for r in jobs.station_view(listings, scored).collect()}
    assert got == {"Bank": (200.0, 2, 0.2, 3), "Oval": (5.0, 1, None, None)} or got == {"bank": (200.0, 2, 0.2, 3), "Oval": (5.0, 1, None, None)}


# --- keys

def test_keep_first_shuffles_no_text(spark):
    df = spark.createDataFrame([(i, "t" * (i % 3), None if i % 5 == 0 else "k") for i in range(20)], "id long, text string, other string")
    out = ranking.dedup_first(df, ["text", "other"], ["id"])
    first = {}
    for r in df.collect():
        first.setdefault((r.text, r.other), r.id)
    assert {(r.text, r.other): r.id for r in out.collect()} == first
    plan = ranking.dedup_first(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source"), "text", ["doc_id"]).select("doc_id", "source")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "WindowGroupLimit" in text
    assert not any("text#" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_concat_keeps_groups_of_nulls(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "b", None)], "i long, k string, t string")
    assert {(r.k, r.n_rows, r.text) for r in tops.concat_by(df, "k", "t", "i").collect()} == {("a", 0, ""), ("b", 1, "x")}


def test_keyword_edges(spark):
    df = spark.createDataFrame([("From here",), ("fromage",), ("a-from",), ("xfrom",), ("from\n",), (None,)], "t string")
    assert sorted(r.t for r in tops.filter_keyword(df, "t", "from").collect()) == ["From here", "a-from", "from\n"]
    with pytest.raises(ValueError):
        tops.filter_keyword(df, "t", "two words")


@pytest.mark.parametrize("name", ["radius_join", "collect_posts", "stem_join", "sentiment_job", "lexicon_hits", "extract_cards", "extract_nested_cards", "take_pages_while"])
def test_building_a_query_runs_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    Q.registry()[name](spark, SF)
    jobs_run = [j for j in spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # reading a Parquet schema is a job of one task; nothing else may run
    assert all(sum(s.numTasks for s in map(spark.sparkContext.statusTracker().getStageInfo, spark.sparkContext.statusTracker().getJobInfo(j).stageIds) if s) <= 1 for j in jobs_run)


# --- sentiment

LEXICON = {"good": 1.9, "bad": -2.5, "no": -1.2, "kind": 2.4, "great": 3.1, "bomb": -2.2}


def score(spark, *texts, **options):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    rows = S.sentiment_score(posts, "id", "t", lexicon, places=6, display_places=None, **options).collect()
    return [r.compound for r in sorted(rows, key=lambda r: r.id)]


def norm(s):
    return round(s / (s * s + 15) ** 0.5, 6)


def test_rules_change_scores(spark):
    cases = {
        "a good day": 1.9,
        "it was good but bad": 0.5 * 1.9 + 1.5 * -2.5,
        "the least good": 1.9 * -0.74,
        "at least good": 1.9,
        "never so good": (1.9 + 0.293) * 1.25,  # "so" is a booster too
        "never this good": 1.9 * 1.25,
        "never was good": 1.9 * -0.74,
        "without doubt good": 1.9,
        "without any good": 1.9 * -0.74,
        "is not good": 1.9 * -0.74,
        "no good": 0.0 + 1.9 * -0.74,
        "kind of good": 1.9,  # "kind" itself doesn't count before "of"
        "well it was the bomb": 3.0,  # idioms need three words before
        "": 0.0,
    }
    got = dict(zip(cases, score(spark, *cases), strict=True))
    for text, raw in cases.items():
        assert got[text] == pytest.approx(norm(raw), abs=2e-6), text


def test_two_place_score(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    posts = spark.createDataFrame([(1, "a good day")], "id long, t string")
    assert S.sentiment_score(posts, "id", "t", lexicon).first().sentiment == round(norm(1.9), 2)


@pytest.mark.parametrize("ids", [(1, 1), (1, None)])
def test_a_key_that_is_no_key_fails(spark, ids):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    posts = spark.createDataFrame([(ids[0], "good"), (ids[1], "bad")], "id long, t string")
    with pytest.raises(Exception, match="does not identify a post"):
        S.sentiment_score(posts, "id", "t", lexicon).collect()


def test_lexicon_with_two_valences_fails(spark):
    lexicon = spark.createDataFrame([("good", 1.0), ("Good", 2.0)], "token string, valence double")
    posts = spark.createDataFrame([(1, "good")], "id long, t string")
    with pytest.raises(Exception, match="two valences"):
        S.sentiment_score(posts, "id", "t", lexicon).collect()


# --- batches

def test_newest_batch_with_blanks_and_no_rows(spark):
    base = tempfile.mkdtemp(prefix="ul batch ")
    spark.range(3).write.parquet(f"{base}/b 1")
    import time
    time.sleep(1.1)
    spark.range(0).write.parquet(f"{base}/b 2")
    assert io.read_latest(spark, base).count() == 0
    with pytest.raises(FileNotFoundError):
        io.read_latest(spark, f"{base}/none")


def test_load_results(spark):
    base = tempfile.mkdtemp(prefix="ul-load-")
    db = f"ul_load_{abs(hash(base)) % 10**8}"
    io.ensure_tables(spark, db, location=f"{base}/db")
    spark.createDataFrame([("t", "2024-01-08 10:00:00", "Bank", "0.25")], "tweets string, date string, station string, sentiment string").write.parquet(f"{base}/sentiment/1")
    spark.createDataFrame([(dt.date(2024, 1, 8), "a, b")], "date date, topics string").write.parquet(f"{base}/topics/1")
    from urbanlens.sources.schemas import LISTINGS
    io.write_listings_csv(spark.createDataFrame([("1", "l", 1.0, None, 2, None, "a", 0.3, "Bank")], LISTINGS), f"{base}/listings")
    for run in (1, 2):
        jobs.load_results(spark, f"{base}/sentiment", f"{base}/topics", db, dt.datetime(2024, 1, 8, run), f"{base}/listings")
        assert [spark.table(f"{db}.{t}").count() for t in ("sentiment", "topics", "listings", "data_lineage")] == [1] * 4
    assert float(spark.table(f"{db}.sentiment").first().sentiment) == 0.25
    time_later = spark.createDataFrame([("t", "not a date", "Bank", "0.25")], "tweets string, date string, station string, sentiment string")
    with pytest.raises(Exception, match="unreadable date"):
        io.cast_on_load(time_later, strict=True).collect()


def test_default_lexicon_tells_good_from_bad(spark):
    from urbanlens.operators.lexicon import default_lexicon
    posts = spark.createDataFrame([(1, "what a lovely quiet station"), (2, "the worst delay ever"), (3, "a train")], "id long, t string")
    got = {r.id: r.compound for r in S.sentiment_score(posts, "id", "t", default_lexicon(spark)).collect()}
    assert got[1] > 0.3 and got[2] < -0.3 and got[3] == 0


def test_topics_by_station(spark):
    posts = spark.createDataFrame([("Running trains run", "a"), ("london london", "b"), ("tube", "b"), ("x", None)], "tweets string, station string")
    got = {r.station: r.topics for r in jobs.topic_job_by(posts, dt.date(2024, 1, 8)).collect()}
    assert got == {"a": "run, train", "b": "tube", None: "x"}
