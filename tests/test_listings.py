from pyspark.sql import functions as F

from urbanlens.functions import listings as lf
from urbanlens.operators import listings as L


def test_prices(spark):
    cases = [("£450,000", 450000.0, True), ("450000", 450000.0, True), ("POA", None, False),
             ("£1,200 pcm", 1200.0, False), ("£1.5", 1.5, False), ("", None, False),
             ("£,", None, True), ("£٣00", None, False)]
    df = spark.createDataFrame([(c[0],) for c in cases], "p string")
    rows = df.select("p", lf.valid_price("p").alias("ok"), lf.parse_price("p").alias("v")).collect()
    got = {r.p: (r.v, r.ok) for r in rows}
    for text, value, ok in cases:
        assert got[text][1] == ok, text
        if ok:
            assert got[text][0] == value, text


def test_distance(spark):
    df = spark.createDataFrame([("0.2 miles Oxford Circus",), ("Oxford",), ("0.1 miles X miles Y",)], "s string")
    rows = [r.d for r in df.select(lf.parse_distance("s").alias("d")).collect()]
    assert (rows[0].distance, rows[0].station) == (0.2, "Oxford Circus")
    assert rows[1] is None
    assert (rows[2].distance, rows[2].station) == (0.1, "X")


def card(ad, price, icons=("london_underground",), text="0.3 miles Bank", feats=("2", "1"), transport=True):
    t = ""
    if transport:
        t = ('<div class="card-transport">' + "".join(f'<span data-testid="{i}"></span>' for i in icons)
             + f'<p class="card-text">{text}</p></div>')
    f = "".join(f'<div class="card-feature">{x}</div>' for x in feats)
    return (f'<div class="listing-card"><a class="card-link" href="/for-sale/details/{ad}/?x=1">v</a>'
            f'<p class="card-address">addr {ad}</p><p class="card-price">{price}</p>{t}'
            f'<div class="card-features">{f}</div></div>')


NAV = '<a class="page-next" href="?pn=2">next</a>'


def test_listings_from_pages(spark):
    p0 = "<main>" + card(1, "£100,000") + card(2, "£200,000", feats=("3",)) \
        + card(3, "£300,000", icons=("national_rail_station", "london_underground")) \
        + card(4, "£400,000", transport=False) + card(5, "POA") + "</main>" + NAV
    p1 = "<main>" + card(2, "£999,999") + card(6, "£600,000", text="Oxford") + "</main>" + NAV
    p2 = "<main>" + card(7, "£700,000") + "</main>"               # last page: no pagination link
    p3 = "<main>" + card(8, "£800,000") + "</main>" + NAV          # after the stop: ignored
    pages = spark.createDataFrame([(0, "u0", p0), (1, "u1", p1), (2, "u2", p2), (3, "u3", p3)],
                                  "page_no int, url string, html string")
    out = {r.ad_id: r for r in L.listings_from_pages(pages, site_prefix="https://x.example/").collect()}
    assert sorted(out) == ["1", "2"]
    assert out["2"].price == 200000.0 and out["2"].bedrooms == 3 and out["2"].bathrooms is None
    assert out["1"].link == "https://x.example/for-sale/details/1/?x=1"
    assert (out["1"].distance, out["1"].subway_station) == (0.3, "Bank")


def test_take_pages_while_keeps_all_without_stop(spark):
    pages = spark.createDataFrame([(0, NAV), (1, NAV)], "page_no int, html string")
    kept = L.take_pages_while(pages, L.has_next_link("html"))
    assert kept.count() == 2


NESTED = """<main><!-- <div class="listing-card">gone</div> --><DIV data-x="a>b" class = 'wide listing-card'><div><div class=card-transport id=t>
<div><span data-testid='london_underground'></span></div><div class="card-transport inner">x</div><p class='card-text'>0.3 miles <b>Bank &amp; Co</b></p></div></div>
<a href='/for-sale/details/7/?x=1&amp;y=2' class="card-link">v</a><script>if (a < b) "<div></div></div></div>"</script>
<p class="card-address">1 caf&eacute; road &frac12; &#x41;&bogus;</p><div><p class=card-price>£1,000</p></div>
<div class='card-feature'><div>a</div>2</div><div class="card-feature"></div><div class='not-card-feature'>9</div><div class="card-feature">3</div></DIV>
<div class="listing-card"><div class="listing-card">inner</div>tail</div></div><div class="listing-card">open <div>x</div>"""


def test_balanced_elements(spark):
    pages = spark.createDataFrame([(1, "u", NESTED), (2, "u", "<div class='listing-card'></div>"), (3, "u", None), (4, "u", ""), (5, "u", "</div>" * 5 + "<div class=listing-card>y</div>z")],
                                  "page_no int, url string, html string")
    cards = L.extract_cards(pages).orderBy("page_no", "card_no").collect()
    assert [(r.page_no, r.card_no) for r in cards] == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 0), (5, 0)]
    assert [r.card for r in cards[1:]] == ['<div class="listing-card">inner</div>tail', "inner", "open <div>x</div>", "", "y"]
    first = L.card_fields(L.extract_cards(pages)).where("page_no = 1 and card_no = 0").first()
    assert first.href == "/for-sale/details/7/?x=1&y=2" and first.price_text == "£1,000" and first.address == "1 café road ½ A&bogus;"
    assert first.transport_text == "0.3 miles Bank & Co" and first.first_icon == "london_underground" and first.has_transport
    assert first.features == ["a2", "", "3"]
    [out] = L.listings_from_pages(pages.where("page_no = 1").withColumn("html", F.concat("html", F.lit(NAV)))).collect()
    assert (out.ad_id, out.price, out.address, out.distance, out.subway_station) == ("7", 1000.0, "1 café road ½ A&bogus;", 0.3, "Bank & Co")


def test_links(spark):
    html = """<a href="/a">1</a><A class=x HREF='/b?x=1&amp;y=2'>2</A><a name=top>no</a><!-- <a href="/c"> --><a data-u="href=/d" href=/e>5</a><a
href = "/f>g">6</a><abbr href="/h"></abbr><script>'<a href="/i">'</script>"""
    rows = spark.createDataFrame([(1, html), (2, None), (3, "none")], "page_id long, html string")
    assert [(r.pos, r.href) for r in L.extract_links(rows).orderBy("pos").collect()] == [(0, "/a"), (1, "/b?x=1&y=2"), (2, "/e"), (3, "/f>g")]


def test_deep_pages(spark):
    deep = "<div>" * 3000 + "<div class=listing-card>" + "<div>" * 3000 + "x" + "</div>" * 6001
    wide = "".join(f"<div class='listing-card'><div>{i}</div></div>" for i in range(1500))
    pages = spark.createDataFrame([(1, "u", deep), (2, "u", wide)], "page_no int, url string, html string")
    sizes = {(r.page_no, r.card_no): len(r.card) for r in L.extract_cards(pages).collect()}
    assert sizes[1, 0] == 3000 * 11 + 1 and sum(p == 2 for p, _ in sizes) == 1500 and sizes[2, 1499] == len("<div>1499</div>")


def test_one_read_of_the_pages(spark, tmp_path):
    pages = [(i, "u", card(i, "£100") + (NAV if i != 2 else "")) for i in range(5)]
    pages.append((5, "u", "no card, no link"))
    spark.createDataFrame(pages, "page_no int, url string, html string").write.parquet(str(tmp_path / "pages"))
    out = L.listings_from_pages(spark.read.parquet(str(tmp_path / "pages")))
    assert sorted(r.ad_id for r in out.collect()) == ["0", "1"]
    assert "html" not in out._jdf.queryExecution().toString()  # what is left reads the cards that were cut out
