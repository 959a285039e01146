"""DuckDB SQL oracles, one per registered query where SQL can express it.

Tables ``documents``, ``customer``, ``supplier``, ``part``, ``pages``,
``events``, ``orders``, ``conversations`` ... are views over the same Parquet
files the Spark queries read. Column names and types follow the Spark side.
"""

from __future__ import annotations

import dataclasses

from urbanlens.functions.text import ENGLISH_STOP_WORDS  # held against Spark's own list in the tests
from urbanlens.plans import bindings as B
from urbanlens.plans import queries as Q
from urbanlens.plans.oracle_stem import stem_ctes
from urbanlens.sources import io

# Fixed value, stated a second time: mention, any other character, URL.
CLEAN_PATTERN = r"(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\w+:\/\/\S+)"

_ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    _ORACLES[name] = sql


def registry() -> dict[str, str]:
    return dict(_ORACLES)


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_str(i) for i in items) + "]"


def sql_in(items) -> str:
    return "(" + ", ".join(sql_str(i) for i in items) + ")"


# ---- shared SQL fragments ---------------------------------------------------

def CLEAN(x: str) -> str:
    return f"regexp_replace({x}, {sql_str(CLEAN_PATTERN)}, '', 'g')"


def TOPIC(x: str) -> str:
    return f"regexp_replace(lower({CLEAN(x)}), ' +', ' ', 'g')"


def TOKENS(x: str) -> str:
    return f"list_filter(string_split_regex(lower({x}), '\\s'), lambda t: t <> '')"


STOP_LIST = sql_list(sorted({w.lower() for w in ENGLISH_STOP_WORDS}))


def NOSTOP(arr: str) -> str:
    return f"list_filter({arr}, lambda t: NOT list_contains({STOP_LIST}, lower(t)))"


def TOPIC_TOKENS(x: str) -> str:
    return NOSTOP(TOKENS(TOPIC(x)))


def LAT(k: str) -> str:
    return (f"({B.LAT_BASE}::DOUBLE + (({k} * {B.LAT_MUL}) % {B.LAT_MOD})::DOUBLE"
            f" / {B.COORD_SCALE}::DOUBLE)")


def LON(k: str) -> str:
    return (f"({B.LON_BASE}::DOUBLE + (({k} * {B.LON_MUL}) % {B.LON_MOD})::DOUBLE"
            f" / {B.COORD_SCALE}::DOUBLE)")


POSTS = f"""(SELECT doc_id AS post_id, text AS tweets,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS date,
    source AS station, lang, {LAT('doc_id')} AS lat, {LON('doc_id')} AS lon
  FROM documents)"""

WORD_COUNTS = f"""(SELECT token, count(*) AS cnt FROM
    (SELECT unnest({TOPIC_TOKENS('text')}) AS token FROM documents)
  WHERE token <> '' GROUP BY token)"""

TOP5 = f"""(SELECT * FROM (SELECT token, cnt FROM {WORD_COUNTS} ORDER BY cnt DESC, token LIMIT 5)
  WHERE token NOT IN ('london'))"""

INLINE_STEMS = "(VALUES " + ", ".join(f"({sql_str(a)}, {sql_str(b)})" for a, b in Q.INLINE_STEMS) \
    + ") AS s(s_token, s_stem)"


def positions(key: str, arr: str, out: str = "token", src: str = "documents") -> str:
    return f"""SELECT {key}, pos, {out} FROM (
  SELECT {key}, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS {out}
  FROM (SELECT {key}, {arr} AS l FROM {src}))"""


# ---- scans and projections --------------------------------------------------

oracle("scan_posts", f"SELECT * FROM {POSTS}")
oracle("project_posts", f"SELECT post_id, date, station, {CLEAN('tweets')} AS tweets FROM {POSTS}")
oracle("filter_language", f"SELECT post_id, station FROM {POSTS} WHERE lang = {sql_str(Q.LANG)}")
oracle("filter_keyword", f"""SELECT doc_id, source FROM documents
WHERE list_contains(string_split_regex(lower(text), '[^a-z0-9]+'), {sql_str(Q.KEYWORD)})""")
oracle("non_empty", f"""SELECT doc_id, length(t)::INTEGER AS n_chars FROM
  (SELECT doc_id, {TOPIC('text')} AS t FROM documents) WHERE t IS NOT NULL AND t <> ''""")

# ---- text functions ---------------------------------------------------------

oracle("clean_text", f"SELECT doc_id, {CLEAN('text')} AS text FROM documents")
oracle("lower_text", f"SELECT doc_id, lower({CLEAN('text')}) AS text FROM documents")
oracle("collapse_spaces", f"SELECT doc_id, {TOPIC('text')} AS text FROM documents")
oracle("tokenize", positions("doc_id", TOKENS(TOPIC("text"))))
oracle("remove_stop_words", positions("doc_id", TOPIC_TOKENS("text")))
oracle("array_join_tokens",
       f"SELECT doc_id, array_to_string({TOPIC_TOKENS('text')}, ',') AS joined FROM documents")
oracle("bag_split", positions(
    "doc_id",
    "list_filter(string_split_regex(translate(lower(text), ',.-', '   '), '\\s+'), lambda t: t <> '')",
    "word"))

# ---- counts, top-k, topics --------------------------------------------------

oracle("word_count", f"SELECT token, cnt FROM {WORD_COUNTS}")
oracle("top_topics", f"SELECT token, cnt FROM {TOP5}")
oracle("topics_string",
       f"SELECT coalesce(string_agg(token, ', ' ORDER BY cnt DESC, token), '') AS topics FROM {TOP5}")
oracle("stem_join", f"""SELECT token, coalesce(s_stem, token) AS stem, cnt
FROM {WORD_COUNTS} c LEFT JOIN {INLINE_STEMS} ON c.token = s.s_token""")
oracle("topic_job", f"""WITH c AS (
  SELECT token, count(*) AS cnt FROM (SELECT unnest({TOPIC_TOKENS('tweets')}) AS token FROM {POSTS})
  WHERE token <> '' GROUP BY token),
st AS (SELECT coalesce(s_stem, token) AS token, sum(cnt)::BIGINT AS cnt
  FROM c LEFT JOIN {INLINE_STEMS} ON c.token = s.s_token GROUP BY 1),
top AS (SELECT * FROM (SELECT * FROM st ORDER BY cnt DESC, token LIMIT 5) WHERE token NOT IN ('london'))
SELECT DATE '{Q.RUN_DATE.isoformat()}' AS date,
  coalesce(string_agg(token, ', ' ORDER BY cnt DESC, token), '') AS topics FROM top""")
oracle("stem_vocab", f"""WITH {stem_ctes(WORD_COUNTS)} SELECT token, stem FROM stemmed""")
oracle("topic_job_porter2", f"""WITH c AS MATERIALIZED (
  SELECT token, count(*) AS cnt FROM (SELECT unnest({TOPIC_TOKENS('tweets')}) AS token FROM {POSTS})
  WHERE token <> '' GROUP BY token),
{stem_ctes('c')},
st AS (SELECT stem AS token, sum(cnt)::BIGINT AS cnt FROM c JOIN stemmed USING (token) GROUP BY 1),
top AS (SELECT * FROM (SELECT * FROM st ORDER BY cnt DESC, token LIMIT 5) WHERE token NOT IN ('london'))
SELECT DATE '{Q.RUN_DATE.isoformat()}' AS date,
  coalesce(string_agg(token, ', ' ORDER BY cnt DESC, token), '') AS topics FROM top""")
oracle("topic_job_by_station", f"""WITH c AS MATERIALIZED (
  SELECT station, token, count(*) AS cnt FROM (SELECT station, unnest({TOPIC_TOKENS('tweets')}) AS token FROM {POSTS})
  WHERE token <> '' GROUP BY ALL),
{stem_ctes('c')},
st AS (SELECT station, stem AS token, sum(cnt)::BIGINT AS cnt FROM c JOIN stemmed USING (token) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY cnt DESC, token) AS rn FROM st QUALIFY rn <= 5)
SELECT DATE '{Q.RUN_DATE.isoformat()}' AS date, station,
  coalesce(string_agg(token, ', ' ORDER BY rn) FILTER (token NOT IN ('london')), '') AS topics FROM top GROUP BY station""")
oracle("concat_by_source", f"""SELECT source, chunk, n_rows, md5(t) AS text_md5, length(t)::INTEGER AS text_len
FROM (SELECT source, floor(doc_id / {Q.CONCAT_CHUNK_ROWS})::BIGINT AS chunk, count(*) AS n_rows,
        string_agg(text, ' ' ORDER BY doc_id) AS t
      FROM documents WHERE text IS NOT NULL GROUP BY 1, 2)""")
oracle("concat_in_order", f"""SELECT source, chunk, count(text) AS n_rows, md5(coalesce(string_agg(text, ' ' ORDER BY n), '')) AS text_md5,
  length(coalesce(string_agg(text, ' ' ORDER BY n), ''))::INTEGER AS text_len
  FROM (SELECT *, (n - 1) // {Q.CONCAT_CHUNK_ROWS} AS chunk FROM (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC NULLS LAST, doc_id) AS n FROM documents))
  GROUP BY source, chunk""")
oracle("union_batches", """SELECT 'doc' AS kind, doc_id AS id, md5(text) AS text_md5 FROM documents
UNION ALL
SELECT 'conv' AS kind, conv_id * 1000 + turn AS id, md5(text) AS text_md5 FROM conversations""")

# ---- sentiment --------------------------------------------------------------

from urbanlens.operators import sentiment as _S  # noqa: E402
from urbanlens.plans.oracle_sentiment import sentiment_sql  # noqa: E402


def _sent(carry=()):
    return sentiment_sql(POSTS, "post_id", CLEAN("tweets"), Q.TEST_LEXICON, Q.TEST_BOOSTERS,
                         Q.TEST_NEGATORS, _S.SPECIAL_CASES, carry=carry)


_PUNCT = "[" + "".join("\\" + ch for ch in _S.PUNCTUATION) + "]"
_EDGE = sql_str(f"^{_PUNCT}+|{_PUNCT}+$")
_STRIP = (f"CASE WHEN length(regexp_replace(x, {_EDGE}, '', 'g')) <= 2 THEN x "
          f"ELSE regexp_replace(x, {_EDGE}, '', 'g') END")
_LEXV = ", ".join(f"({sql_str(k)}, {float(v)!r}::DOUBLE)" for k, v in Q.TEST_LEXICON.items())

oracle("lexicon_hits", f"""WITH lex AS (SELECT lower(t) AS t, max(v) AS v FROM (VALUES {_LEXV}) AS x(t, v) GROUP BY 1),
w AS (SELECT post_id, list_transform(list_filter(string_split_regex({CLEAN('tweets')}, '\\s+'),
        lambda t: t <> ''), lambda x: {_STRIP}) AS l FROM {POSTS}),
u AS (SELECT post_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS token FROM w)
SELECT post_id, pos, token, lex.v AS valence FROM u JOIN lex ON lower(u.token) = lex.t""")
oracle("sentiment_score", _sent())
_MEAN = "(sum(round(compound * 10000.0)::BIGINT) / count(compound)) / 10000.0"
oracle("avg_sentiment_by_source", f"""SELECT station, {_MEAN} AS avg_sentiment,
  count(*) AS n_posts FROM ({_sent(('station',))}) GROUP BY station""")
oracle("sentiment_job", f"""SELECT s.post_id, s.date, s.station, p.tweets, s.compound AS sentiment
FROM ({_sent(('date', 'station'))}) s
JOIN (SELECT post_id, {CLEAN('tweets')} AS tweets FROM {POSTS}) p ON s.post_id = p.post_id""")



def _places(x: str) -> str:
    """Two places by the exact value of the double, in 128-bit integers."""
    u, e = f"abs(round({x} * 10000)::HUGEINT)", f"(abs({x}) * 1152921504606846976.0)::BIGINT::HUGEINT * 10000"
    d = f"({u} * 1152921504606846976::HUGEINT)"
    up = f"CASE WHEN {u} % 100 <> 50 THEN ({u} % 100 > 50)::INTEGER WHEN {e} > {d} THEN 1 WHEN {e} < {d} THEN 0 ELSE ({u} // 100) % 2 END"
    return f"(sign({x}) * ({u} // 100 + {up})::DOUBLE / 100.0 + 0.0)"


def _ruled(rules, idioms=Q.RULE_IDIOMS) -> str:
    return sentiment_sql(POSTS, "post_id", CLEAN("tweets"), Q.RULE_LEXICON, Q.RULE_BOOSTERS, Q.RULE_NEGATORS, idioms, rules=rules)


oracle("sentiment_rules", f"SELECT post_id, compound, {_places('compound')} AS sentiment FROM ({_ruled(Q._rules())})")
_RUNS = {n: _ruled(dataclasses.replace(Q._rules(), **c)) for n, c in Q.WITHOUT.items()} | {"idioms": _ruled(Q._rules(), {Q.SILENT: 0.0})}
oracle("sentiment_rule_effects", f"WITH whole AS MATERIALIZED ({_ruled(Q._rules())})\n" + " UNION ALL ".join(
    f"SELECT {sql_str(n)} AS rule, count(*) FILTER (r.compound <> whole.compound) AS n_posts FROM ({sql}) r JOIN whole ON r.post_id = whole.post_id"
    for n, sql in _RUNS.items()))
oracle("two_places", f"SELECT doc_id, (doc_id * 25 % 20001 - 10000) / 10000.0::DOUBLE AS compound, {_places('((doc_id * 25 % 20001 - 10000) / 10000.0::DOUBLE)')} AS sentiment FROM documents")

# ---- geo, ranking, snapshots -------------------------------------------------


def HAV(lat1, lon1, lat2, lon2, r=6371.0088):
    return (f"({2.0 * r!r} * asin(sqrt(sin((radians({lat2}) - radians({lat1})) / 2.0) * sin((radians({lat2}) - radians({lat1})) / 2.0)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * sin((radians({lon2}) - radians({lon1})) / 2.0) * sin((radians({lon2}) - radians({lon1})) / 2.0))))")


PTS = f"(SELECT c_custkey AS point_id, {LAT('c_custkey')} AS lat, {LON('c_custkey')} AS lon FROM customer)"
CENTERS = f"(SELECT s_name AS Station, {LAT('s_suppkey')} AS Latitude, {LON('s_suppkey')} AS Longitude FROM supplier)"

oracle("haversine", f"""SELECT point_id, round({HAV('lat', 'lon', f'{B.LAT_BASE}::DOUBLE', f'{B.LON_BASE}::DOUBLE')}, 6)
  AS distance_km FROM {PTS}""")
oracle("radius_join", f"""SELECT point_id, station, round(d, 6) AS distance_km FROM (
  SELECT p.point_id, c.Station AS station, {HAV('p.lat', 'p.lon', 'c.Latitude', 'c.Longitude')} AS d
  FROM {PTS} p, {CENTERS} c) WHERE d <= {Q.RADIUS_KM}""")


def _places_of(table: str, key: str) -> str:
    return f"""(SELECT {key} AS id, CASE WHEN {key} % 3 = 0 THEN 89.5::DOUBLE ELSE ({key} * 7919 % 18001 - 9000) / 100.0::DOUBLE END AS lat,
  CASE WHEN {key} % 3 = 0 THEN 179.9::DOUBLE ELSE ({key} * 104729 % 36001 - 18000) / 100.0::DOUBLE END AS lon FROM {table})"""


oracle("radius_join_global", f"""SELECT place_id, center_id, round(d, 4) AS distance_km FROM (
  SELECT p.id AS place_id, c.id AS center_id, {HAV('p.lat', 'p.lon', 'c.lat', 'c.lon')} AS d
  FROM {_places_of('customer', 'c_custkey')} p, {_places_of('supplier', 's_suppkey')} c) WHERE d <= {Q.GLOBAL_KM}""")
oracle("collect_posts", f"""SELECT post_id, tweets, date, station FROM (
  SELECT p.post_id, p.tweets, p.date, c.Station AS station,
    row_number() OVER (PARTITION BY c.Station ORDER BY p.date DESC, p.post_id) AS rn
  FROM {POSTS} p, {CENTERS} c
  WHERE p.lang = {sql_str(Q.LANG)}
    AND list_contains(string_split_regex(lower(p.tweets), '[^a-z0-9]+'), {sql_str(Q.COLLECT_KEYWORD)})
    AND {HAV('p.lat', 'p.lon', 'c.Latitude', 'c.Longitude')} <= {Q.COLLECT_KM}) WHERE rn <= {Q.TOP_N}""")
oracle("top_n_per_group", f"""SELECT event_id, ts, event_type, rn FROM (
  SELECT event_id, ts, event_type,
    row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id)::INTEGER AS rn
  FROM events) WHERE rn <= {Q.TOP_N}""")
oracle("dedup_first", """SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source
  FROM documents GROUP BY text""")
oracle("first_n", f"SELECT s_suppkey, s_name FROM supplier ORDER BY s_name LIMIT {Q.FIRST_N}")
oracle("latest_snapshot", """SELECT event_id, ts, event_type FROM events
  WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")

# ---- listings -----------------------------------------------------------------


def _price_text(k="p_partkey", retail="p_retailprice"):
    return (f"CASE WHEN {k} % {B.POA_EVERY} = 0 THEN 'POA' WHEN {k} % {B.PCM_EVERY} = 0 THEN '£1,200 pcm'"
            f" ELSE '£' || format('{{:,}}', floor({retail} * 100)::BIGINT) END")


def _dist_text(k="p_partkey", size="p_size"):
    return (f"CASE WHEN {k} % {B.BAD_DISTANCE_EVERY} = 0 THEN 'Oxford' ELSE"
            f" concat(({size} // 10)::VARCHAR, '.', ({size} % 10)::VARCHAR, ' miles src', ({k} % {B.SOURCES})::VARCHAR) END")


_AD = "(p_partkey - p_partkey // 10)"
RAW_LISTINGS = f"""(SELECT p_partkey, '/for-sale/details/' || {_AD}::VARCHAR || '/?x=1' AS href,
  {_price_text()} AS price_text, {_dist_text()} AS distance_text,
  CASE WHEN p_partkey % {B.NONE_EVERY} = 0 THEN 'None' ELSE (p_size % 5 + 1)::VARCHAR END AS rooms_text
  FROM part)"""


def _feat(cond, val):
    return f"CASE WHEN p_partkey % 4 >= {cond} THEN '<div class=\"card-feature\">' || ({val})::VARCHAR || '</div>' ELSE '' END"


_ICON = f"CASE WHEN p_partkey % {B.RAIL_EVERY} = 0 THEN 'national_rail_station' ELSE 'london_underground' END"
_TRANSPORT = (f"CASE WHEN p_partkey % {B.NO_TRANSPORT_EVERY} = 0 THEN '' ELSE concat("
              f"'<div class=\"card-transport\"><span data-testid=\"', {_ICON}, '\"></span><p class=\"card-text\">',"
              f" {_dist_text()}, '</p><span data-testid=\"london_underground\"></span></div>') END")
_CARD = (f"concat('<div class=\"listing-card\"><a class=\"card-link\" href=\"/for-sale/details/', {_AD}::VARCHAR,"
         f" '/?x=1\">view</a><p class=\"card-address\">', p_name, '</p><p class=\"card-price\">', {_price_text()}, '</p>',"
         f" {_TRANSPORT}, '<div class=\"card-features\">', {_feat(1, 'p_size % 5 + 1')}, {_feat(2, 'p_size % 3 + 1')},"
         f" {_feat(3, 'p_size % 2 + 1')}, '</div></div>')")
CARD_PAGES = f"""(SELECT page_no::INTEGER AS page_no, 'https://listings.example/for-sale?pn=' || page_no::VARCHAR AS url,
   concat('<html><body><main>', body, '</main><nav>',
     CASE WHEN page_no = floor((lastp + 1) * 3 / 4.0) OR page_no = lastp THEN ''
          ELSE '<a class="page-next" href="?pn=next">next</a>' END, '</nav></body></html>') AS html
  FROM (SELECT p_partkey // {B.CARDS_PER_PAGE} AS page_no, string_agg({_CARD}, '' ORDER BY p_partkey) AS body
        FROM part GROUP BY 1),
       (SELECT max(p_partkey // {B.CARDS_PER_PAGE}) AS lastp FROM part))"""
CARDS = f"""(SELECT page_no, card_no,
   regexp_extract(card, '<a class="card-link" href="([^"]*)"', 1) AS href,
   regexp_extract(card, '<p class="card-address">([^<]*)</p>', 1) AS address,
   regexp_extract(card, '<p class="card-price">([^<]*)</p>', 1) AS price_text,
   regexp_extract(card, '<div class="card-transport">(.*?)</div>', 0) AS transport_block,
   regexp_extract(regexp_extract(card, '<div class="card-transport">(.*?)</div>', 1), 'data-testid="([^"]*)"', 1) AS first_icon,
   regexp_extract(regexp_extract(card, '<div class="card-transport">(.*?)</div>', 1), '<p class="card-text">([^<]*)</p>', 1) AS transport_text,
   regexp_extract_all(card, '<div class="card-feature">([^<]*)</div>', 1) AS features
 FROM (SELECT page_no, (generate_subscripts(cs, 1) - 1)::INTEGER AS card_no, unnest(cs) AS card
       FROM (SELECT page_no, string_split_regex(html, '<div class="listing-card">')[2:] AS cs FROM {{pages}})))"""
KEPT_PAGES = f"""(SELECT * FROM {CARD_PAGES} WHERE
   (SELECT min(page_no) FROM {CARD_PAGES} WHERE NOT coalesce(regexp_matches(html, '<a class="page-next"'), false)) IS NULL
   OR page_no < (SELECT min(page_no) FROM {CARD_PAGES} WHERE NOT coalesce(regexp_matches(html, '<a class="page-next"'), false)))"""
_DPARTS = "string_split(transport_text, ' miles ')"
LISTINGS = f"""(SELECT ad_id, {sql_str(Q.SITE_PREFIX)} || regexp_replace(href, '^/+', '') AS link,
   TRY_CAST(nullif(regexp_replace(price_text, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price,
   TRY_CAST(nullif(features[1], 'None') AS INTEGER) AS bedrooms,
   TRY_CAST(nullif(features[2], 'None') AS INTEGER) AS bathrooms,
   TRY_CAST(nullif(features[3], 'None') AS INTEGER) AS living_rooms,
   address, TRY_CAST({_DPARTS}[1] AS DOUBLE) AS distance, {_DPARTS}[2] AS subway_station
 FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY page_no, card_no) AS rn
       FROM (SELECT *, split_part(split_part(href, '?', 1), '/', 4) AS ad_id FROM {CARDS.format(pages=KEPT_PAGES)}
             WHERE coalesce(regexp_matches(price_text, '^[£,0-9]+$'), false)
               AND coalesce(first_icon <> 'national_rail_station', true)
               AND href <> '' AND transport_block <> ''))
 WHERE rn = 1 AND len({_DPARTS}) > 1)"""
HOUSING = f"""(SELECT subway_station AS station, round(avg(price), 4) AS avg_price, count(*) AS n_listings
  FROM {LISTINGS} WHERE distance * 1.609344 < {Q.LISTING_KM} GROUP BY subway_station)"""

oracle("scan_pages", "SELECT page_id, url, md5(html) AS html_md5 FROM pages")
oracle("extract_links", """SELECT page_id, pos, href FROM (
  SELECT page_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS href
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages))""")
oracle("valid_price", f"""SELECT p_partkey, price_text FROM {RAW_LISTINGS}
  WHERE coalesce(regexp_matches(price_text, '^[£,0-9]+$'), false)""")
oracle("parse_price", f"""SELECT p_partkey,
  TRY_CAST(nullif(regexp_replace(price_text, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS price FROM {RAW_LISTINGS}""")
oracle("parse_ad_id", f"SELECT p_partkey, split_part(split_part(href, '?', 1), '/', 4) AS ad_id FROM {RAW_LISTINGS}")
oracle("absolute_link", f"""SELECT p_partkey, {sql_str(Q.SITE_PREFIX)} || regexp_replace(href, '^/+', '') AS link
  FROM {RAW_LISTINGS}""")
oracle("parse_distance", f"""SELECT p_partkey, TRY_CAST(l[1] AS DOUBLE) AS distance, l[2] AS station
  FROM (SELECT p_partkey, string_split(distance_text, ' miles ') AS l FROM {RAW_LISTINGS}) WHERE len(l) > 1""")
oracle("none_to_null", f"SELECT p_partkey, nullif(rooms_text, 'None') AS rooms FROM {RAW_LISTINGS}")
oracle("positional_get", f"""SELECT page_no, card_no, features[1] AS bedrooms, features[2] AS bathrooms,
  features[3] AS living_rooms FROM {CARDS.format(pages=CARD_PAGES)}""")
oracle("extract_cards", f"""SELECT page_no, card_no, href, address, price_text, first_icon, transport_text
  FROM {CARDS.format(pages=CARD_PAGES)}""")
oracle("first_icon_filter", f"""SELECT page_no, card_no FROM {CARDS.format(pages=CARD_PAGES)}
  WHERE coalesce(first_icon <> 'national_rail_station', true)""")
oracle("take_pages_while", f"SELECT page_no FROM {KEPT_PAGES}")
oracle("listings_job", f"SELECT * FROM {LISTINGS}")
oracle("avg_price_by_station", f"SELECT * FROM {HOUSING}")
oracle("station_view", f"""SELECT h.station, h.avg_price, h.n_listings, m.avg_sentiment, m.n_posts
FROM (SELECT lower(trim(name)) AS k, min(trim(name)) AS station, round(avg(price), 4) AS avg_price, count(*) AS n_listings
  FROM (SELECT *, CASE WHEN ad_id::BIGINT % 3 = 0 THEN upper(subway_station) || ' ' ELSE subway_station END AS name
        FROM {LISTINGS} WHERE distance * 1.609344 < {Q.LISTING_KM}) GROUP BY 1) h
LEFT JOIN (SELECT lower(trim(name)) AS k, {_MEAN} AS avg_sentiment, count(*) AS n_posts
  FROM (SELECT *, CASE WHEN post_id % 2 = 0 THEN ' ' || upper(station) ELSE station END AS name FROM ({_sent(('station',))}))
  GROUP BY 1) m ON h.k = m.k""")

# What is written into the nested cards, taken from the table and not from the pages.
_NESTED = f"""(SELECT (p_partkey // {B.CARDS_PER_PAGE})::INTEGER AS page_no,
  (row_number() OVER (PARTITION BY p_partkey // {B.CARDS_PER_PAGE} ORDER BY p_partkey) - 1)::INTEGER AS card_no,
  '/for-sale/details/' || {_AD}::VARCHAR || '/?x=1&y=2' AS href, p_name || ' é!' AS address, {_price_text()} AS price_text,
  p_partkey % {B.NO_TRANSPORT_EVERY} <> 0 AS has_transport,
  CASE WHEN p_partkey % {B.NO_TRANSPORT_EVERY} = 0 THEN '' ELSE {_ICON} END AS first_icon,
  CASE WHEN p_partkey % {B.NO_TRANSPORT_EVERY} = 0 THEN '' ELSE {_dist_text()} END AS transport_text,
  [(p_size % 5 + 1)::VARCHAR, (p_size % 3 + 1)::VARCHAR, (p_size % 2 + 1)::VARCHAR][1:p_partkey % 4] AS features FROM part)"""
oracle("extract_nested_cards", f"SELECT * REPLACE (array_to_string(features, ',') AS features) FROM {_NESTED}")
_LAST = f"(SELECT max(p_partkey // {B.CARDS_PER_PAGE}) FROM part)"
oracle("listings_job_nested", f"""SELECT ad_id, {sql_str(Q.SITE_PREFIX)} || href[2:] AS link, replace(price_text[2:], ',', '')::DOUBLE AS price,
  features[1]::INTEGER AS bedrooms, features[2]::INTEGER AS bathrooms, features[3]::INTEGER AS living_rooms, address,
  {_DPARTS}[1]::DOUBLE AS distance, {_DPARTS}[2] AS subway_station
FROM (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY page_no, card_no) AS rn
  FROM (SELECT *, split_part(href, '/', 4) AS ad_id FROM {_NESTED}
    WHERE page_no < least(floor(({_LAST} + 1) * 3 / 4.0), {_LAST}) AND regexp_full_match(price_text, '[£,0-9]+') AND has_transport AND first_icon <> 'national_rail_station'))
WHERE rn = 1 AND len({_DPARTS}) > 1""")

# ---- load, lineage ---------------------------------------------------------------

oracle("batch_number", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS batch_nr,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp FROM orders""")
_B = f"strftime(d, '%Y%m%d')"
_POSTS_PATH = f"'s3://{Q.BUCKET}/posts/' || {_B} || '.parquet'"
_OUTS = f"'s3://{Q.BUCKET}/sentiment/' || {_B} || '/, s3://{Q.BUCKET}/topics/' || {_B} || '/'"
oracle("lineage_rows", f"""WITH days AS (SELECT CAST(ts AS DATE) AS d, date_trunc('second', max(ts)) AS t
  FROM events GROUP BY 1)
SELECT {_B}::BIGINT AS batch_nr, 1 AS job_nr, t AS timestamp, '{io.STEP_COLLECT}' AS step_airflow,
  'External: posts API' AS source, {_POSTS_PATH} AS destination FROM days
UNION ALL SELECT {_B}::BIGINT, 2, t, '{io.STEP_SPARK}', {_POSTS_PATH}, {_OUTS} FROM days
UNION ALL SELECT {_B}::BIGINT, 3, t, '{io.STEP_LOAD}', {_OUTS},
  'db: {Q.DB}.sentiment, {Q.DB}.topics' FROM days""")
_SCORED_TEXT = """(SELECT doc_id AS post_id, text AS tweets, source AS station,
  CASE WHEN doc_id % 19 = 0 THEN 'yesterday' ELSE strftime(to_timestamp({epoch} + doc_id * 3600) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS date,
  CASE WHEN doc_id % 13 = 0 THEN 'n/a' WHEN doc_id % 17 = 0 THEN '1234.5' ELSE printf('%.2f', (doc_id % 201 - 100) / 100.0) END AS sentiment
  FROM documents)""".format(epoch=B.POSTS_EPOCH_SECONDS)
_TYPED = f"""(SELECT *, TRY_CAST(date AS TIMESTAMP) AS t, TRY_CAST(sentiment AS DECIMAL(5,2)) AS n FROM {_SCORED_TEXT})"""
_BAD = "((date IS NOT NULL AND t IS NULL) OR (sentiment IS NOT NULL AND n IS NULL))"
oracle("cast_on_load", f"""SELECT p.tweets, s.date, s.station, s.compound::DECIMAL(10,4) AS sentiment
FROM ({_sent(('date', 'station'))}) s
JOIN (SELECT post_id, {CLEAN('tweets')} AS tweets FROM {POSTS}) p ON s.post_id = p.post_id""")
oracle("load_accepted", f"SELECT post_id, t AS date, station, n AS sentiment FROM {_TYPED} WHERE NOT {_BAD}")
oracle("load_rejected", f"""SELECT post_id, date, sentiment, concat_ws('; ', CASE WHEN t IS NULL THEN 'date: not timestamp' END,
  CASE WHEN n IS NULL THEN 'sentiment: not decimal(5,2)' END) AS reasons FROM {_TYPED} WHERE {_BAD}""")
_BATCHES = " UNION ALL ".join(f"SELECT {b} AS batch_nr, {i} AS turn" for i, b in enumerate(Q.BATCHES))
oracle("load_results", f"""SELECT batch_nr, md5(tweets) AS tweets_md5, t AS date, station, n AS sentiment
  FROM {_TYPED} JOIN ({_BATCHES}) ON post_id % {len(Q.BATCHES)} = turn WHERE NOT {_BAD}""")
oracle("load_counts", f"""WITH b AS ({_BATCHES})
SELECT batch_nr, 'sentiment' AS table_name, count(*) AS n_rows FROM {_TYPED} JOIN b ON post_id % {len(Q.BATCHES)} = turn WHERE NOT {_BAD} GROUP BY 1
UNION ALL SELECT batch_nr, 'rejected', count(*) FROM {_TYPED} JOIN b ON post_id % {len(Q.BATCHES)} = turn WHERE {_BAD} GROUP BY 1
UNION ALL SELECT batch_nr, 'data_lineage', 1 FROM b""")
