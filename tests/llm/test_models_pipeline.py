"""Held-out accuracy of the trained models, and the pipeline's stages on a small table."""
import hashlib
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from urbanlens.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def odd_rows(rows):
    return rows([(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " 12 !? ", None, "s", 0), (None, "word " * 50_000, "de", "s", 0), (4, "the and of", "en", "s", 0), (4, "the and of", "en", "s", 0)], DOCS)


def test_language_accuracy(spark, rows, tables):
    docs, _ = tables
    net = langid.train(docs, docs_per_language=400)
    found = langid.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 3000 and right / n > 0.98
    odd = langid.identify(odd_rows(rows), net).collect()
    assert sorted((r.doc_id or 0, r.lang_pred == "und", r.score == 0) for r in odd) == [(0, False, False), (1, True, True), (2, True, True), (3, True, True), (4, False, False), (4, False, False)]
    assert all(r.held_out for r in odd if r.doc_id is None) and all(0 <= r.score <= 1 for r in odd)
    assert langid.train(odd_rows(rows).filter("false")) is None
    assert {r.lang_pred for r in langid.identify(odd_rows(rows), None).collect()} == {"und"}


def test_toxicity_accuracy(spark, rows, tables):
    docs, labels = tables
    net = toxicity.train(docs, labels)
    found = toxicity.score(docs, net).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in found)
    assert len(found) > 1000 and hit / sum(r.toxic for r in found) > 0.8 and hit / sum(r.predicted for r in found) > 0.85
    odd = toxicity.score(odd_rows(rows), net).collect()
    assert len(odd) == 6 and all(0 <= r.score <= 1 for r in odd) and all(r.score == 0 for r in odd if r.doc_id in (1, 2))
    assert toxicity.remove_toxic(odd_rows(rows), net).columns == odd_rows(rows).columns
    none = labels.filter("toxic = 0").withColumn("toxic", F.when(F.col("doc_id") > 5, 0))
    assert toxicity.train(docs, none) is None
    assert {r.score for r in toxicity.score(odd_rows(rows), None).collect()} == {0.0}
    assert toxicity.score(odd_rows(rows).filter("false"), net).count() == 0


def test_every_operator_has_a_query():
    names = queries.registry()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def test_stages(spark, rows, tmp_path):
    """Planted cases go through the stages after the classifier: copies, long passages, leaks; clean documents stay as they are."""
    rnd = random.Random(9)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    item, passage = prose(30), prose(90)
    clean = [(i, prose(rnd.randint(1, 300))) for i in range(10)]
    copies = [(20, clean[3][1]), (21, clean[4][1]), (22, clean[4][1])]
    shared = [(30, prose(200) + " " + passage + " " + prose(50)), (31, passage + " " + prose(300))]
    leaked = [(40, prose(100) + " " + item + " " + prose(100)), (41, item.upper())]
    odd = [(50, None), (51, ""), (None, "no id " + prose(20))]
    data = clean + copies + shared + leaked + odd
    docs = rows([(i, t, "en", "s", len(t or "")) for i, t in data], DOCS)
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "repeats", "decontamination", "tokens"]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        docs = out
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    kept = {r.doc_id: (r.text, r.n_chars) for r in docs.collect()}
    assert {i for i in kept if i is not None} == {i for i, _ in clean} | {30, 31, 50}  # 51 is a copy of 50: both are empty
    assert all(kept[i] == (t, len(t)) for i, t in clean)
    assert None in kept and all(passage not in (t or "") for t, _ in kept.values())
    tokens = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()
    assert len(tokens) == len(kept)
    for r in tokens:
        assert hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in r.token_ids)).hexdigest() == r.ids_sha256 and len(r.token_ids) == r.n_tokens


def test_toxicity_learns_from_every_labelled_row(spark, rows, monkeypatch):
    """All labelled rows count that are not held out, however many and however long; the shards' files and order change nothing."""
    rnd = random.Random(4)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    data = [(i, " ".join(rnd.choices(plain, k=20) + (["vilest"] if i % 2 else [])), "en", "s", 0) for i in range(300)]
    # a word of no other texts than those that a bound on rows or on length drops
    data += [(i, "rarely " * 30_000 + f"n{i}" if i > 303 else "rarely " + " ".join(rnd.choices(plain, k=20)), "en", "s", 0) for i in range(300, 330)]
    docs = rows(data, DOCS)
    labels = spark.createDataFrame([(d[0], d[0] % 2 if d[0] < 300 else 1) for d in data], "doc_id long, toxic int")
    learned = docs.filter("crc32(cast(doc_id as string)) % 3 != 1")
    totals = []
    seen = toxicity._seen

    def counted(part):
        out = seen(part)
        totals.append(out)
        return out
    monkeypatch.setattr(toxicity, "_seen", counted)
    monkeypatch.setattr(toxicity, "SHARD", 64)
    found = []
    raw = toxicity._raw_scores
    monkeypatch.setattr(toxicity, "_raw_scores", lambda *a: found.append(raw(*a)) or found[-1])
    net = toxicity.train(docs, labels)
    (features, total), = totals
    fitted = learned.filter("crc32(text) % 4 != 0")
    assert total.sum() == fitted.count() and total.sum() + sum(found[0].values()) == learned.count()
    assert features[1, toxicity.features("rarely")[0]] == fitted.filter("text like '%rarely%'").count() > 0
    again = toxicity.train(docs.repartition(5).unionByName(docs.limit(40)), labels.repartition(3))
    assert all((a == b).all() for a, b in zip(net.parameters, again.parameters, strict=True)) and found[0] == found[1]
    assert (net.scale, net.shift, net.thresholds) == (again.scale, again.shift, again.thresholds)


def test_toxicity_words_found_at_once(monkeypatch):
    """Words found and hashed for many texts at once are those of one text at a time, numbered as they come up."""
    rnd = random.Random(7)
    signs = [range(32, 127), range(0xA0, 0x250), range(0x370, 0x500), range(0x4E00, 0x9000), range(0x10000, 0x12000), [10, 32, 32, 95]]
    texts = ["", " ", "\n", "a\nb\n", "İstanbul ΑΣ ΑΣ. ΟΔΟΣ\nΣ", "1.5 ²³ ½ ٣٤", "abcd abcde abcdef abcdefg abcdefgh", "a\0b", "é é ß ẞ",
             *("x" * n + " " + "é" * n + " " + "漢" * n for n in (*range(1, 9), 21, 22, 31, 32, 33, 63, 64, 65, 500))]
    texts += ["".join(chr(rnd.choice(rnd.choice(signs))) for _ in range(rnd.randrange(300))) for _ in range(300)]
    number, feats = {"": 0}, [(0,) * (1 + len(toxicity.BEGINNINGS))]
    for w in (w for t in texts for w in toxicity.text_words(t)):
        if w not in number:
            number[w] = len(number)
            feats.append(toxicity.features(w))
    expected = [[number[w] for w in toxicity.text_words(t)] for t in texts]
    for at_once in (1 << 20, 500):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        docs, found = toxicity.numbered(texts)
        assert [d.tolist() for d in docs] == expected and [tuple(f) for f in found.tolist()] == feats
    docs, found = toxicity.numbered([""])
    assert [d.tolist() for d in docs] == [[]] and found.tolist() == [[0] * len(feats[0])]


def test_toxicity_passes_read_numbers(spark, rows, monkeypatch):
    """Texts are taken apart once: what the passes over the rows read holds none, but every labelled row."""
    data = [(i, "some plain words here" + (" vilest" if i % 2 else "") + f" n{i}", "en", "s", 0) for i in range(300)]
    docs = rows(data, DOCS)
    labels = spark.createDataFrame([(d[0], d[0] % 2) for d in data], "doc_id long, toxic int")
    read = []
    for name in ("_seen", "_pass", "_raw_scores"):
        def reading(part, *a, own=getattr(toxicity, name)):
            read.append(part.collect())
            return own(part, *a)
        monkeypatch.setattr(toxicity, name, reading)
    assert toxicity.train(docs, labels) is not None and len(read) == 2 + toxicity.PASSES
    n = docs.filter("crc32(cast(doc_id as string)) % 3 != 1").count()
    for chunk in read:
        assert sum(len(c[5]) for c in chunk) == n and not any(isinstance(v, str) and "words" in v for c in chunk for v in c)


def passes_of(run, spark, rows, path, monkeypatch):
    """Numbers of the passes that ``run`` makes over the labelled rows of tables below ``path``, dealt into some twenty shards, and what it returns."""
    data = [(i, "some plain words here" + (" vilest" if i % 2 else "") + f" n{i}", "en", "s", 0) for i in range(450)]
    rows(data, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d[0], d[0] % 2) for d in data], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    passed, own = [], toxicity._pass
    monkeypatch.setattr(toxicity, "SHARD", 16)
    monkeypatch.setattr(toxicity, "_pass", lambda found, net, number: passed.append(number) or own(found, net, number))
    out = run()
    return passed, out


def test_toxicity_large_tables_get_every_pass(spark, rows, tmp_path, monkeypatch):
    """As many passes over the rows of many shards as over those of one."""
    passed, out = passes_of(lambda: queries.registry()["op1_toxicity"](spark, str(tmp_path)), spark, rows, tmp_path, monkeypatch)
    assert passed == list(range(6)) and out.count() == 450


def test_pipeline_large_tables_get_every_pass(spark, rows, tmp_path, monkeypatch):
    """So does the pipeline's first stage, and what it drops is toxic."""
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    passed, out = passes_of(lambda: stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)), spark, rows, tmp_path, monkeypatch)
    assert passed == list(range(6)) and [r.doc_id for r in out.sort("doc_id").collect()] == list(range(0, 450, 2))


def test_toxicity_numbers_come_back():
    """Numbers of words beyond 16 bits are those before they were stored."""
    words = [f"w{i}" for i in range(70_000)]
    texts = [" ".join(words), "w69999 w0 w65535", ""]
    (docs, feats, y, langs), = toxicity.chunks([toxicity._pack(0, 0, [Row(text=t, y=1, lang=None) for t in texts])], 0)
    expected, found = toxicity.numbered(texts)
    assert [d.tolist() for d in docs] == [d.tolist() for d in expected] and (feats == found).all() and len(feats) == 70_001
