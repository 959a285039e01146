"""Operators on texts against brute-force versions of the same definitions."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from urbanlens.llm import bpe, decontam, repeats, simhash, sketch
from urbanlens.llm.run_index import RunIndex

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(rows, data):
    return rows([(i, t, None, "s", len(t or "")) for i, t in data], DOCS)


def prose(rnd, n, words="alpha beta gamma delta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau phi chi psi".split()):
    return " ".join(rnd.choice(words) + rnd.choice(["", "", "", ","]) for _ in range(n))


# --- byte-pair encoding

ODD = ["", "   ", "ΑΣ Σ ΣΑΣ", "İstanbul ǅ ﬁ", "it's I'LL we'Ve <|endoftext|> a<|startoftext|>b", "\x1c\x1d a​b", "é é ́a 가", "日本語 123 ½ Ⅳ ²", "😀 👩‍👩 #$%", "a" * 5000, "\x00\x7f\x80", "ß ẞ", "'s's''S 'D", "x y\x85z", "word," * 300]


def test_bpe_equals_the_library(spark, rows):
    from tokenizers import Tokenizer
    library, rnd = Tokenizer.from_file(VOCABULARY), random.Random(1)
    pool = "aAbB'sStT \n\t éÉΣσ́İı1²½😀<|>_-$ ​\x85"
    texts = [*ODD, *("".join(rnd.choice(pool) for _ in range(rnd.randint(1, 40))) for _ in range(1500)), None, ODD[3]]
    got = {r.doc_id: r for r in bpe.digests(docs_of(rows, list(enumerate(texts))), VOCABULARY).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest()), t
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_columns_and_empty(spark, rows):
    df = docs_of(rows, [(1, "some text"), (2, None)])
    out = df.select(bpe.encode_column(VOCABULARY, df.text).alias("ids"))
    got = [r.text for r in out.select(bpe.decode_column(VOCABULARY, out.ids).alias("text")).collect()]
    assert sorted(got) == ["", "some</w> text</w>"]
    assert [len(r.token_ids) for r in bpe.tokenize(df, VOCABULARY, keep=["source"]).orderBy("doc_id").collect()] == [2, 0]
    assert bpe.digests(docs_of(rows, []), VOCABULARY).count() == 0


def test_decoded_digest_is_of_the_ids(monkeypatch):
    model, text = bpe.WordBPE(VOCABULARY), "some text and some more words " * 30
    ids = model.packed(text)
    want = hashlib.sha256(model.decode(model.encode(text)).encode()).hexdigest()
    assert model.digests(ids) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), want)
    monkeypatch.setattr(bpe, "_DECODED", 7)
    assert model.digests(ids)[2] == want and model.digests(b"")[2] == hashlib.sha256(b"").hexdigest()
    other = ids[:-4] + model.packed("other")[:4]  # a fault in the ids shows, and one in decoding too
    assert model.digests(other)[2] != want
    model.spelled[model.encode("some")[0]] = b" ?"
    assert model.digests(model.packed(text))[2] != want


# --- SimHash

def fingerprint(text, k=3):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(codes, distance):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def test_simhash_groups(spark, rows):
    rnd = random.Random(2)
    texts = [None, "", " \t", "One", "one", "one two", "ÀB c d", "àb c d", "a b c d\x1ce"]
    for _ in range(25):
        base = prose(rnd, rnd.randint(5, 1500)).split()
        texts.append(" ".join(base))
        for _ in range(rnd.randint(0, 3)):
            copy = base[:]
            copy[rnd.randrange(len(copy))] = "new"
            texts.append(" ".join(copy))
    texts += texts[:20]
    codes = [fingerprint(t) for t in texts]
    roots = groups(codes, 2)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(rows, list(enumerate(texts)))).collect()}
    assert [got[i].code & (1 << 64) - 1 for i in range(len(texts))] == codes
    assert [got[i].component_id for i in range(len(texts))] == roots
    kept = simhash.deduplicate(docs_of(rows, list(enumerate(texts))))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots)) and kept.columns == docs_of(rows, []).columns


@pytest.mark.parametrize("node_size", [3, 2048])
def test_simhash_links_of_a_dense_node(spark, node_size):
    rnd = random.Random(3)
    center = rnd.getrandbits(64)
    codes = {center ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(400)} | {rnd.getrandbits(64) for _ in range(200)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
    got = simhash.links(spark.createDataFrame([(c,) for c in signed], "code long"), node_size=node_size).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_simhash_odd_ids(spark, rows):
    data = [(1, "x y z w"), (1, "x y z w"), (None, "x y z w"), (None, "q r s t"), (None, "q r s t"), (5, "k l m n o")]
    kept = simhash.deduplicate(docs_of(rows, data)).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in kept) == sorted(repr(x) for x in [(1, "x y z w"), (None, "q r s t"), (5, "k l m n o")])
    assert simhash.near_duplicates(docs_of(rows, [])).count() == 0 and simhash.deduplicate(docs_of(rows, [])).count() == 0


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 1 << 63, 70_001).astype(np.uint64) << np.uint64(1)
    assert simhash.bit_counts(h).tolist() == [int(((h >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


# --- benchmark decontamination

def contained(docs, items, threshold=0.8, k=5):
    def shingles(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    out = []
    own = [(i, shingles(t)) for i, t in items]
    for d, t in docs:
        s = shingles(t)
        out += [(d, i, len(q & s), len(q)) for i, q in own if q and len(q & s) / len(q) >= threshold]
    return out


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, 0])
def test_contained_items(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)
    rnd = random.Random(4)
    items = [(i, prose(rnd, rnd.choice([1, 3, 5, 6, 12, 40, 90]))) for i in range(40)] + [(40, None), (41, ""), (42, " ... "), (None, "x")]
    items.append((43, items[3][1]))
    docs = [(0, None), (1, ""), (2, items[0][1])]
    for d in range(3, 80):
        text = prose(rnd, rnd.randint(0, 300))
        for _ in range(rnd.randint(0, 2)):
            w = (items[rnd.randrange(40)][1]).split()
            for _ in range(rnd.choice([0, 0, 1, 2])):
                w[rnd.randrange(len(w))] = "other"
            text += " " + " ".join(w).upper().replace(",", " ;") + " " + prose(rnd, rnd.randint(0, 50))
        docs.append((d if d % 9 else None, text))
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_contained(docs_of(rows, docs), item_rows).collect()
    want = contained(docs, [x for x in items if x[0] is not None])
    assert sorted(repr((r.doc_id, r.item_id, r.n_shared, r.n_item)) for r in got) == sorted(map(repr, want)) and len(want) > 20
    clean = decontam.remove_contaminated(docs_of(rows, [*docs, *docs]), item_rows)
    bad = {t for (i, t) in docs if contained([(i, t)], [x for x in items if x[0] is not None])}
    assert sorted(repr((r.doc_id, r.text)) for r in clean.collect()) == sorted(repr(x) for x in [*docs, *docs] if x[1] not in bad)


def test_contained_empty(spark, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    one = docs_of(rows, [(1, "a b c")])
    assert decontam.find_contained(one, none).count() == 0 and decontam.remove_contaminated(one, none).count() == 1
    assert decontam.find_contained(docs_of(rows, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0


def test_short_items_inside_long_texts(spark, rows, tmp_path):
    rnd = random.Random(13)
    items = [(1, "Zebra, yak; wombat!"), (2, "quokka"), (3, "one two three four"), (4, prose(rnd, 20)), (5, None)]
    texts = [f"{prose(rnd, 400)} zebra yak wombat {prose(rnd, 100)}", f"zebra yak {prose(rnd, 30)} wombat", "the quokka", "quokka", f"{prose(rnd, 9)} one two three four",
             "two three four one", "zebra YAK wombat", f"x {items[3][1]} y", None, "", "one two three four five"]
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows, list(enumerate(texts)))
    found = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in decontam.find_contained(docs, item_rows, short_runs=True).collect()}
    q = len({tuple(items[3][1].replace(",", "").split()[i:i + 5]) for i in range(16)})
    assert found == {(0, 1, 1, 1), (2, 2, 1, 1), (3, 2, 1, 1), (4, 3, 1, 1), (6, 1, 1, 1), (7, 4, q, q), (10, 3, 1, 1)}
    item_rows.write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in kept} == {1, 5, 8, 9}


def test_common_phrase_joins_no_pairs(spark, rows, monkeypatch):
    """A phrase that all items and documents hold brings none of them together."""
    rnd = random.Random(12)

    def own(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    phrase = "read the following and answer"
    items = [(i, f"{phrase} {own(30)}") for i in range(50)]
    docs = [(d, f"{own(20)} {phrase} {own(20)}") for d in range(60)] + [(99, f"{own(5)} {items[7][1]} {own(5)}")]
    sizes = {}

    def counted(df, name):
        out = materialize(df, name)
        sizes[name] = out.count()
        return out
    materialize = decontam.materialize
    monkeypatch.setattr(decontam, "materialize", counted)
    read = []
    join = type(docs_of(rows, docs)).join

    def counting(self, *args, **options):
        out = join(self, *args, **options)
        if {"id", "text_hash", "item_id", "hash"} <= set(out.columns):
            read.append(out.count())
        return out
    monkeypatch.setattr(type(docs_of(rows, docs)), "join", counting)
    found = decontam.find_contained(docs_of(rows, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.containment) for r in found] == [(99, 7, 1.0)]
    assert sizes["decontam-hits"] >= 61 and max(read) < 100  # not 61 documents x 50 items


# --- sketches

def sketch_by_hand(hashes):
    """The definition: all distinct hashes below the fraction, and the smallest ones if these are too few."""
    distinct = sorted(set(hashes))
    below = [h for h in distinct if h < (1 << 62) // sketch.SCALE]
    if len(below) >= sketch.FLOOR:
        return (1 << 62) // sketch.SCALE, below
    few = distinct[:sketch.FLOOR]
    return few[-1] + 1 if len(distinct) > sketch.FLOOR else 1 << 62, few


def likeness(a, b):
    """Containment from two fingerprints' strings alone."""
    (la, x), (lb, y) = ((int(f.split(":")[0]), {int(h) for h in f.split(":")[1].split(",") if h}) for f in (a, b))
    if not x and not y:
        return 1.0
    x = {h for h in x if h < min(la, lb)}
    return len(x & y) / len(x) if x else 0.0


def all_hashes(spark, texts):
    from urbanlens.llm.common import shingle_hashes, words
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", shingle_hashes(words(F.col("t")), 5).alias("h"))
    return {texts[r.i]: [(h % (1 << 64)) >> 2 for h in r.h] for r in df.collect()}


def test_sketches_of_edits(spark, rows):
    rnd = random.Random(5)
    texts = [None, "", "one", "ünï çödé 😀 text", *(prose(rnd, rnd.choice([3, 30, 300, 3000, 9000])) for _ in range(14)), "same " * 3000, "same " * 30]
    texts.append(texts[-3])
    data = [(3 * i + 1, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in sketch.compare_with_edits(docs_of(rows, data)).collect()}
    assert len(got) == len(data)
    edits = {}
    for k, (i, t) in enumerate(data):
        t, following = t or "", data[(k + 1) % len(data)][1] or ""
        edits[i] = (t, t[:len(t) - len(t) // 2] + following[:len(t) // 2], following)
    hashes = all_hashes(spark, sorted({x for e in edits.values() for x in e}))
    written = {t: "{}:{}".format(limit, ",".join(map(str, kept))) for t, h in hashes.items() for limit, kept in [sketch_by_hand(h)]}
    for i, (t, edited, following) in edits.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (written[t], written[edited])
        assert r.near_edited == likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == likeness(written[t], written[following])
        a, b = set(hashes[t]), set(hashes[edited])
        exact = len(a & b) / len(a) if a else float(not b)
        assert abs(r.near_edited - exact) <= (0.25 if len(a | b) > sketch.FLOOR else 0.0)


def test_sketch_odd_ids_and_merge(spark, rows):
    out = sketch.compare_with_edits(docs_of(rows, [(None, "a b"), (2, "c d"), (2, "e f"), (7, "g h")])).collect()
    want = {(None, "a "): "c d", (2, "c "): "g h", (2, "e "): "g h", (7, "g "): "a b"}
    edits = {hashlib.sha256(f"{k[1][:2]}{v[:1]}".encode()).hexdigest() for k, v in want.items()}
    assert len(out) == 4 and {r.edited_sha256 for r in out} == edits
    assert sketch.compare_with_edits(docs_of(rows, [(5, "abcd")])).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert sketch.compare_with_edits(docs_of(rows, [])).count() == 0


def test_merged_sketches_are_those_of_the_union(spark):
    rnd = random.Random(6)
    parts = [(1, prose(rnd, 900)), (1, prose(rnd, 60)), (2, ""), (3, prose(rnd, 40)), (3, prose(rnd, 20)), (4, prose(rnd, 9000)), (4, prose(rnd, 7000)), (5, prose(rnd, 9000)), (5, "a b c d e f")]
    hashes = all_hashes(spark, [t for _, t in parts])
    df = spark.createDataFrame(parts, "k long, text string").select("k", sketch.sketch(F.col("text")).alias("sketch"))
    merged = {r.k: (r.sketch.limit, r.sketch.hashes) for r in sketch.merge_sketches(df, "k").collect()}
    for k in {k for k, _ in parts}:
        assert merged[k] == sketch_by_hand([h for j, t in parts if j == k for h in hashes[t]])


def test_sketch_of_a_short_text_in_a_long_one(spark, rows):
    rnd = random.Random(11)

    def text(n):
        return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    data = []
    for i in range(24):
        short = text(200 if i < 12 else 400)
        data += [(2 * i, short), (2 * i + 1, f"{text(700)} {short if i % 2 else ''} {text(700)}")]
    data += [(100, text(40)), (101, ""), (102, None)]
    got = {r.doc_id: r for r in sketch.compare_with_edits(docs_of(rows, data)).collect()}
    assert [got[2 * i].near_next for i in range(24)] == [float(i % 2) for i in range(24)]
    assert got[100].near_next == got[101].near_edited * 0 == 0.0 and got[101].near_next == 1.0
    assert all(r[c] is not None and 0 <= r[c] <= 1 for r in got.values() for c in ("near_edited", "near_next", "jaccard_edited", "jaccard_next"))


# --- repeats

def brute(texts, least):
    seen = Counter(t[i:i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - least + 1):
            if seen[t[i:i + least]] > 1:
                gone[i:i + least] = True
        edge = np.diff(np.r_[0, gone.astype(int), 0])
        out.append((int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest(), edge))
    return out


def test_run_index():
    rnd = random.Random(7)
    for _ in range(60):
        alphabet = rnd.choice([b"ab", b"\0a", b"abcdefgh\xff\xfe\0", bytes(range(256))])
        base = bytes(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))
        strings = [base[a:a + rnd.randint(0, 200)] * rnd.choice([1, 1, 2]) for a in (rnd.randint(0, 300) for _ in range(rnd.randint(1, 10)))]
        least = rnd.choice([3, 8, 17, 40])
        got = sorted(zip(*(x.tolist() for x in RunIndex(strings).long_matches(least)), strict=True))
        want = [(k, int(a), int(b)) for k, (*_, edge) in enumerate(brute(strings, least)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
        assert got == sorted(want)


def repeated_texts(rnd):
    def noise(n):
        return "".join(rnd.choice("abcdéfgh  ") for _ in range(n))
    line, passage, texts = noise(260), noise(700), []
    for _ in range(90):
        r, t = rnd.random(), noise(rnd.randint(0, 500))
        if r < 0.5:
            t += line + noise(rnd.randint(0, 400))
        if r < 0.2:
            t += passage[rnd.randint(0, 250):rnd.randint(300, 700)] + noise(50)
        if 0.5 < r < 0.7:
            changed = list(passage)
            changed[rnd.randrange(700)] = "#"
            t += "".join(changed) + noise(20)
        if 0.7 < r < 0.8 and texts:
            t = rnd.choice(texts)
        if 0.8 < r < 0.85:
            t += ("xyz" * 500)[:rnd.randint(300, 1500)]
        texts.append(None if r > 0.97 else t)
    return texts


@pytest.mark.parametrize("most", [2, 6, repeats.MOST])
def test_repeats(spark, rows, monkeypatch, most):
    rnd = random.Random(most)
    data = [(i if rnd.random() < 0.9 else None, t) for i, t in enumerate(repeated_texts(rnd))]
    data += [data[3], data[3]]
    whole = repeats.repeated_spans
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, least: whole(d, least, most=most))
    got = repeats.removal_digests(docs_of(rows, data), least=400).collect()
    want = [(i, len((t or "").encode()), *x[:3]) for (i, t), x in zip(data, brute([(t or "").encode() for _, t in data], 400), strict=True)]
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, want)) and sum(w[2] for w in want) > 10_000
    short = brute([(t or "").encode() for _, t in data], 256)
    want = [(i, hashlib.sha256((t or "").encode()).hexdigest() if not x[0] else "cut", len((t or "").encode()) - x[0]) for (i, t), x in zip(data, short, strict=True)]
    assert sorted(repr((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest() if r.n_kept == r.n_bytes else "cut", r.n_kept)) for r in got) == sorted(map(repr, want))


def test_anchors_in_pieces(spark, rows, monkeypatch):
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(30_000))
    data = [(1, long), (2, long[9_000:9_700] + "x"), (3, "y" + long[29_500:])]
    whole = repeats.removal_digests(docs_of(rows, data)).orderBy("doc_id").collect()
    monkeypatch.setattr(repeats, "_PIECE", 4096)
    table = repeats.anchor_table(docs_of(rows, data).selectExpr("doc_id", "xxhash64(text) AS text_hash", "text"), 400, 128).collect()
    assert len({(r.doc_id, r["at"]) for r in table}) == len(table)
    assert [r.n_removed for r in whole] == [1200, 700, 500]


def test_remove_repeats(spark, rows):
    same = "é" * 250  # 500 bytes
    df = docs_of(rows, [(1, "a" + same + "b"), (2, same), (3, None), (None, "short")])
    out = {r.doc_id: r.text for r in repeats.remove_repeats(df).collect()}
    assert out == {1: "ab", 2: "", 3: None, None: "short"} and repeats.remove_repeats(df).columns == df.columns
    assert repeats.removal_digests(docs_of(rows, [])).count() == 0


def test_repeated_passages_of_short_words(spark, rows):
    rnd = random.Random(9)
    short = [a + b for a in "abcdefgh" for b in "aeiou"] + ["the", "and", "for", "ünd"]

    def passage(n):
        return " ".join(rnd.choice(short) for _ in range(n))

    def noise(n):
        return " ".join("".join(rnd.choice("klmnopqrst") for _ in range(9)) for _ in range(n))
    shared, fifty = passage(51), passage(50)
    assert 101 <= len(shared.encode()) < 256
    texts = [f"{noise(40)} {shared} {noise(30)}", f"{noise(3)} ({shared}, {noise(60)}", f"{noise(20)} {fifty} {noise(20)}", f"{fifty} {noise(9)}", "\u3000".join(["ab"] * 52), None, ""]
    df = docs_of(rows, list(enumerate(texts)))
    out = {r.doc_id: r.text for r in repeats.remove_repeats(df, least=256, words=51).collect()}
    assert out[0] == texts[0].replace(shared, "") and out[1] == texts[1].replace(shared, "")
    assert (out[2], out[3]) == (texts[2], texts[3])  # fifty words are not more than fifty
    assert out[4] == "" and out[5] is None and out[6] == ""
    stage = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, df, "").collect()}
    assert stage == out


def test_short_passages_against_brute_force():
    rnd = random.Random(10)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "é", "(b", "c.", "--", "—", "longerword", " ", " ", " ", "\xa0", "\u2003 ", "\n"]) for _ in range(rnd.randint(0, 60)))
        found = [(m.start(), m.end()) for m in re.finditer(r"\S+", text) if re.search(r"\w", m[0])]
        want = set()
        for (a, b), (c, d) in zip(found, found[3:]):
            heads, tails = {a, a + re.search(r"\w", text[a:b]).start()}, {d, c + max(m.end() for m in re.finditer(r"\w", text[c:d]))}
            want |= {(len(text[:x].encode()), len(text[:y].encode())) for x in heads for y in tails if len(text[x:y].encode()) < 14}
        got = list(repeats.short_passages(text.encode(), 4, 14))
        assert sorted(got) == sorted(want)
