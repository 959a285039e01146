"""Hard negatives, prefix trie and personal data against brute-force versions of the same definitions."""
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlens.llm import negatives, pii, queries, trie

VECTORS = "vec_id long, embedding array<float>, label int"


# --- hard negatives

def mined(data, anchor, positives=5, n=3):
    rows = {}
    for i, v, label in data:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        rows[i] = min(rows.get(i, q), q)
    out = []
    for a in filter(anchor, rows):
        label, v = rows[a]
        others = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in rows.items() if i != a)
        for p, pid, _ in [o for o in others if o[2]][:positives]:
            fit = [o for o in others if not o[2] and 50 * -p <= 100 * -o[0] <= 95 * -p][:n]
            out += [(a, pid, k, i, -p, -s) for k, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(rnd, n, dim, common=()):
    out = []
    for i in range(n):
        v = list(common) if common and rnd.random() < 0.35 else [rnd.uniform(-1, 1) for _ in range(dim)]
        out.append((i, v, 0 if rnd.random() < 0.4 else rnd.randint(0, 4)))
    return out


@pytest.mark.parametrize("case", ["spread", "hot", "coarse", "odd", "large"])
def test_hard_negatives_equal_brute_force(spark, rows, case):
    rnd = random.Random(case)
    data = vectors(rnd, 300, 6, [0.5] * 6 if case == "hot" else ())
    if case == "coarse":  # few different scores: most are ties, many are zero
        data = [(i, [rnd.choice([0.0, 0.004, 0.008]) for _ in range(3)], c) for i, _, c in data]
    if case == "large":
        data = [(i, [x * 400 for x in v], c) for i, v, c in data]
    if case == "odd":
        data += [(300, None, 1), (301, [None] * 6, 1), (302, [math.nan] * 6, 1), (303, [math.inf, *[0.0] * 5], 1), (304, [0.5] * 6, None), (None, [0.5] * 6, 1),
                 (310, [], 1), (311, [0.5, 0.25], 0), (320, [0.1] * 6, 1), (320, [0.9] * 6, 0), (-10, [0.7] * 6, 1), *data[:20], *data[:3]]
    got = negatives.mine(rows(data, VECTORS), F.col("vec_id") % 10 == 0)
    want = mined(data, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and want
    assert [c.split(":")[0] for c in got.columns] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_empty(spark, rows):
    assert negatives.mine(rows([], VECTORS), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(rows([(10, [1.0], 0), (1, [1.0], 1)], VECTORS), F.col("vec_id") % 10 == 0).count() == 0


def test_best_breaks_ties_to_the_left_at_any_size():
    rng = np.random.default_rng(3)
    for scale in (1, 1 << 58):
        scores = rng.integers(-3, 4, (20, 50)) * scale
        wanted = rng.random((20, 50)) < 0.5
        got = defaultdict(list)
        for r, c, s in negatives.best(scores, wanted, 4):
            got[r].append((-s, c))
        for r in range(20):
            assert sorted(got[r]) == sorted((-int(scores[r, c]), c) for c in np.flatnonzero(wanted[r]))[:4]


# --- conversation prefix trie

TURNS = "conv_id long, turn long, role string, text string"


def trie_of(data, rebuild=False):
    """All prefixes of all conversations, by hand."""
    own = defaultdict(list)
    for c, turn, role, text in data:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - c % 5, [])[:h[c]] + v[h[c]:] for c, v in convs.items()}
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in members[p] if len(convs[c]) == len(p)))).encode()).hexdigest()
    return sorted((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children.get(p, 0), leaves[p], saved[p], digest(p)) for p, who in members.items())


def talk(rnd, c, prefix=(), more=4, pool=3):
    turns = [*prefix, *((rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bb", "é", None, "ccc"][:pool])) for _ in range(rnd.randint(0, more)))]
    return [(c, i if i else None, r, t) for i, (r, t) in enumerate(turns)]


@pytest.mark.parametrize("case", ["small", "hot", "long"])
def test_prefix_trie_equals_brute_force(spark, rows, case):
    rnd = random.Random(case)
    data = [r for c in range(120) for r in talk(rnd, c, more=6)]
    if case == "hot":  # a third of the conversations are copies, a third begin alike
        same = [("user", "hello"), ("assistant", "hi there"), ("user", "bye")]
        data += [(c, i, *t) for c in range(200, 280) for i, t in enumerate(same)] + [r for c in range(300, 380) for r in talk(rnd, c, same[:2], 3, 5)]
        data += [(None, 0, "user", "no id"), *data[:9], (-4, None, None, None), (-4, None, "user", ""), (-9, 1, "user", "x" * 50_000)]
    if case == "long":
        path = [("user", str(i % 7)) for i in range(300)]
        data = [(c, i, *t) for c in range(40) for i, t in enumerate(path[:rnd.randint(1, 300)] + [("user", str(rnd.randint(0, 2)))] * rnd.randint(0, 2))]
    turns = materialized(trie.numbered_turns(rows(data, TURNS)))
    got = trie.prefix_nodes(turns, turns.select("conv_id"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(trie_of(data), key=str)


def materialized(df):
    from urbanlens.llm.common import materialize
    return materialize(df, "test")


def test_rebuilt_conversations(spark, rows):
    rnd = random.Random(5)
    data = [r for c in rnd.sample(range(200), 90) for r in (talk(rnd, c, more=9, pool=5) or [(c, 1, "user", "x")])]
    got = trie.prefix_nodes(*queries.rebuilt_turns(rows(data, TURNS)), batches=(0.2, 0.5, 0.7, 1))
    want = trie_of(data, rebuild=True)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    ends = {r[7] for r in want if r[1] == 0}
    assert ends != {hashlib.sha256(b"").hexdigest()}  # some have no turns


def test_trie_without_turns(spark, rows):
    none = trie.numbered_turns(rows([], TURNS))
    assert trie.prefix_nodes(none, none.select("conv_id")).count() == 0
    ids = rows([(7,), (3,), (3,)], "conv_id long")
    assert [tuple(r) for r in trie.prefix_nodes(none, ids).collect()] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,7").hexdigest())]


def test_fat_search_finds_every_exit(spark, rows):
    """Paths of one half are searched in the trie of the other: as many turns are found as the best of the others shares."""
    rnd = random.Random(2)
    path = [("user", str(i % 5)) for i in range(60)]
    data = [(c, i, *t) for c in range(60) for i, t in enumerate(path[:rnd.randint(1, 60)] + [("user", rnd.choice("012"))] * rnd.randint(0, 3))]
    paths = materialized(trie.paths(trie.numbered_turns(rows(data, TURNS))))
    sizes = materialized(paths.groupBy(F.col("conv_id").alias("rep")).agg(F.max("d").alias("n")))
    edges = trie.insert(sizes.filter("rep % 2 = 0"), None, paths, 64)
    out = {r.rep: (r.x, r.edge) for r in trie.exits(sizes.filter("rep % 2 = 1"), edges, paths, 64).collect()}
    seqs = defaultdict(list)
    for c, _, r, t in data:
        seqs[c].append((r, t))
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    nodes = {r.d for r in edges.select("key.d").collect()}
    for c in range(1, 60, 2):
        assert out[c][0] == max(shared(seqs[c], seqs[o]) for o in range(0, 60, 2))
        assert out[c][1] is None or out[c][1].d > out[c][0] and out[c][0] > 0
    assert len(nodes) > 10
    pairs = spark.createDataFrame([(a, b) for a in range(70) for b in range(a + 1, 90)], "a long, b long")
    for r in pairs.select("a", "b", trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x)


# --- personal data

DOCS = "doc_id long, text string"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def by_patterns(text):
    """The base spans as the patterns say it."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(x) for x in m[0] if x in "0123456789"]
            doubled = [x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(digits))]
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or \
                    kind == "card" and 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0 or kind == "phone" and 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(4)
    found = defaultdict(int)
    for _ in range(60_000):
        t = "".join(rnd.choice(["1", "25", "4", "0", "-", " ", ".", "+", "@", "a.b", "(", ")", "é", "4111111111111111", "x", "@h.c", "+1 (222) 55", "10.256.3", ".7.8", "1.2"]) for _ in range(rnd.randint(1, 14)))
        want = by_patterns(t)
        assert pii.base_spans(t) == want, t
        for _, k, _ in want:
            found[k] += 1
    assert len(found) == 4 and min(found.values()) > 300
    for t in ("", "1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 100_000, "1 " * 200_000, "é😀a@b.c é", "x@y.z@y.z@y.z"):
        assert pii.base_spans(t) == by_patterns(t) if len(t) < 50 else pii.base_spans(t) is not None


def test_windows_cover_every_trigger():
    rnd = random.Random(6)
    for _ in range(300):
        t = "".join(rnd.choice("aaaaaaaaaaaaaaaaaaa 1@") if rnd.random() < 0.1 else "a" for _ in range(rnd.randint(0, 700)))
        starts = list(pii.window_starts(t))
        half = pii.WINDOW // 2
        want = [s for s in range(0, max(1, len(t) - half), half) if re.search("[0-9@]", t[s:s + pii.WINDOW])]
        assert starts == want, (t, starts, want)


def test_reconciled_takes_the_best_set():
    text = "on 10.20.30.40 and 4111 1111 1111 1111 or 988 555 2485 x"
    ip, card, phone = text.index("10."), text.index("4111"), text.index("988")
    found = [(ip, 1, ip + 11, 0.95), (ip, 1, ip + 11, 0.9), (card, 2, card + 19, 0.9), (card + 5, 3, card + 19, 0.85), (phone, 3, phone + 12, 0.99), (phone, 3, phone + 12, 0.5), (0, 0, 5, 0.99)]
    assert pii.reconciled(text, found, []) == [(ip, 1, ip + 11, 0.95), (card, 2, card + 19, 0.9), (phone, 3, phone + 12, 0.99)]
    assert pii.reconciled(text, found, [(card, 3, card + 30)]) == [(ip, 1, ip + 11, 0.95)]
    assert pii.reconciled(text, found, [(0, 0, 1)], sure=0.96) == [(phone, 3, phone + 12, 0.99)]


def personal(rnd, kind):
    n = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    if kind == 2:
        head = "4" + n(14)
        return head + next(d for d in "0123456789" if pii.luhn(head + d))
    return (f"{rnd.choice(['ann', 'bob.c', 'x'])}.{n(2)}@mail{n(1)}.example.{rnd.choice(['com', 'org'])}", ".".join(str(rnd.randint(0, 255)) for _ in range(4)), "",
            f"+1 ({n(3)}) 555-{n(4)}")[kind]


def test_tagger_finds_and_adds(spark, rows):
    """Learnt from the patterns' spans: finds them by itself in other texts, adds what the patterns miss, leaves other numbers alone."""
    rnd = random.Random(8)
    words = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(1, 40)))
    other = lambda: rnd.choice(["password=" + "%018x" % rnd.getrandbits(72), "version 3.", "AKIA%08X" % rnd.getrandbits(32), "BY-NC 4.0", "in 1987"])
    data = [(i, f"{words()} {personal(rnd, i % 5) if i % 5 < 4 else other()} {words()}") for i in range(1000)]
    tagger = pii.train(rows(data, DOCS), docs_read=800, steps=250)
    fresh = [(i, f"{words()} {personal(rnd, i % 4)} {words()}") for i in range(300)]
    right = total = 0
    for _, t in fresh:
        base, alone = pii.base_spans(t), []
        starts = list(pii.window_starts(t))
        for at, path, sure in zip(starts, *tagger.decode(np.stack([pii.classes(t[s:s + pii.WINDOW]) for s in starts]).astype(np.intp)), strict=True):
            alone += [(at + s, k, at + e, p) for s, k, e, p in pii.window_spans(path, sure) if (s or not at) and (e < pii.WINDOW or at + pii.WINDOW >= len(t))]
        right += len({s[:3] for s in pii.reconciled(t, alone, [])} & set(base))
        total += len(base)
    assert total > 280 and right / total > 0.9
    phone, card = personal(rnd, 3), personal(rnd, 2)
    glued = f"{words()} {phone} {card} {words()}"
    odd = [(1, glued), (2, None), (3, ""), (4, other() + " " + words()), (5, "w " * 100_000 + personal(rnd, 0) + " w" * 5000), (None, personal(rnd, 1)), (4, "again 1")]
    got = pii.find(rows(odd, DOCS), tagger)
    assert got.columns == ["doc_id", "spans"]
    found = sorted(((r.doc_id, r.spans) for r in got.collect()), key=str)
    by_id = {i: s for i, s in found if i != 4}
    assert [(s.kind, s.base) for s in by_id[1]] == [("phone", False), ("card", False)]
    assert by_id[2] == by_id[3] == [] and [s for i, s in found if i == 4] == [[], []]
    assert [(s.kind, s.start) for s in by_id[5]] == [("email", 200_000)] and [s.kind for s in by_id[None]] == ["ip"]
    assert pii.train(rows([], DOCS)) is None and pii.train(rows([(1, "no digits")], DOCS)) is None
    assert [[s.kind for s in r.spans] for r in pii.find(rows([odd[0], odd[5]], DOCS), None).collect()] == [[], ["ip"]]


def test_pii_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.registry()["op12_pii"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = by_patterns(docs[r.doc_id])
        names = [f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(names) <= set(filter(None, r.spans.split(","))) and r.n_added == len(list(filter(None, r.spans.split(",")))) - len(names)
