"""Rule-based sentiment (N1) as a Spark job over ``(post, position, token)``.

The per-post library call of the original job is re-expressed as:

1. split each post into words (case kept) and build, per word, a struct with
   the three previous and two next words (array shifts; no window, no shuffle);
2. ``posexplode`` that array (the post text itself is not carried);
3. look up the lexicon valence of each word and, for words that hit, whether
   their neighbours are lexicon words: joins with the lexicon, a dictionary, broadcast unless the
   caller says that it is too large (a frame of unknown size would shuffle all words);
4. apply the published rules (booster decay, ALL-CAPS emphasis, negation,
   "least", idioms, "but") as column expressions;
5. sum per post (hash aggregate whose partial step runs before the shuffle,
   so the shuffle carries about one row per post) and normalise.

Rules follow the published description of the VADER model (Hutto & Gilbert,
ICWSM 2014) and its public 3.3.2 release. Emoji translation is not done: the
cleaning step removes those characters before scoring.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.functions._util import as_col
from urbanlens.functions.text import split_words

# --- fixed values (published model constants) --------------------------------
B_INCR = 0.293
B_DECR = -0.293
C_INCR = 0.733
N_SCALAR = -0.74
NORM_ALPHA = 15.0
BOOSTER_DECAY = (1.0, 0.95, 0.9)
EXCL_PER_MARK, EXCL_MAX = 0.292, 4
QM_PER_MARK, QM_MAX_COUNT, QM_CAP = 0.18, 3, 0.96
# A word that may be all upper case: without a-z, with a letter that has cases.
_NOT_LOWER = r"[\x00-\x08\x0E-\x1F!-`{-\x{10FFFF}]*"
MAYBE_UPPER = r"(?:\A|\s)" + _NOT_LOWER + r"[A-Z\x80-\x{10FFFF}]" + _NOT_LOWER + r"(?:\s|\z)"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

NEGATORS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "ain't", "aren't", "can't", "couldn't", "daren't", "didn't", "doesn't",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't",
    "neednt", "needn't", "never", "none", "nope", "nor", "not", "nothing",
    "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "uh-uh", "wasn't", "weren't",
    "without", "wont", "wouldnt", "won't", "wouldn't", "rarely", "seldom",
    "despite",
)

BOOSTERS = {
    "absolutely": B_INCR, "amazingly": B_INCR, "awfully": B_INCR,
    "completely": B_INCR, "considerable": B_INCR, "considerably": B_INCR,
    "decidedly": B_INCR, "deeply": B_INCR, "effing": B_INCR,
    "enormous": B_INCR, "enormously": B_INCR, "entirely": B_INCR,
    "especially": B_INCR, "exceptional": B_INCR, "exceptionally": B_INCR,
    "extreme": B_INCR, "extremely": B_INCR, "fabulously": B_INCR,
    "flipping": B_INCR, "flippin": B_INCR, "frackin": B_INCR,
    "fracking": B_INCR, "fricking": B_INCR, "frickin": B_INCR,
    "frigging": B_INCR, "friggin": B_INCR, "fully": B_INCR,
    "fuckin": B_INCR, "fucking": B_INCR, "fuggin": B_INCR, "fugging": B_INCR,
    "greatly": B_INCR, "hella": B_INCR, "highly": B_INCR, "hugely": B_INCR,
    "incredible": B_INCR, "incredibly": B_INCR, "intensely": B_INCR,
    "major": B_INCR, "majorly": B_INCR, "more": B_INCR, "most": B_INCR,
    "particularly": B_INCR, "purely": B_INCR, "quite": B_INCR,
    "really": B_INCR, "remarkably": B_INCR, "so": B_INCR,
    "substantially": B_INCR, "thoroughly": B_INCR, "total": B_INCR,
    "totally": B_INCR, "tremendous": B_INCR, "tremendously": B_INCR,
    "uber": B_INCR, "unbelievably": B_INCR, "unusually": B_INCR,
    "utter": B_INCR, "utterly": B_INCR, "very": B_INCR,
    "almost": B_DECR, "barely": B_DECR, "hardly": B_DECR,
    "just enough": B_DECR, "kind of": B_DECR, "kinda": B_DECR,
    "kindof": B_DECR, "kind-of": B_DECR, "less": B_DECR, "little": B_DECR,
    "marginal": B_DECR, "marginally": B_DECR, "occasional": B_DECR,
    "occasionally": B_DECR, "partly": B_DECR, "scarce": B_DECR,
    "scarcely": B_DECR, "slight": B_DECR, "slightly": B_DECR,
    "somewhat": B_DECR, "sort of": B_DECR, "sorta": B_DECR, "sortof": B_DECR,
    "sort-of": B_DECR,
}

SPECIAL_CASES = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5,
    "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5,
    "to die for": 3.0, "beating heart": 3.1, "broken heart": -2.9,
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleWords:
    """The words that the rules beside lexicon, boosters and negators listen to."""
    but: str = "but"
    least: str = "least"
    least_spared_after: tuple[str, ...] = ("at", "very")
    no: str = "no"
    no_linked_by: tuple[str, ...] = ("or", "nor")
    never: str = "never"
    so_this: tuple[str, ...] = ("so", "this")
    without: str = "without"
    doubt: str = "doubt"


RULE_WORDS = RuleWords()


def two_places(compound) -> Column:
    """a four-place score rounded to two places as ``round(x, 2)`` does it, by the exact value of the double.

    In ten-thousandths only ``..50`` is open. There the double lies above or below the decimal, or on it (then the even neighbour is taken);
    the double times 2^60 is an integer, so comparing is exact.
    """
    x = as_col(compound)
    u = F.abs(F.round(x * 10000.0).cast("long"))
    q, r = F.call_function("div", u, F.lit(100)), u % 100
    exact = (F.abs(x) * F.lit(float(1 << 60))).cast("long").cast("decimal(19,0)") * F.lit(10000).cast("decimal(5,0)")
    decimal = u.cast("decimal(14,0)") * F.lit(1 << 60).cast("decimal(19,0)")
    up = (F.when(r != 50, (r > 50).cast("long")).when(exact > decimal, F.lit(1)).when(exact < decimal, F.lit(0)).otherwise(q % 2))
    return F.signum(x) * (q + up) / 100.0 + 0.0


def _lookup(c: Column, mapping: Mapping[str, float]) -> Column:
    """Value of ``c`` in a small constant mapping, NULL when absent.

    Keys are grouped by value into ``IN`` lists, which Catalyst turns into
    hash-set tests, instead of a linear scan through a map literal.
    """
    by_value: dict[float, list[str]] = {}
    for k, v in mapping.items():
        by_value.setdefault(float(v), []).append(k)
    out = None
    for v, keys in by_value.items():
        cond = c.isin(keys)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return F.lit(None).cast("double") if out is None else out


def _eq(c: Column, s: str) -> Column:
    return F.coalesce(c == F.lit(s), F.lit(False))


def _in(c: Column, items) -> Column:
    return F.coalesce(c.isin(list(items)), F.lit(False))


def is_upper(word) -> Column:
    """Python ``str.isupper``: has a cased char and no lower-case one."""
    w = as_col(word)
    return (w == F.upper(w)) & (w != F.lower(w))


def strip_punct_if_word(word) -> Column:
    """Strip edge punctuation unless that leaves two characters or fewer."""
    w = as_col(word)
    cls = "[" + "".join("\\" + ch for ch in PUNCTUATION) + "]"
    stripped = F.regexp_replace(w, f"^{cls}+|{cls}+$", "")
    return F.when(F.length(stripped) <= 2, w).otherwise(stripped)


def punctuation_amplifier(text) -> Column:
    """Emphasis from ``!`` and ``?`` in the text (zero on cleaned text)."""
    t = as_col(text)
    ep = F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))
    qm = F.length(t) - F.length(F.replace(t, F.lit("?"), F.lit("")))
    ep_amp = F.least(ep, F.lit(EXCL_MAX)) * F.lit(EXCL_PER_MARK)
    qm_amp = (F.when(qm <= 1, F.lit(0.0))
              .when(qm <= QM_MAX_COUNT, qm * F.lit(QM_PER_MARK))
              .otherwise(F.lit(QM_CAP)))
    return F.coalesce(ep_amp + qm_amp, F.lit(0.0))


def normalize(score: Column, alpha: float = NORM_ALPHA) -> Column:
    """``s / sqrt(s^2 + alpha)`` clamped to [-1, 1]."""
    x = score / F.sqrt(score * score + F.lit(alpha))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def lexicon_table(lexicon: DataFrame, token_col: str = "token",
                  valence_col: str = "valence") -> DataFrame:
    """One valence per lower-cased token; a token with two valences fails the job."""
    rows = lexicon.select(F.lower(F.col(token_col)).alias("lx_token"), F.col(valence_col).cast("double").alias("v"))
    both = F.raise_error(F.concat(F.lit("two valences of one lexicon token: "), F.col("lx_token"))).cast("double")
    return (rows.groupBy("lx_token").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
            .select("lx_token", F.when(F.col("lo") != F.col("hi"), both).otherwise(F.col("hi")).alias("lx_valence")))


def post_words(posts: DataFrame, key: str, text: str, carry: Sequence[str] = (), but: str = RULE_WORDS.but, keep_text: bool = False) -> DataFrame:
    """N1.1: ``(key, carry.., pos, w, p1, p2, p3, n1, n2, capdiff, but_pos, amp, null_text)``.

    ``p*`` are the previous and ``n*`` the next words (original case); built
    with array shifts (slice/concat) before the explode, so each output row
    holds a handful of short strings, never the whole post. With ``keep_text`` a
    post's anchor row, and no other, has its text as ``post_text``.
    """
    punct_cls = "[" + "".join("\\" + ch for ch in PUNCTUATION) + "]"
    raw = split_words(text)
    # strip edge punctuation only in posts that hold any (cleaned posts never do)
    words_expr = F.when(F.col(text).rlike(punct_cls), F.transform(raw, strip_punct_if_word)).otherwise(raw)
    staged = posts.select(
        F.col(key), *[F.col(c) for c in carry],
        F.col(text).isNull().alias("null_text"),
        punctuation_amplifier(text).alias("amp"),
        words_expr.alias("_words"), F.col(text).rlike(MAYBE_UPPER).alias("_caps"), *([F.col(text).alias("_text")] if keep_text else []),
    )
    words = F.col("_words")
    n = F.size(words)
    # one test of the whole text spares most posts the look at each word
    capdiff = F.when(F.col("_caps"), F.exists(words, is_upper) & F.exists(words, lambda x: ~is_upper(x)))

    def prev(k):
        return F.concat(F.array_repeat(F.lit(None).cast("string"), F.least(F.lit(k), n)),
                        F.slice(words, 1, F.greatest(n - F.lit(k), F.lit(0))))

    def nxt(k):
        return F.concat(F.slice(words, k + 1, F.greatest(n - F.lit(k), F.lit(0))),
                        F.array_repeat(F.lit(None).cast("string"), F.least(F.lit(k), n)))

    # per-post scalars and the neighbour arrays are built before the explode,
    # so the Generate carries only small columns next to each word
    staged = staged.select(
        F.col(key), *[F.col(c) for c in carry], "null_text", "amp",
        F.coalesce(capdiff, F.lit(False)).alias("capdiff"),
        (F.coalesce(F.array_position(F.transform(words, F.lower), but), F.lit(0))
         - F.lit(1)).alias("but_pos"),
        *([F.when(F.coalesce(n, F.lit(0)) <= 0, F.col("_text")).alias("_blank")] if keep_text else []),
        F.arrays_zip(*([F.concat(F.array("_text"), F.array_repeat(F.lit(None).cast("string"), n - 1)).alias("t")] if keep_text else []),
                     words.alias("w"), prev(1).alias("p1"), prev(2).alias("p2"), prev(3).alias("p3"),
                     nxt(1).alias("n1"), nxt(2).alias("n2")).alias("_ctx"),
    )
    return staged.select(
        F.col(key), *[F.col(c) for c in carry], "null_text", "amp", "capdiff", "but_pos",
        *(["_blank"] if keep_text else []), F.posexplode_outer("_ctx").alias("pos", "c"),
    ).select(key, *carry, *([F.coalesce("c.t", "_blank").alias("post_text")] if keep_text else []), "null_text", "capdiff", "but_pos", "amp", "pos",
             "c.w", "c.p1", "c.p2", "c.p3", "c.n1", "c.n2")


def is_anchor() -> Column:
    """The one row that every post has among its words: the first word, or the row of a post without words."""
    return F.col("pos").isNull() | (F.col("pos") == 0)


def _dictionary(table: DataFrame, broadcast: bool) -> DataFrame:
    return F.broadcast(table) if broadcast else table


def lexicon_join(words: DataFrame, lexicon: DataFrame, word_col: str = "w", broadcast: bool = True) -> DataFrame:
    """Words with a valence ``v0`` and lexicon flags of their neighbours, and each post's anchor row.

    The lexicon is met first; only hits and one row per post go on, so
    neighbour look-ups and rules don't touch the other words. The lexicon
    is broadcast; without ``broadcast``, for one beyond the memory of a task, Spark decides. Rows that look nothing up have
    a key of their own each: they never gather in one partition.
    """
    lex = _dictionary(lexicon_table(lexicon), broadcast)
    out = (words.join(lex, F.lower(F.col(word_col)) == lex["lx_token"], "left")
           .withColumnRenamed("lx_valence", "v0").drop("lx_token")
           .where(F.col("v0").isNotNull() | is_anchor()))
    nothing = F.concat(F.lit("\u0000"), F.xxhash64(*words.columns).cast("string"))
    for nb, flag in (("p1", "in1"), ("p2", "in2"), ("p3", "in3"), ("n1", "inn1")):
        k = _dictionary(lex.select(F.col("lx_token").alias(f"_k_{flag}"), F.lit(True).alias(flag)), broadcast)
        probe = F.coalesce(F.when(F.col("v0").isNotNull(), F.lower(F.col(nb))), nothing)
        out = (out.join(k, probe == k[f"_k_{flag}"], "left").drop(f"_k_{flag}")
               .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))
    return out


def _negated(lw: Column, negators) -> Column:
    return _in(lw, negators) | F.coalesce(lw.contains("n't"), F.lit(False))


def idiom_table(idioms: DataFrame, phrase_col: str = "phrase", valence_col: str = "valence") -> DataFrame:
    """One valence per lower-cased phrase, its words joined by one blank; a phrase with two valences fails the job."""
    phrase = F.array_join(F.filter(F.split(F.lower(F.col(phrase_col)), r"\s+"), lambda w: w != ""), " ")
    rows = idioms.select(phrase.alias("phrase"), F.col(valence_col).cast("double").alias("v"))
    both = F.raise_error(F.concat(F.lit("two valences of one idiom: "), F.col("phrase"))).cast("double")
    return (rows.groupBy("phrase").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
            .select("phrase", F.when(F.col("lo") != F.col("hi"), both).otherwise(F.col("hi")).alias("idiom")))


def idiom_join(df: DataFrame, idioms: DataFrame, broadcast: bool = True) -> DataFrame:
    """N1.8 with a table of any size: ``df`` (after :func:`lexicon_join`) and the valence ``idiom`` of the phrase that a hit stands in or behind.

    The seven runs of words around a hit are looked up one by one, in the order in which one overrides the other, as the neighbours are:
    the table is broadcast unless the caller says that it is too large, and rows that look nothing up have a key of their own each.
    """
    w, p1, p2, p3, n1, n2 = (F.lower(c) for c in ("w", "p1", "p2", "p3", "n1", "n2"))

    def run(*words: Column) -> Column:
        return F.concat_ws(" ", *words)

    runs = [F.when(n2.isNotNull(), run(w, n1, n2)), F.when(n1.isNotNull(), run(w, n1)), run(p1, w), run(p2, p1, w), run(p2, p1), run(p3, p2, p1), run(p3, p2)]
    table = idiom_table(idioms)
    nothing = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    out = df
    for i, phrase in enumerate(runs):
        k = _dictionary(table.select(F.col("phrase").alias(f"_k{i}"), F.col("idiom").alias(f"_idiom{i}")), broadcast)
        probe = F.coalesce(F.when(F.col("v0").isNotNull(), phrase), nothing)
        out = out.join(k, probe == k[f"_k{i}"], "left").drop(f"_k{i}")
    return out.select(*df.columns, F.coalesce(*[f"_idiom{i}" for i in range(len(runs))]).alias("idiom"))


def score_words(df: DataFrame, boosters: Mapping[str, float] = BOOSTERS, negators=NEGATORS,
                idioms: Mapping[str, float] | None = SPECIAL_CASES, out_col: str = "s", rules: RuleWords = RULE_WORDS) -> DataFrame:
    """N1.2-N1.8: valence of each exploded word row (after :func:`lexicon_join`).

    ``idioms``: a small mapping, or None if :func:`idiom_join` has looked them up.

    Each rule is one projection over the previous one's column, so the plan
    stays small (the rules feed the running valence into each other).
    """
    w, capdiff, v0 = F.col("w"), F.col("capdiff"), F.col("v0")
    hit = v0.isNotNull()
    p = [F.col("p1"), F.col("p2"), F.col("p3")]
    lp = [F.col("_l1"), F.col("_l2"), F.col("_l3")]
    n1, n2 = F.col("_n1"), F.col("_n2")
    inp = [F.col("in1"), F.col("in2"), F.col("in3")]
    so_this = rules.so_this

    def guarded(e):
        # rules only run for lexicon hits; every other word scores 0
        return F.when(hit, e)

    df = df.select("*", guarded(F.lower(w)).alias("_lw"),
                   *[guarded(F.lower(c)).alias(f"_l{i + 1}") for i, c in enumerate(p)],
                   guarded(F.lower(F.col("n1"))).alias("_n1"), guarded(F.lower(F.col("n2"))).alias("_n2"))
    lw = F.col("_lw")
    # "no" before a lexicon word, and negation by a nearby "no"
    no_near = _eq(lp[0], rules.no) | _eq(lp[1], rules.no) | (_eq(lp[2], rules.no) & _in(lp[0], rules.no_linked_by))
    va = (F.when(no_near, v0 * F.lit(N_SCALAR))
          .when(_eq(lw, rules.no) & n1.isNotNull() & F.col("inn1"), F.lit(0.0))
          .otherwise(v0))
    df = df.select("*", guarded(va).alias("_va"))
    # ALL-CAPS emphasis
    v = F.col("_va")
    df = df.select("*", guarded(F.when(is_upper(w) & capdiff,
                                       F.when(v > 0, v + F.lit(C_INCR)).otherwise(v - F.lit(C_INCR)))
                               .otherwise(v)).alias("_v0"))

    for k in range(3):
        v = F.col(f"_v{k}")
        word_k, low_k = p[k], lp[k]
        b = _lookup(low_k, boosters)
        s = F.when(v < 0, -b).otherwise(b)
        s = F.when(is_upper(word_k) & capdiff,
                   F.when(v > 0, s + F.lit(C_INCR)).otherwise(s - F.lit(C_INCR))).otherwise(s)
        s = F.coalesce(F.when(b.isNotNull(), s), F.lit(0.0)) * F.lit(BOOSTER_DECAY[k])
        df = df.select("*", guarded(v + s).alias(f"_nv{k}"))
        nv = F.col(f"_nv{k}")
        if k == 0:
            ng = F.when(_negated(lp[0], negators), nv * F.lit(N_SCALAR)).otherwise(nv)
        elif k == 1:
            ng = (F.when(_eq(lp[1], rules.never) & _in(lp[0], so_this), nv * F.lit(1.25))
                  .when(_eq(lp[1], rules.without) & _eq(lp[0], rules.doubt), nv)
                  .when(_negated(lp[1], negators), nv * F.lit(N_SCALAR))
                  .otherwise(nv))
        else:
            ng = (F.when((_eq(lp[2], rules.never) & _in(lp[1], so_this)) | _in(lp[0], so_this),
                         nv * F.lit(1.25))
                  .when(_eq(lp[2], rules.without) & (_eq(lp[1], rules.doubt) | _eq(lp[0], rules.doubt)), nv)
                  .when(_negated(lp[2], negators), nv * F.lit(N_SCALAR))
                  .otherwise(nv))
        df = df.select("*", guarded(ng).alias(f"_ng{k}"))
        res = F.col(f"_ng{k}")
        if k == 2:
            df = _idioms(df, res, lw, lp, n1, n2, idioms, boosters, guarded)
            res = F.col("_id")
        df = df.select("*", guarded(F.when(word_k.isNotNull() & ~inp[k], res).otherwise(v))
                       .alias(f"_v{k + 1}"))

    # "least" before the word negates it, unless "at least" / "very least"
    v = F.col("_v3")
    least_prev = _eq(lp[0], rules.least) & ~inp[0]
    v = (F.when(least_prev & lp[1].isNotNull(),
                F.when(_in(lp[1], rules.least_spared_after), v).otherwise(v * F.lit(N_SCALAR)))
         .when(least_prev, v * F.lit(N_SCALAR))
         .otherwise(v))
    skip = _in(lw, list(boosters)) | (_eq(lw, "kind") & _eq(n1, "of"))
    final = F.when(v0.isNull() | skip, F.lit(0.0)).otherwise(v)
    tmp = [c for c in df.columns if c.startswith("_")]
    return df.select("*", final.alias(out_col)).drop(*tmp)


def _idioms(df: DataFrame, v: Column, lw: Column, lp, n1: Column, n2: Column,
            idioms: Mapping[str, float] | None, boosters: Mapping[str, float], guarded) -> DataFrame:
    def cat(*cs):
        return F.concat_ws(" ", *cs)

    if idioms is None:
        return _with_booster_phrases(df, F.coalesce("idiom", v), lp, boosters, guarded)
    seqs = [cat(lp[0], lw), cat(lp[1], lp[0], lw), cat(lp[1], lp[0]),
            cat(lp[2], lp[1], lp[0]), cat(lp[2], lp[1])]
    hit = F.coalesce(*[_lookup(q, idioms) for q in seqs], v)
    df = df.select("*", guarded(hit).alias("_i1"))
    i = F.col("_i1")
    i = F.coalesce(F.when(n1.isNotNull(), _lookup(cat(lw, n1), idioms)), i)
    df = df.select("*", guarded(i).alias("_i2"))
    i = F.coalesce(F.when(n2.isNotNull(), _lookup(cat(lw, n1, n2), idioms)), F.col("_i2"))
    return _with_booster_phrases(df, i, lp, boosters, guarded)


def _with_booster_phrases(df: DataFrame, i: Column, lp, boosters: Mapping[str, float], guarded) -> DataFrame:
    def cat(*cs):
        return F.concat_ws(" ", *cs)

    add = None
    for g in (cat(lp[2], lp[1], lp[0]), cat(lp[2], lp[1]), cat(lp[1], lp[0])):
        term = F.coalesce(_lookup(g, boosters), F.lit(0.0))
        add = term if add is None else add + term
    return df.select("*", guarded(i + add).alias("_id"))


def but_weight() -> Column:
    """N1.7: words before the first "but" count half, words after 1.5 times."""
    bp, pos = F.col("but_pos"), F.col("pos")
    return (F.when((bp >= 0) & (pos < bp), F.lit(0.5))
            .when((bp >= 0) & (pos > bp), F.lit(1.5))
            .otherwise(F.lit(1.0)))


def sentiment_score(posts: DataFrame, key: str, text: str, lexicon: DataFrame,
                    boosters: Mapping[str, float] = BOOSTERS, negators=NEGATORS,
                    idioms: Mapping[str, float] | DataFrame = SPECIAL_CASES,
                    carry: Sequence[str] = (), places: int = 4,
                    display_places: int | None = 2, rules: RuleWords = RULE_WORDS, keep_text: bool = False, broadcast: bool = True) -> DataFrame:
    """``(key, carry.., compound[, sentiment])`` per post.

    ``idioms`` is a small mapping or a table ``(phrase, valence)``. Lexicon and table are broadcast; without
    ``broadcast`` they may be of any size, and all words are shuffled if Spark finds them too large.
    With ``keep_text`` the text comes along, on one row of each post: nothing is read or shuffled twice for it.

    ``compound`` is rounded to ``places`` (4, as the model reports it);
    ``sentiment`` is the two-place display value of the original job. Empty
    text scores 0.0 and null text gives null. ``key`` must identify a post:
    a key that is null or that two posts share fails the job.
    """
    if key not in posts.columns:
        raise ValueError(f"sentiment_score needs a post key column, {key!r} not found")
    words = lexicon_join(post_words(posts, key, text, carry, rules.but, keep_text), lexicon, broadcast=broadcast)
    as_table = isinstance(idioms, DataFrame)
    if as_table:
        words = idiom_join(words, idioms, broadcast)
    scored = score_words(words, boosters, negators, None if as_table else idioms, rules=rules)
    scored = scored.withColumn("s", F.col("s") * but_weight())
    sums = scored.groupBy(key).agg(
        F.sum("s").alias("sum_s"), F.sum(is_anchor().cast("int")).alias("n_posts"),
        *[F.first(c).alias(c) for c in (*carry, "null_text", "amp")],
        *([F.first("post_text", ignorenulls=True).alias("post_text")] if keep_text else []))
    wrong = F.raise_error(F.concat(F.lit(f"{key} does not identify a post: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    sums = sums.withColumn("sum_s", F.when(F.col(key).isNull() | (F.col("n_posts") > 1), wrong.cast("double")).otherwise(F.col("sum_s")))
    s = F.col("sum_s")
    amplified = (F.when(s > 0, s + F.col("amp")).when(s < 0, s - F.col("amp"))
                 .otherwise(s))
    compound = F.round(normalize(amplified), places)
    compound = F.when(F.col("null_text"), F.lit(None).cast("double")).otherwise(compound)
    out = sums.select(key, *carry, *([F.col("post_text").alias(text)] if keep_text else []), compound.alias("compound"))
    if display_places is not None:
        shown = two_places("compound") if (places, display_places) == (4, 2) else F.round("compound", display_places)
        out = out.withColumn("sentiment", shown)
    return out


def lexicon_hits(posts: DataFrame, key: str, text: str, lexicon: DataFrame, broadcast: bool = True) -> DataFrame:
    """``(key, pos, token, valence)`` for every word found in the lexicon."""
    words = post_words(posts, key, text)
    lex = _dictionary(lexicon_table(lexicon), broadcast)
    return (words.join(lex, F.lower(F.col("w")) == lex["lx_token"], "inner")
            .select(key, "pos", F.col("w").alias("token"), F.col("lx_valence").alias("valence")))


def avg_sentiment_by(scored: DataFrame, by: str = "station", score_col: str = "compound",
                     places: int = 4) -> DataFrame:
    """A4: mean score and post count per group (partial aggregation first).

    Scores carry ``places`` decimals, so they are summed exactly as integers
    of ``10**-places`` and divided once: the mean does not depend on the
    order in which partitions are summed (a float sum would).
    """
    scale = 10 ** places
    units = F.round(F.col(score_col) * F.lit(float(scale))).cast("long")
    mean = (F.sum(units) / F.count(score_col)) / F.lit(float(scale))
    return (scored.groupBy(by)
            .agg(mean.alias("avg_sentiment"), F.count(F.lit(1)).alias("n_posts")))
