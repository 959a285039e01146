"""English Snowball (Porter2) stemming as Spark expressions.

The published Porter2 rules (snowballstem.org, BSD licence), one projection per step over three columns: the word with its
consonant ``y`` marked as ``Y``, and the starts of its regions R1 and R2. All of it is built-in expressions; the topic job
applies it to the distinct counted words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (published Porter2 definitions) ---------------------------
VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
R1_PREFIXES = ("gener", "commun", "arsen")
# whole words with a fixed stem, checked before any rule
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie",
    "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky",
    "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
# words left alone once step 1a has run
AFTER_1A = frozenset(("inning", "outing", "canning", "herring", "earring",
                      "proceed", "exceed", "succeed"))
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"),
    ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"),
    ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
    ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"),
    ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
    ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
    ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism",
         "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")
# ----------------------------------------------------------------------------

_V, _C = "[aeiouy]", "[^aeiouy]"
_REGION = f"(?s)^.*?{_V}{_C}"
_SHORT = f"(?s)(?:^{_V}{_C}|{_C}{_V}[^aeiouywxY])\\z"


def _ending(w: Column, endings) -> Column:
    """The longest of the endings that the word has, else an empty string."""
    return F.regexp_extract(w, f"(?:{'|'.join(endings)})\\z", 0)


def _cut(w: Column, n) -> Column:
    """The word without its last ``n`` letters."""
    return F.substring(w, F.lit(1), F.length(w) - n)


def _length_or(text: Column, otherwise: Column) -> Column:
    return F.when(text != "", F.length(text)).otherwise(otherwise)


def _mapped(ending: Column, table) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table for x in pair]), ending)


def stem_words(df: DataFrame, word_col: str = "token", out_col: str = "stem") -> DataFrame:
    """``df`` with the Porter2 stem of each word (null stays null); ``df`` itself is not shuffled."""
    word, w, p1, p2, end, base = (F.col(c) for c in ("_word", "_w", "_p1", "_p2", "_end", "_base"))

    def step(d: DataFrame, value: Column) -> DataFrame:
        return d.withColumn("_w", value)

    def find(d: DataFrame, endings) -> DataFrame:
        return d.withColumn("_end", _ending(w, endings)).withColumn("_base", _cut(w, F.length(end)))

    d = df.withColumn("_word", F.lower(F.col(word_col)))
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(word, "^'", ""), "^y", "Y"), f"({_V})y", "$1Y")
    d = step(d, marked)
    prefix = F.regexp_extract(w, f"^(?:{'|'.join(R1_PREFIXES)})", 0)
    d = d.withColumn("_p1", _length_or(prefix, _length_or(F.regexp_extract(w, _REGION, 0), F.length(w))))
    rest = F.regexp_extract(F.substring(w, p1 + 1, F.length(w)), _REGION, 0)
    d = d.withColumn("_p2", F.when(rest != "", p1 + F.length(rest)).otherwise(F.length(w)))
    # 0: possessives; 1a: plurals
    d = step(d, F.regexp_replace(w, "(?:'s'|'s|')\\z", ""))
    d = step(d, F.when(w.endswith("sses"), _cut(w, 2))
             .when(w.rlike("ie[ds]\\z"), F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1)))
             .when(w.rlike("[us]s\\z"), w)
             .when(w.rlike(f"(?s){_V}.+s\\z"), _cut(w, 1)).otherwise(w))
    d = d.withColumn("_done", F.when(F.length(word) <= 2, word).when(word.isin(list(EXCEPTIONS)), _mapped(word, EXCEPTIONS.items()))
                     .when(w.isin(list(AFTER_1A)), w))
    # 1b: past tense and gerunds
    d = find(d, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    mended = (F.when(base.rlike("(?:at|bl|iz)\\z"), F.concat(base, F.lit("e")))
              .when(base.rlike(f"(?:{'|'.join(DOUBLES)})\\z"), _cut(base, 1))
              .when((p1 >= F.length(base)) & base.rlike(_SHORT), F.concat(base, F.lit("e"))).otherwise(base))
    d = step(d, F.when(end.startswith("eed"), F.when(F.length(base) >= p1, F.concat(base, F.lit("ee"))).otherwise(w))
             .when((end != "") & base.rlike(_V), mended).otherwise(w))
    # 1c: final y
    d = step(d, F.regexp_replace(w, f"(?s)^(.+{_C})[yY]\\z", "$1i"))
    # 2 and 3: suffixes in R1
    d = find(d, [e for e, _ in STEP2])
    d = step(d, F.when((end == "") | (F.length(base) < p1), w)
             .when(end == "ogi", F.when(base.endswith("l"), F.concat(base, F.lit("og"))).otherwise(w))
             .when(end == "li", F.when(base.rlike(f"[{''.join(sorted(LI_ENDINGS))}]\\z"), base).otherwise(w))
             .otherwise(F.concat(base, _mapped(end, STEP2))))
    d = find(d, [e for e, _ in STEP3])
    d = step(d, F.when((end == "") | (F.length(base) < p1), w)
             .when((end == "ative") & (F.length(base) < p2), w)
             .otherwise(F.concat(base, _mapped(end, STEP3))))
    # 4: suffixes in R2; 5: final e and l
    d = find(d, STEP4)
    d = step(d, F.when((end == "") | (F.length(base) < p2), w)
             .when((end == "ion") & ~base.rlike("[st]\\z"), w).otherwise(base))
    d = d.withColumn("_base", _cut(w, 1))
    d = step(d, F.when(w.endswith("e"), F.when((F.length(base) >= p2) | ((F.length(base) >= p1) & ~base.rlike(_SHORT)), base).otherwise(w))
             .when(w.endswith("ll") & (F.length(base) >= p2), base).otherwise(w))
    d = d.withColumn("_stem", F.when(word.isNotNull(), F.coalesce("_done", F.translate(w, "Y", "y"))))
    return d.select(*[F.col(c) for c in df.columns if c != out_col], F.col("_stem").alias(out_col))
