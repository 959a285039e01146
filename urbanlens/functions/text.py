"""Column functions for short-post text (clean, case, tokens, stop words).

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and also work on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlens.functions._util import as_col

# --- fixed values -----------------------------------------------------------
# Cleaning pattern of the posts jobs: a mention (@ followed by letters or
# digits), any single character outside digits, ASCII letters, blank and tab,
# or a URL (word characters, "://", non-blanks). Leftmost match, alternatives
# in this order.
CLEAN_PATTERN = "(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\\w+:\\/\\/\\S+)"

# Spark ML's default English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english"), 181 words, file order).
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)
# Characters the bag-of-words step turns into blanks before splitting.
BAG_SEPARATORS = ",.-"
# ----------------------------------------------------------------------------


# Equivalent cheaper patterns: the characters outside the kept ones are listed, which
# Java matches many times faster than a negated class; without "://" in the text the URL
# alternative can never match, and without "@" neither can the mention alternative. Runs go at
# once; a run ends before "@", which may begin a mention.
_DROPPED = r"\x00-\x08\x0A-\x1F!-/:-?\[-`{-\x{10FFFF}"
_CLEAN_URL = r"(@[A-Za-z0-9]+)|([@" + _DROPPED + r"])|(\w+:\/\/\S+)"
_CLEAN_NO_URL = "@[A-Za-z0-9]*|[" + _DROPPED + "]+"
_CLEAN_CHARS = "[" + _DROPPED + "]+"


def clean_text(text) -> Column:
    """drop mentions, URLs and every char outside ``[0-9A-Za-z \\t]``.

    Case is kept; newlines are removed, so lines fuse. Null stays null.
    Texts without ``://`` (or ``@``) use the shorter equivalent pattern,
    which gives the same result without trying the URL (mention) branch at
    every position.
    """
    t = as_col(text)
    return (F.when(t.contains("://"), F.regexp_replace(t, _CLEAN_URL, ""))
            .when(t.contains("@"), F.regexp_replace(t, _CLEAN_NO_URL, ""))
            .otherwise(F.regexp_replace(t, _CLEAN_CHARS, "")))


def lower_text(text) -> Column:
    """lower case."""
    return F.lower(as_col(text))


def collapse_spaces(text) -> Column:
    """runs of blanks become one blank (tabs untouched, no trim)."""
    return F.regexp_replace(as_col(text), " {2,}", " ")


def topic_text(text) -> Column:
    """F1 + F2 + F3, the text preparation of the topic job."""
    return collapse_spaces(lower_text(clean_text(text)))


def tokenize(text) -> Column:
    """lower case, split on every single whitespace char, drop empties.

    ``""`` gives an empty array and null gives null (the ML Tokenizer keeps a
    leading empty token and fails on null; empty tokens never reach a count).
    """
    parts = F.split(F.lower(as_col(text)), "\\s")
    return F.filter(parts, lambda t: t != F.lit(""))


def split_words(text) -> Column:
    """Whitespace-run split that keeps case and drops empties (sentiment path)."""
    return F.filter(F.split(as_col(text), "\\s+"), lambda t: t != F.lit(""))


def remove_stop_words(tokens, stop_words=ENGLISH_STOP_WORDS,
                      case_sensitive: bool = False) -> Column:
    """drop stop words from an array, keeping order and duplicates.

    The list is a literal, so Catalyst turns the membership test into a hash
    set lookup (``InSet``) evaluated per element; no join, no shuffle.
    """
    words = list(stop_words) if case_sensitive else sorted({w.lower() for w in stop_words})
    if case_sensitive:
        return F.filter(as_col(tokens), lambda t: ~t.isin(words))
    return F.filter(as_col(tokens), lambda t: ~F.lower(t).isin(words))


def array_join_tokens(tokens, sep: str = ",") -> Column:
    """join an array of strings with a separator."""
    return F.array_join(as_col(tokens), sep)


def bag_split(text, separators: str = BAG_SEPARATORS) -> Column:
    """``, . -`` become blanks, then split on whitespace runs, no empties."""
    spaced = F.translate(as_col(text), separators, " " * len(separators))
    return F.filter(F.split(spaced, "\\s+"), lambda t: t != F.lit(""))
