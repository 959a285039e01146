"""Porter2 letter by letter: the brute-force version that the expressions are held against."""

from __future__ import annotations

from urbanlens.functions.stem import AFTER_1A, DOUBLES, EXCEPTIONS, LI_ENDINGS, R1_PREFIXES, STEP2, STEP3, STEP4, VOWELS


def _is_vowel(ch: str) -> bool:
    return ch in VOWELS


def _region_start(w: str, start: int) -> int:
    """Index after the first non-vowel that follows a vowel, from ``start``."""
    for i in range(max(start, 1), len(w)):
        if not _is_vowel(w[i]) and _is_vowel(w[i - 1]):
            return i + 1
    return len(w)


def _short_syllable_at_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w[0]) and not _is_vowel(w[1])
    if n >= 3:
        return (not _is_vowel(w[-3]) and _is_vowel(w[-2])
                and not _is_vowel(w[-1]) and w[-1] not in "wxY")
    return False


def _longest(w: str, suffixes):
    for entry in suffixes:
        suf = entry[0] if isinstance(entry, tuple) else entry
        if w.endswith(suf):
            return entry
    return None


def stem_word(word: str | None) -> str | None:
    """Porter2 stem of one lower-cased token (None stays None)."""
    if word is None:
        return None
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in EXCEPTIONS:
        return EXCEPTIONS[w]
    if w.startswith("'"):
        w = w[1:]
    # mark consonant y as Y
    chars = list(w)
    for i, ch in enumerate(chars):
        if ch == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    w = "".join(chars)

    p1 = next((len(p) for p in R1_PREFIXES if w.startswith(p)), None)
    if p1 is None:
        p1 = _region_start(w, 1)
    p2 = _region_start(w, p1 + 1)

    # step 0: possessives
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break

    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if any(_is_vowel(c) for c in w[:-2]):
            w = w[:-1]
    if w in AFTER_1A:
        return w

    # step 1b
    suf = _longest(w, ("eedly", "ingly", "edly", "eed", "ing", "ed"))
    if suf in ("eed", "eedly"):
        if len(w) - len(suf) >= p1:
            w = w[: -len(suf)] + "ee"
    elif suf is not None:
        stem = w[: -len(suf)]
        if any(_is_vowel(c) for c in stem):
            w = stem
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif w.endswith(DOUBLES):
                w = w[:-1]
            elif p1 >= len(w) and _short_syllable_at_end(w):
                w += "e"

    # step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w[-2]):
        w = w[:-1] + "i"

    # step 2
    hit = _longest(w, STEP2)
    if hit is not None:
        suf, rep = hit
        if len(w) - len(suf) >= p1:
            if suf == "ogi":
                if w[:-3].endswith("l"):
                    w = w[:-3] + rep
            elif suf == "li":
                if len(w) >= 3 and w[-3] in LI_ENDINGS:
                    w = w[:-2]
            else:
                w = w[: -len(suf)] + rep

    # step 3
    hit = _longest(w, STEP3)
    if hit is not None:
        suf, rep = hit
        if len(w) - len(suf) >= p1:
            if suf == "ative":
                if len(w) - len(suf) >= p2:
                    w = w[: -len(suf)]
            else:
                w = w[: -len(suf)] + rep

    # step 4
    suf = _longest(w, STEP4)
    if suf is not None and len(w) - len(suf) >= p2:
        if suf == "ion":
            if len(w) >= 4 and w[-4] in "st":
                w = w[:-3]
        else:
            w = w[: -len(suf)]

    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= p2:
            w = w[:-1]
        elif len(w) - 1 >= p1 and not _short_syllable_at_end(w[:-1]):
            w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= p2:
        w = w[:-1]

    return w.replace("Y", "y")
