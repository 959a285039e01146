"""DuckDB SQL of the Porter2 rules, stated on their own (nothing is imported from the code under test)."""

from __future__ import annotations

_V, _C = "[aeiouy]", "[^aeiouy]"
_SHORT = f"(?s)(?:^{_V}{_C}|{_C}{_V}[^aeiouywxY])\\z"
_REGION = f"(?s)^.*?{_V}{_C}"
# Fixed values of the published rules.
_WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
          "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
          "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
_STOP = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
_SECOND = {"tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate",
           "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous",
           "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": ""}
_THIRD = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
_FOURTH = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ending(endings) -> str:
    return f"regexp_extract(w, '(?:{'|'.join(sorted(endings, key=len, reverse=True))})\\z', 0)"


def _case(table: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in table.items()) + " END"


def _step(number: str, before: str, value: str, endings=None) -> str:
    """One CTE: the word after a step; ``e`` is the ending found, ``b`` the word without it."""
    found = f"SELECT *, {_ending(endings)} AS e FROM {before}" if endings else f"SELECT *, '' AS e FROM {before}"
    based = f"SELECT *, substr(w, 1, length(w) - length(e)) AS b FROM ({found})"
    return f"{number} AS MATERIALIZED (SELECT token, p1, p2, done, {value} AS w FROM ({based}))"


def stem_ctes(words: str, name: str = "stemmed") -> str:
    """CTEs that end in ``name(token, stem)`` for the distinct ``token`` values of the relation ``words``."""
    mark = f"regexp_replace(regexp_replace(regexp_replace(lower(token), '^''', ''), '^y', 'Y'), '({_V})y', '\\1Y', 'g')"
    mended = (f"CASE WHEN regexp_matches(b, '(?:at|bl|iz)\\z') THEN b || 'e' WHEN regexp_matches(b, '(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)\\z') THEN substr(b, 1, length(b) - 1)"
              f" WHEN p1 >= length(b) AND regexp_matches(b, '{_SHORT}') THEN b || 'e' ELSE b END")
    one_less = "substr(w, 1, length(w) - 1)"
    steps = [
        f"s_mark AS MATERIALIZED (SELECT token, {mark} AS w FROM (SELECT DISTINCT token FROM {words}))",
        f"s_one AS MATERIALIZED (SELECT *, CASE WHEN regexp_matches(w, '^(?:gener|arsen)') THEN 5 WHEN starts_with(w, 'commun') THEN 6"
        f" WHEN regexp_matches(w, '{_REGION}') THEN length(regexp_extract(w, '{_REGION}', 0)) ELSE length(w) END AS p1 FROM s_mark)",
        f"s_two AS MATERIALIZED (SELECT *, CASE WHEN regexp_matches(substr(w, p1 + 1), '{_REGION}') THEN p1 + length(regexp_extract(substr(w, p1 + 1), '{_REGION}', 0))"
        f" ELSE length(w) END AS p2, CASE WHEN length(token) <= 2 THEN lower(token) ELSE {_case(_WHOLE, 'lower(token)')} END AS done FROM s_one)",
        _step("s0", "s_two", "regexp_replace(w, '(?:''s''|''s|'')\\z', '')"),
        _step("s1", "s0", f"CASE WHEN ends_with(w, 'sses') THEN substr(w, 1, length(w) - 2) WHEN regexp_matches(w, 'ie[ds]\\z') THEN substr(w, 1, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)"
              f" WHEN regexp_matches(w, '[us]s\\z') THEN w WHEN regexp_matches(w, '(?s){_V}.+s\\z') THEN {one_less} ELSE w END"),
        f"s1a AS MATERIALIZED (SELECT token, p1, p2, coalesce(done, CASE WHEN w IN ({', '.join(map(_q, _STOP))}) THEN w END) AS done, w FROM s1)",
        _step("s1b", "s1a", f"CASE WHEN starts_with(e, 'eed') THEN CASE WHEN length(b) >= p1 THEN b || 'ee' ELSE w END WHEN e <> '' AND regexp_matches(b, '{_V}') THEN {mended} ELSE w END",
              ("eed", "eedly", "ed", "edly", "ing", "ingly")),
        _step("s1c", "s1b", f"regexp_replace(w, '(?s)^(.+{_C})[yY]\\z', '\\1i')"),
        _step("s2", "s1c", "CASE WHEN e = '' OR length(b) < p1 THEN w WHEN e = 'ogi' THEN CASE WHEN ends_with(b, 'l') THEN b || 'og' ELSE w END"
              f" WHEN e = 'li' THEN CASE WHEN regexp_matches(b, '[cdeghkmnrt]\\z') THEN b ELSE w END ELSE b || {_case(_SECOND, 'e')} END", _SECOND),
        _step("s3", "s2", f"CASE WHEN e = '' OR length(b) < p1 OR (e = 'ative' AND length(b) < p2) THEN w ELSE b || {_case(_THIRD, 'e')} END", _THIRD),
        _step("s4", "s3", "CASE WHEN e = '' OR length(b) < p2 OR (e = 'ion' AND NOT regexp_matches(b, '[st]\\z')) THEN w ELSE b END", _FOURTH),
        _step("s5", "s4", f"CASE WHEN ends_with(w, 'e') THEN CASE WHEN length(w) - 1 >= p2 OR (length(w) - 1 >= p1 AND NOT regexp_matches({one_less}, '{_SHORT}')) THEN {one_less} ELSE w END"
              f" WHEN ends_with(w, 'll') AND length(w) - 1 >= p2 THEN {one_less} ELSE w END"),
        f"{name} AS MATERIALIZED (SELECT token, coalesce(done, replace(w, 'Y', 'y')) AS stem FROM s5)",
    ]
    return ",\n".join(steps)
