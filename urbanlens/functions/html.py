r"""Elements of stored HTML pages as column expressions: tags, balanced contents, attributes, text, character references.

An element's contents end at the closing tag that belongs to its opening tag, however many elements of its name lie inside. The text is split before every
tag of that name; running sums over the pieces give each its depth, and an opening tag's element ends before the next piece that is one
level up (at the end of the text if there is none). Where the first closing tag already
belongs to the opening one, a regular expression says the same, and only the other texts go through the split. Comments and the raw text
of scripts and styles hold no elements. Attribute values may stand in double, single or no quotes, and quoted ones may hold ``>``.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'=]++)"""
_ATTRIBUTE = rf"""(?:\s+[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+|\s*+/(?!>))"""
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def opening(name: str) -> str:
    """Pattern of any opening tag of a name."""
    return rf"<{name}(?=[\s/>]){_REST}"


def opening_with(name: str, css_class: str) -> str:
    """Pattern of an opening tag with a class among those of its ``class`` attribute, wherever that stands."""
    classes = rf""""(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}(?=[\s>/])"""
    return rf"<{name}(?={_ATTRIBUTE}*?\s+class\s*+=\s*+(?:{classes})){_REST}"


def closing(name: str) -> str:
    return rf"</{name}(?=[\s/>])[^>]*>"


def _lit(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


# The expressions are written as SQL text: built call by call, one of them takes a thousand calls to the JVM. ``html`` and the
# like are names of columns or other SQL expressions.

def _visible(html: str) -> str:
    without_comments = f"CASE WHEN contains({html}, '<!--') THEN regexp_replace({html}, {_lit('(?s)<!--.*?(?:-->|$)')}, '') ELSE {html} END"
    raw = r"(?is)<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)"
    return _let("vh", without_comments, f"CASE WHEN vh RLIKE '(?i)<(?:script|style)' THEN regexp_replace(vh, {_lit(raw)}, '') ELSE vh END")


def visible(html: str) -> Column:
    """The page without comments and without scripts and styles."""
    return F.expr(_visible(html))


#: Elements of a block of running sums.
_BLOCK = 512


def _running_sums(steps: str) -> str:
    """Sums of an int array up to each element. Arrays grow by copying, so it goes block by block, not through the whole array at each step."""
    def sums(array: str, start: str) -> str:
        zero = f"named_struct('d', {start}, 'all', cast(array() AS array<int>))"
        return f"aggregate({array}, {zero}, (acc, x) -> named_struct('d', acc.d + x, 'all', concat(acc.all, array(acc.d + x)))).all"

    blocks = f"transform(sequence(0, greatest(size(rs) - 1, 0), {_BLOCK}), i -> slice(rs, i + 1, {_BLOCK}))"
    totals = sums("transform(rb, b -> aggregate(b, 0, (u, y) -> u + y))", "0")
    each = sums("b", "CASE WHEN k > 0 THEN get(rt, k - 1) ELSE 0 END")
    return _let("rs", steps, _let("rb", blocks, _let("rt", totals, f"flatten(transform(rb, (b, k) -> {each}))")))


def _elements(html: str, name: str, css_class: str) -> str:
    own, begins, ends = f"(?i)^{opening_with(name, css_class)}", rf"(?i)^<{name}[\s/>]", rf"(?i)^</{name}[\s/>]"
    cut = rf"(?i)(?=</?{name}[\s/>])"
    depths = _running_sums(f"transform(ep, x -> CASE WHEN x RLIKE {_lit(begins)} THEN 1 WHEN x RLIKE {_lit(ends)} THEN -1 ELSE 0 END)")
    # pieces from an opening tag's to its closing tag's: the first later one that is one level up
    end = "cast(array_position(slice(ed, i + 1, size(ed)), ed[i - 1] - 1) AS int)"
    rest = f"array_join(slice(ep, i + 1, {_let('ee', end, 'CASE WHEN ee = 0 THEN size(ep) ELSE ee - 1 END')}), '')"
    found = f"filter(sequence(1, size(ep)), i -> ep[i - 1] RLIKE {_lit(own)})"
    return _let("ep", f"split({html}, {_lit(cut)}, -1)", _let("ed", depths, f"transform({found}, i -> concat(regexp_replace(ep[i - 1], {_lit(own)}, ''), {rest}))"))


def elements(html: str, name: str, css_class: str) -> Column:
    """``array<string>``: the inner HTML of every element with the class, in the order of their opening tags, elements inside such elements too."""
    return F.expr(_elements(html, name, css_class))


def _inside(name: str) -> str:
    return _lit(rf"(?i)<{name}[\s/>]")


def first_element(html: str, name: str, css_class: str) -> Column:
    """The inner HTML of the first element with the class; null without one."""
    pattern = f"(?is){opening_with(name, css_class)}(.*?){closing(name)}"
    unclear = f"fs = '' OR fs RLIKE {_inside(name)}"  # empty contents, no closing tag, no such element; one inside
    return F.expr(_let("fs", f"regexp_extract({html}, {_lit(pattern)}, 1)", f"CASE WHEN {unclear} THEN get({_elements(html, name, css_class)}, 0) ELSE fs END"))


def all_elements(html: str, name: str, css_class: str) -> Column:
    """:func:`elements`; where none of them holds an element of its name, by one regular expression."""
    pattern = f"(?is){opening_with(name, css_class)}(.*?)(?:{closing(name)}|$)"
    return F.expr(_let("fs", f"regexp_extract_all({html}, {_lit(pattern)}, 1)", f"CASE WHEN exists(fs, x -> x RLIKE {_inside(name)}) THEN {_elements(html, name, css_class)} ELSE fs END"))


#: References that pages use most, looked up first; the others come from Python's table of the HTML standard.
COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp", "pound", "euro", "ndash", "mdash", "hellip", "rsquo", "eacute")
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}


def _decoded(text: str) -> str:
    def table(names) -> str:  # one literal, not thousands: Spark folds it into a map
        return f"from_json({_lit(json.dumps({n: NAMED[n] for n in names}))}, 'map<string,string>')"

    code = "CASE WHEN dr RLIKE '^#[xX]' THEN cast(conv(substring(dr, 3, 6), 16, 10) AS bigint) WHEN startswith(dr, '#') THEN cast(substring(dr, 2, 7) AS bigint) END"
    number = _let("dc", code, "CASE WHEN dc > 0 AND dc <= 1114111 AND NOT dc BETWEEN 55296 AND 57343 THEN decode(unhex(lpad(hex(dc), 8, '0')), 'UTF-32') END")
    common = ", ".join(map(_lit, COMMON))
    char = f"CASE WHEN startswith(dr, '#') THEN {number} WHEN dr IN ({common}) THEN {table(COMMON)}[dr] WHEN dr <> '' THEN element_at({table(sorted(NAMED))}, dr) END"
    ref = f"regexp_extract(dp, {_lit('^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);')}, 1)"
    one = _let("dr", ref, f"coalesce(concat({char}, substring(dp, length(dr) + 2, length(dp))), concat('&', dp))")
    whole = _let("ds", "split(dt, '&', -1)", f"concat(ds[0], array_join(transform(slice(ds, 2, greatest(size(ds) - 1, 0)), dp -> {one}), ''))")
    return _let("dt", text, f"CASE WHEN contains(dt, '&') THEN {whole} ELSE dt END")


def _text(html: str) -> str:
    tags = rf"(?s)</?[a-zA-Z!]{_REST}"
    return _decoded(f"regexp_replace({html}, {_lit(tags)}, '')")


def decode_entities(text: str) -> Column:
    """Named, decimal and hexadecimal character references (with their semicolon) to characters; others stay as they are."""
    return F.expr(_decoded(text))


def element_text(html: str) -> Column:
    """Text of a piece of HTML: tags dropped, character references decoded."""
    return F.expr(_text(html))


def element_texts(pieces: str) -> Column:
    """:func:`element_text` of each string of an array."""
    return F.expr(f"transform({pieces}, piece -> {_text('piece')})")


def _attribute(tag: str, name: str) -> str:
    pattern = rf"""(?is)^<[a-z][^\s/>]*+{_ATTRIBUTE}*?\s+{name}\s*+=\s*+({_VALUE})"""
    unquoted = rf"""(?s)^["'](.*)["']$"""
    return _decoded(f"regexp_replace(regexp_extract({tag}, {_lit(pattern)}, 1), {_lit(unquoted)}, '$1')")


def attribute(tag: str, name: str) -> Column:
    """Value of the first attribute of that name in an opening tag, character references decoded; empty string without one."""
    return F.expr(_attribute(tag, name))


def links(html: str) -> Column:
    """``array<string>``: the ``href`` of every ``<a>`` of the page that has one, in order, character references decoded."""
    tags = f"regexp_extract_all({_visible(html)}, {_lit('(?i)(' + opening('a') + ')')}, 1)"
    has = rf"(?is)^<a{_ATTRIBUTE}*?\s+href\s*+="
    return F.expr(f"transform(filter({tags}, t -> t RLIKE {_lit(has)}), t -> {_attribute('t', 'href')})")
