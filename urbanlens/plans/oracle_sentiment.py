"""DuckDB oracle SQL for the sentiment rules (N1), built stage by stage."""

from __future__ import annotations

from collections.abc import Mapping

from urbanlens.operators import sentiment as S


def _s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _in(c: str, items) -> str:
    items = list(items)
    if not items:
        return "false"
    return f"coalesce({c} IN ({', '.join(_s(i) for i in items)}), false)"


def _eq(c: str, v: str) -> str:
    return f"coalesce({c} = {_s(v)}, false)"


def _lookup(c: str, d: Mapping[str, float]) -> str:
    """Value of ``c`` in a small constant mapping (NULL when absent)."""
    by_value: dict[float, list[str]] = {}
    for k, v in d.items():
        by_value.setdefault(float(v), []).append(k)
    if not by_value:
        return "NULL::DOUBLE"
    arms = " ".join(f"WHEN {c} IN ({', '.join(_s(k) for k in keys)}) THEN {v!r}::DOUBLE"
                    for v, keys in by_value.items())
    return f"(CASE {arms} END)"


def _upper(c: str) -> str:
    return f"({c} = upper({c}) AND {c} <> lower({c}))"


def _negated(c: str, negators) -> str:
    return f"({_in(c, negators)} OR coalesce(contains({c}, 'n''t'), false))"


def sentiment_sql(posts_sql: str, key: str, text_expr: str, lexicon: Mapping[str, float],
                  boosters: Mapping[str, float], negators, idioms: Mapping[str, float],
                  carry: tuple[str, ...] = (), places: int = 4, rules: S.RuleWords = S.RULE_WORDS) -> str:
    """SQL returning ``(key, carry.., compound)`` for ``posts_sql`` rows."""
    punct = "[" + "".join("\\" + ch for ch in S.PUNCTUATION) + "]"
    edge = _s(f"^{punct}+|{punct}+$")
    lex_values = ", ".join(f"({_s(k)}, {float(v)!r}::DOUBLE)" for k, v in lexicon.items())
    cs = "".join(f", {c}" for c in carry)
    strip = (f"CASE WHEN length(regexp_replace(x, {edge}, '', 'g')) <= 2 THEN x "
             f"ELSE regexp_replace(x, {edge}, '', 'g') END")
    amp = (f"coalesce(least(length(txt) - length(replace(txt, '!', '')), {S.EXCL_MAX}) * {S.EXCL_PER_MARK}"
           f" + CASE WHEN length(txt) - length(replace(txt, '?', '')) <= 1 THEN 0.0"
           f" WHEN length(txt) - length(replace(txt, '?', '')) <= {S.QM_MAX_COUNT}"
           f" THEN (length(txt) - length(replace(txt, '?', ''))) * {S.QM_PER_MARK}"
           f" ELSE {S.QM_CAP} END, 0.0)")

    def nb(k: int) -> str:
        return f"CASE WHEN pos >= {k} THEN w[pos + 1 - {k}] END"

    stages = []
    # per-word context
    stages.append(f"""ctx AS MATERIALIZED (
  SELECT {key}{cs}, null_text, capdiff, but_pos, amp, pos, w0, p1, p2, p3,
    lower(n1r) AS n1, lower(n2r) AS n2
  FROM (SELECT {key}{cs}, null_text, capdiff, but_pos, amp,
          unnest(generate_series(0, len(w) - 1)) AS pos, unnest(w) AS w0,
          unnest(list_concat([NULL::VARCHAR], w)) AS p1,
          unnest(list_concat([NULL::VARCHAR, NULL::VARCHAR], w)) AS p2,
          unnest(list_concat([NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR], w)) AS p3,
          unnest(w[2:]) AS n1r, unnest(w[3:]) AS n2r
        FROM meta)
  WHERE pos IS NOT NULL)""")
    stages.append("""look AS MATERIALIZED (
  SELECT c.*, lower(w0) AS lw, lower(p1) AS l1, lower(p2) AS l2, lower(p3) AS l3,
    lx.v AS v0,
    coalesce(lower(p1) IN (SELECT t FROM lex), false) AS in1,
    coalesce(lower(p2) IN (SELECT t FROM lex), false) AS in2,
    coalesce(lower(p3) IN (SELECT t FROM lex), false) AS in3,
    coalesce(n1 IN (SELECT t FROM lex), false) AS inn1
  FROM ctx c LEFT JOIN lex lx ON lower(c.w0) = lx.t)""")
    no_near = f"({_eq('l1', rules.no)} OR {_eq('l2', rules.no)} OR ({_eq('l3', rules.no)} AND {_in('l1', rules.no_linked_by)}))"
    stages.append(f"""sa AS MATERIALIZED (SELECT *,
    CASE WHEN {no_near} THEN v0 * {S.N_SCALAR}
         WHEN {_eq('lw', rules.no)} AND n1 IS NOT NULL AND inn1 THEN 0.0 ELSE v0 END AS va FROM look)""")
    stages.append(f"""sb AS MATERIALIZED (SELECT *,
    CASE WHEN {_upper('w0')} AND capdiff THEN (CASE WHEN va > 0 THEN va + {S.C_INCR} ELSE va - {S.C_INCR} END)
         ELSE va END AS v_0 FROM sa)""")
    prev = "sb"
    so_this = rules.so_this
    for k in range(3):
        pk, lk, ink = f"p{k + 1}", f"l{k + 1}", f"in{k + 1}"
        v = f"v_{k}"
        b = _lookup(lk, boosters)
        sb = f"(CASE WHEN {v} < 0 THEN -({b}) ELSE {b} END)"
        s = (f"(CASE WHEN {b} IS NULL THEN 0.0 ELSE (CASE WHEN {_upper(pk)} AND capdiff THEN "
             f"(CASE WHEN {v} > 0 THEN {sb} + {S.C_INCR} ELSE {sb} - {S.C_INCR} END) ELSE {sb} END) END"
             f" * {S.BOOSTER_DECAY[k]})")
        stages.append(f"st{k}a AS MATERIALIZED (SELECT *, {v} + {s} AS nv{k} FROM {prev})")
        nv = f"nv{k}"
        if k == 0:
            neg = f"CASE WHEN {_negated('l1', negators)} THEN {nv} * {S.N_SCALAR} ELSE {nv} END"
        elif k == 1:
            neg = (f"CASE WHEN {_eq('l2', rules.never)} AND {_in('l1', so_this)} THEN {nv} * 1.25"
                   f" WHEN {_eq('l2', rules.without)} AND {_eq('l1', rules.doubt)} THEN {nv}"
                   f" WHEN {_negated('l2', negators)} THEN {nv} * {S.N_SCALAR} ELSE {nv} END")
        else:
            neg = (f"CASE WHEN ({_eq('l3', rules.never)} AND {_in('l2', so_this)}) OR {_in('l1', so_this)}"
                   f" THEN {nv} * 1.25"
                   f" WHEN {_eq('l3', rules.without)} AND ({_eq('l2', rules.doubt)} OR {_eq('l1', rules.doubt)}) THEN {nv}"
                   f" WHEN {_negated('l3', negators)} THEN {nv} * {S.N_SCALAR} ELSE {nv} END")
        stages.append(f"st{k}b AS MATERIALIZED (SELECT *, {neg} AS ng{k} FROM st{k}a)")
        res = f"ng{k}"
        last = f"st{k}b"
        if k == 2:
            def im(seq):
                return _lookup(seq, idioms)
            seqs = ["concat_ws(' ', l1, lw)", "concat_ws(' ', l2, l1, lw)", "concat_ws(' ', l2, l1)",
                    "concat_ws(' ', l3, l2, l1)", "concat_ws(' ', l3, l2)"]
            hit = "coalesce(" + ", ".join(im(q) for q in seqs) + f", {res})"
            stages.append(f"id1 AS MATERIALIZED (SELECT *, {hit} AS i1 FROM {last})")
            stages.append(f"""id2 AS MATERIALIZED (SELECT *, coalesce(CASE WHEN n1 IS NOT NULL THEN {im("concat_ws(' ', lw, n1)")} END, i1) AS i2 FROM id1)""")
            stages.append(f"""id3 AS MATERIALIZED (SELECT *, coalesce(CASE WHEN n2 IS NOT NULL THEN {im("concat_ws(' ', lw, n1, n2)")} END, i2) AS i3 FROM id2)""")
            grams = ["concat_ws(' ', l3, l2, l1)", "concat_ws(' ', l3, l2)", "concat_ws(' ', l2, l1)"]
            add = " + ".join(f"coalesce({_lookup(g, boosters)}, 0.0)" for g in grams)
            stages.append(f"id4 AS MATERIALIZED (SELECT *, i3 + {add} AS i4 FROM id3)")
            res, last = "i4", "id4"
        stages.append(f"st{k}c AS MATERIALIZED (SELECT *, CASE WHEN {pk} IS NOT NULL AND NOT {ink} THEN {res} "
                      f"ELSE v_{k} END AS v_{k + 1} FROM {last})")
        prev = f"st{k}c"
    least = (f"CASE WHEN {_eq('l1', rules.least)} AND NOT in1 AND l2 IS NOT NULL THEN"
             f" (CASE WHEN {_in('l2', rules.least_spared_after)} THEN v_3 ELSE v_3 * {S.N_SCALAR} END)"
             f" WHEN {_eq('l1', rules.least)} AND NOT in1 THEN v_3 * {S.N_SCALAR} ELSE v_3 END")
    skip = f"({_in('lw', list(boosters))} OR ({_eq('lw', 'kind')} AND {_eq('n1', 'of')}))"
    but = ("CASE WHEN but_pos >= 0 AND pos < but_pos THEN 0.5 "
           "WHEN but_pos >= 0 AND pos > but_pos THEN 1.5 ELSE 1.0 END")
    stages.append(f"""scored AS MATERIALIZED (SELECT {key}, (CASE WHEN v0 IS NULL OR {skip} THEN 0.0 ELSE {least} END)
    * ({but}) AS s FROM {prev})""")
    stages.append(f"sums AS MATERIALIZED (SELECT {key}, sum(s) AS sum_s FROM scored GROUP BY {key})")
    body = ",\n".join(stages)
    sm = "coalesce(sums.sum_s, 0.0)"
    amped = f"(CASE WHEN {sm} > 0 THEN {sm} + meta.amp WHEN {sm} < 0 THEN {sm} - meta.amp ELSE {sm} END)"
    norm = f"greatest(-1.0, least(1.0, {amped} / sqrt({amped} * {amped} + {S.NORM_ALPHA})))"
    mcs = "".join(f", meta.{c}" for c in carry)
    return f"""WITH lex AS (SELECT lower(t) AS t, max(v) AS v FROM (VALUES {lex_values}) AS x(t, v) GROUP BY 1),
src AS (SELECT {key}{cs}, {text_expr} AS txt FROM {posts_sql}),
wds AS (SELECT {key}{cs}, txt, list_transform(list_filter(string_split_regex(txt, '\\s+'), lambda t: t <> ''),
          lambda x: {strip}) AS w FROM src),
meta AS (SELECT {key}{cs}, txt IS NULL AS null_text, {amp} AS amp, w,
    coalesce(list_bool_or(list_transform(w, lambda x: {_upper('x')}))
             AND list_bool_or(list_transform(w, lambda x: NOT {_upper('x')})), false) AS capdiff,
    coalesce(list_position(list_transform(w, lambda x: lower(x)), {_s(rules.but)}), 0) - 1 AS but_pos
  FROM wds),
{body}
SELECT meta.{key}{mcs},
  CASE WHEN meta.null_text THEN NULL ELSE round({norm}, {places}) END AS compound
FROM meta LEFT JOIN sums ON meta.{key} = sums.{key}"""
