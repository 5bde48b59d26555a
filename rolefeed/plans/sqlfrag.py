"""DuckDB SQL fragments for the oracle queries.

The oracles re-state each computation in plain SQL over the driver tables;
these helpers keep that SQL short. They are not used by the Spark jobs.
"""
from __future__ import annotations

from collections.abc import Sequence

from ..functions import values as V

# Python's whitespace set, spelled for RE2 (whose \s is ASCII only).
WS = r"[\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def py_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def nonblank(e: str) -> str:
    return f"nullif({e}, '')"


def ts_text(e: str) -> str:
    return f"strftime(CAST({e} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"


_SPLIT = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"


def _prepared(e: str) -> str:
    return f"regexp_replace(regexp_replace({py_strip(e)}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+', '')"


def host(e: str) -> str:
    nl = f"regexp_extract({_prepared(e)}, '{_SPLIT}', 1)"
    return f"regexp_replace(regexp_replace(lower({nl}), '^[^@]*@', ''), ':.*$', '')"


def path(e: str) -> str:
    return f"regexp_extract({_prepared(e)}, '{_SPLIT}', 2)"


def normalize_url(e: str) -> str:
    p = f"regexp_replace({path(e)}, '/+$', '')"
    return (
        f"CASE WHEN nullif({e}, '') IS NULL THEN NULL ELSE 'https://' || {host(e)} || "
        f"CASE WHEN {p} = '' OR starts_with({p}, '/') THEN {p} ELSE '/' || {p} END END"
    )


def path_segments(e: str) -> str:
    return f"list_filter(string_split({path(e)}, '/'), lambda x: x <> '')"


def strip_html_known(e: str) -> str:
    """E1 for inputs whose only references are &quot; &copy; &middot; &lt;
    &gt; &nbsp; and &amp; (decoded last, so a single pass is mimicked)."""
    s = e
    for ent, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        s = f"replace({s}, {q(ent)}, {q(ch)})"
    s = f"regexp_replace({s}, '<[^>]+>', ' ', 'g')"
    s = f"trim(regexp_replace({s}, '{WS}+', ' ', 'g'))"
    return f"CASE WHEN nullif({e}, '') IS NULL THEN '' ELSE {s} END"


def labels(text: str, rules: Sequence[tuple[str, str]], unicode_words: bool = False) -> str:
    """Labels of matching rules, in rule order (a DuckDB list)."""
    parts = []
    for lbl, p in rules:
        pat = p
        if unicode_words:
            pat = pat.replace(r"\b", r"(?:^|$|[^\p{L}\p{N}_])")
        parts.append(f"CASE WHEN regexp_matches(coalesce({text}, ''), {q('(?i)' + pat)}) THEN {q(lbl)} END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def hard_gate(title: str, etype: str | None) -> str:
    h = labels(title, V.HARD_RULES)
    if etype is None:
        return h
    return (
        f"CASE WHEN regexp_matches(coalesce({etype}, ''), '(?i)\\bintern') AND NOT list_contains({h}, 'intern') "
        f"THEN list_concat({h}, ['intern']) ELSE {h} END"
    )


def field_text(title: str, desc: str) -> str:
    return f"concat_ws(' ', nullif({title}, ''), nullif({desc}, ''))"


def keywords(hard: str, bag: str) -> str:
    return f"list_sort(list_distinct(list_concat({hard}, {bag})))"


def _map_literal(d: dict) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in d.items()) + "}"


def _country_table() -> dict:
    table: dict[str, str] = {}
    known = {name.lower(): name for name in set(V.ISO2.values()) | set(V.ALIASES.values())}
    aliases = {k.strip().lower().strip("."): v for k, v in V.ALIASES.items()}
    for src in (known, aliases, V.ISO2):
        table.update(src)
    return table


def canon(e: str) -> str:
    t = f"trim(lower({py_strip(e)}), '.')"
    non = "[" + ", ".join(q(x) for x in V.NON_COUNTRY) + "]"
    return f"CASE WHEN {t} <> '' AND NOT list_contains({non}, {t}) THEN {_map_literal(_country_table())}[{t}] END"


def title_case(e: str) -> str:
    runs = f"regexp_extract_all({e}, '[A-Za-z]+|[^A-Za-z]+')"
    return f"array_to_string(list_transform({runs}, lambda r: CASE WHEN regexp_matches(r, '^[A-Za-z]') THEN upper(r[1]) || lower(r[2:]) ELSE r END), '')"


def country_of(structured: str | None, location: str | None) -> str:
    non = "[" + ", ".join(q(x) for x in V.NON_COUNTRY) + "]"
    states = "[" + ", ".join(q(x) for x in V.US_STATES) + "]"
    steps = []
    if structured is not None:
        st = f"nullif({structured}, '')"
        s = py_strip(st)
        plaus = f"(length({s}) > 3 AND NOT list_contains({non}, lower({s})) AND regexp_full_match({s}, {q(V.COUNTRY_NAME_OK)}))"
        steps += [canon(st), f"CASE WHEN {st} IS NOT NULL AND {plaus} THEN {title_case(s)} END"]
    if location is not None:
        loc = f"nullif({location}, '')"
        segs = f"list_filter(list_transform(regexp_split_to_array({loc}, '[,/|;–—]|{WS}-{WS}'), lambda x: {py_strip('x')}), lambda x: x <> '')"
        us = f"CASE WHEN len({segs}) >= 2 AND len(list_filter({segs}, lambda x: list_contains({states}, upper(x)))) > 0 THEN 'United States' END"
        right = f"list_filter(list_transform(list_reverse({segs}), lambda x: {canon('x')}), lambda x: x IS NOT NULL)[1]"
        steps += [f"CASE WHEN {loc} IS NOT NULL THEN coalesce({us}, {right}) END"]
    return "coalesce(" + ", ".join(steps) + ")"


def display_name(e: str) -> str:
    words = f"list_filter(regexp_split_to_array(regexp_replace({e}, '[_-]', ' ', 'g'), '{WS}+'), lambda w: w <> '')"
    letters = f"list_filter({words}, lambda w: NOT regexp_full_match(w, '[0-9]+'))"
    chosen = f"CASE WHEN len({letters}) > 0 THEN {letters} ELSE {words} END"
    out = f"array_to_string(list_transform({chosen}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    return f"CASE WHEN nullif({e}, '') IS NULL THEN NULL ELSE nullif({out}, '') END"


def format_salary(lo: str, hi: str, per: str, cur: str) -> str:
    def amt(v):
        s = py_strip(f"CAST({v} AS VARCHAR)")
        return f"CASE WHEN {s} IN ('', '0', '0.0') THEN NULL ELSE {s} END"

    a, b = amt(lo), amt(hi)
    amount = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b} THEN {a} || '–' || {b} ELSE coalesce({a}, {b}) END"
    out = py_strip(f"coalesce({py_strip(cur)}, '') || ' ' || {amount}")
    p = f"coalesce({py_strip(per)}, '')"
    return f"CASE WHEN {amount} IS NULL THEN NULL WHEN {p} <> '' THEN {out} || '/' || {p} ELSE {out} END"


def is_unpaid(*texts: str) -> str:
    blob = "concat_ws(' ', " + ", ".join(f"nullif({t}, '')" for t in texts) + ")"
    return f"regexp_matches({blob}, {q('(?i)' + V.UNPAID_PATTERN)})"
