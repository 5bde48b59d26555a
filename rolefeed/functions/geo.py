"""Country inference (E15, E16, J12, J13) as Column expressions.

The lookup tables are literal maps folded into the plan once; a lookup is a
hash probe inside codegen, so no join or shuffle is involved.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import as_col, let, let2, nonblank, py_strip


def _norm_key(k: str) -> str:
    # Alias keys normalised the way tokens are (dots stripped at both ends),
    # so "u.s." in a feed maps to United States.
    return k.strip().lower().strip(".")


def _lookup_table() -> dict[str, str]:
    # Priority: code, then alias, then known display name.
    table: dict[str, str] = {}
    known = {name.lower(): name for name in set(V.ISO2.values()) | set(V.ALIASES.values())}
    for src in (known, {_norm_key(k): v for k, v in V.ALIASES.items()}, V.ISO2):
        table.update(src)
    return table


BUCKETS = 128


def _bucket(first: int | Column, chars: int | Column) -> int | Column:
    """The bucket of a key by its first character and its length."""
    return (first * 31 + chars) % BUCKETS


def _canon_maps() -> Column:
    """The lookup table without the tokens that name no country, in BUCKETS maps
    of a few keys each: a map is searched from end to end."""
    table = {k: v for k, v in _lookup_table().items() if k and k not in V.NON_COUNTRY}
    parts = [""] * BUCKETS
    for k in sorted(table):
        i = _bucket(ord(k[0]), len(k))
        parts[i] += ("\x02" if parts[i] else "") + f"{k}\x01{table[k]}"
    return F.array(*[F.str_to_map(F.lit(p), F.lit("\x02"), F.lit("\x01")) for p in parts])


_MAPS = None
_NON = None
_STATES = None


def _consts():
    global _MAPS, _NON, _STATES
    if _MAPS is None:
        _MAPS = _canon_maps()
        _NON = F.array(*[F.lit(x) for x in V.NON_COUNTRY])
        _STATES = F.array(*[F.lit(x) for x in V.US_STATES])
    return _MAPS, _NON, _STATES


def canon(token) -> Column:
    """One token (code, alias or known name) to a display country."""
    maps, _, _ = _consts()
    t = F.trim(F.lower(py_strip(as_col(token))), F.lit("."))
    return let(t, lambda t: F.try_element_at(F.get(maps, _bucket(F.ascii(t), F.length(t))), t))


def title_case(c) -> Column:
    """Python ``str.title`` for ASCII letters: capitalise every letter run."""
    runs = F.regexp_extract_all(as_col(c), F.lit(r"[A-Za-z]+|[^A-Za-z]+"), 0)
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.when(r.rlike("^[A-Za-z]"), F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 20)))).otherwise(r),
        ),
        "",
    )


def location_segments(location) -> Column:
    parts = F.split(as_col(location), r"(?U)" + V.COUNTRY_SPLIT, -1)
    return F.filter(F.transform(parts, py_strip), lambda s: s != F.lit(""))


def _country_body(st: Column | None, loc: Column | None) -> Column:
    _, non, states = _consts()
    steps = []
    if st is not None:
        def plausible_name(s):
            ok = (F.length(s) > 3) & ~F.array_contains(non, F.lower(s)) & s.rlike("^(?:" + V.COUNTRY_NAME_OK + ")$")
            return F.when(ok, title_case(s))

        steps += [canon(st), F.when(st.isNotNull(), let(py_strip(st), plausible_name))]
    if loc is not None:
        def from_segments(segs):
            us = F.when((F.size(segs) >= 2) & F.exists(segs, lambda x: F.array_contains(states, F.upper(x))), F.lit("United States"))
            right = F.try_element_at(F.filter(F.transform(F.reverse(segs), canon), lambda x: x.isNotNull()), F.lit(1))
            return F.coalesce(us, right)

        steps += [F.when(loc.isNotNull(), let(location_segments(loc), from_segments))]
    return F.coalesce(*steps)


def country_of(structured=None, location=None) -> Column:
    """Structured token, else plausible structured name, else US state in a
    multi-part location, else right-most recognised segment, else NULL.
    Each input is bound once (``let``) so the plan stays small."""
    if structured is None and location is None:
        return F.lit(None).cast("string")
    if structured is None:
        return let(nonblank(as_col(location)), lambda l: _country_body(None, l))
    if location is None:
        return let(nonblank(as_col(structured)), lambda s: _country_body(s, None))
    return let2(nonblank(as_col(structured)), nonblank(as_col(location)), _country_body)
