"""Pay (E10, E11, F7), names (E6), dates (E7-E9) and outcome classes."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import as_col, let, let2, nonblank, nonblank_once, py_strip

UNICODE_CI = "(?iuU)"


# --- pay ---------------------------------------------------------------------
def _amount(v) -> Column:
    s = py_strip(as_col(v).cast("string"))
    return F.when(~s.isin("", "0", "0.0"), s)


def format_salary(minv, maxv, period, currency) -> Column:
    """E10: 'CUR lo–hi/period'; '' '0' '0.0' count as absent; equal ends collapse."""

    def body(lo, hi):
        amount = F.when(lo.isNotNull() & hi.isNotNull() & (lo != hi), F.concat(lo, F.lit("–"), hi)).otherwise(F.coalesce(lo, hi))
        cur = F.coalesce(py_strip(as_col(currency)), F.lit(""))
        per = F.coalesce(py_strip(as_col(period)), F.lit(""))
        return let2(amount, per, lambda a, p: F.when(a.isNotNull(), let(py_strip(F.concat(cur, F.lit(" "), a)), lambda out: F.when(p != F.lit(""), F.concat(out, F.lit("/"), p)).otherwise(out))))

    return let2(_amount(minv), _amount(maxv), body)


def is_unpaid(*texts) -> Column:
    """strong unpaid signal over the space-joined non-blank texts."""
    blob = F.concat_ws(" ", *[nonblank(t) for t in texts])
    return blob.rlike(UNICODE_CI + V.UNPAID_PATTERN)


def resolve_pay(pay, unpaid: Column) -> Column:
    """F8: structured pay wins, else 'Unpaid', else NULL."""
    return F.coalesce(nonblank(pay), F.when(unpaid, F.lit(V.UNPAID)))


# --- names -------------------------------------------------------------------
def capitalize(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 20)))


def display_name(slug) -> Column:
    """E6: '_' and '-' to spaces, drop all-digit words unless all are digits,
    capitalise each word; ''/NULL -> NULL."""

    def body(words):
        letters = F.filter(words, lambda w: ~w.rlike(r"^\p{Nd}+$"))
        chosen = let(letters, lambda x: F.when(F.size(x) > 0, x).otherwise(words))
        return nonblank_once(F.array_join(F.transform(chosen, capitalize), " "))

    s = as_col(slug)
    words = F.filter(F.split(F.regexp_replace(s, "[_-]", " "), r"(?U)[\s\x{1c}-\x{1f}]+", -1), lambda w: w != F.lit(""))
    return F.when(nonblank(s).isNotNull(), let(words, body))


# --- dates -------------------------------------------------------------------
_MS_MIN = -62135596800000  # 0001-01-01T00:00:00Z
_MS_MAX = 253402300799999  # 9999-12-31T23:59:59.999Z


def ms_to_iso(ms) -> Column:
    """Epoch milliseconds to an ISO-8601 UTC string; NULL, '' or bad -> NULL.
    Same text as Python's ``isoformat()``: fraction only when non-zero."""
    raw = as_col(ms).cast("string")
    n = F.when(raw.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(raw).cast("decimal(38,0)"))
    n = F.when(n.between(_MS_MIN, _MS_MAX), n.cast("bigint"))
    ts = F.timestamp_millis(n)
    frac = F.pmod(n, F.lit(1000))
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(
        n.isNotNull(),
        F.concat(base, F.when(frac != 0, F.concat(F.lit("."), F.lpad(frac.cast("string"), 3, "0"), F.lit("000"))).otherwise(F.lit("")), F.lit("+00:00")),
    )


def parse_iso(ts) -> Column:
    """ISO text ('Z' accepted) to timestamp; bad -> NULL."""
    return F.try_to_timestamp(F.regexp_replace(as_col(ts).cast("string"), "Z$", "+00:00"))


def relative_posted(text, as_of) -> Column:
    """E9: 'Posted Today' / 'Posted Yesterday' / 'Posted N Days Ago' -> ISO date
    relative to ``as_of`` (a date Column or 'yyyy-MM-dd' string); else NULL."""
    t = as_col(text)
    pat = UNICODE_CI + V.WORKDAY_POSTED
    word = F.lower(F.regexp_extract(t, pat, 1))
    n = F.regexp_extract(t, pat, 2)
    days = F.when(word == "today", F.lit(0)).when(word == "yesterday", F.lit(1)).when(n != "", n.cast("int"))
    base = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return F.when(t.rlike(pat), F.date_format(F.date_sub(base, days), "yyyy-MM-dd"))


# --- poll outcomes -----------------------------------------------------------
def outcome(http_status, error_kind, malformed=None) -> Column:
    """Status code / error kind -> ok | dead404 | pfail | error.
    conn and timeout failures and 410 count toward retirement (pfail); 404
    retires at once; 429/5xx/403/401 and adapter failures are 'error'."""
    st, ek = as_col(http_status), as_col(error_kind)
    bad = malformed if malformed is not None else F.lit(False)
    return (
        F.when(ek.isin("conn", "timeout"), F.lit("pfail"))
        .when(ek.isNotNull() & (ek != F.lit("")) & st.isNull(), F.lit("error"))
        .when(st == 404, F.lit("dead404"))
        .when(st == 410, F.lit("pfail"))
        .when(st.between(200, 299) & ~F.coalesce(bad, F.lit(False)), F.lit("ok"))
        .otherwise(F.lit("error"))
    )
