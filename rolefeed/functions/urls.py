"""URL Column expressions.

``parse_url`` is not used: under ANSI mode it raises on malformed input and it
returns NULL for hosts containing ``_``. These expressions follow Python's
``urlsplit`` field boundaries instead: an optional ``scheme:`` prefix, an
optional ``//authority`` ending at the first of ``/?#``, and a path ending at
the first of ``?#``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, let, nonblank, py_strip

_SPLIT = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"


def _prepared(url) -> Column:
    u = py_strip(as_col(url))
    u = F.regexp_replace(u, r"[\t\r\n]", "")  # urlsplit drops these anywhere
    return F.regexp_replace(u, r"^[\x{00}-\x{20}]+", "")


def netloc(url) -> Column:
    return F.regexp_extract(_prepared(url), _SPLIT, 1)


def url_path(url) -> Column:
    return F.regexp_extract(_prepared(url), _SPLIT, 2)


def url_query(url) -> Column:
    return F.regexp_extract(_prepared(url), r"^[^?#]*\?([^#]*)", 1)


def host_of_netloc(nl) -> Column:
    """Lower-case, drop userinfo up to the first '@', drop the port."""
    h = F.lower(as_col(nl))
    h = F.regexp_replace(h, r"^[^@]*@", "")
    return F.regexp_replace(h, r":.*$", "")


def host(url) -> Column:
    return host_of_netloc(netloc(url))


def path_segments(url) -> Column:
    """Path split on '/', empty segments dropped."""
    return F.filter(F.split(url_path(url), "/"), lambda s: s != F.lit(""))


def normalize_url(url) -> Column:
    """Https, lower host without userinfo/port, no query or fragment,
    no trailing slashes, path case kept. NULL or '' gives NULL."""

    def body(u):
        p = F.regexp_replace(F.regexp_extract(u, _SPLIT, 2), r"/+$", "")
        h = host_of_netloc(F.regexp_extract(u, _SPLIT, 1))
        return let(p, lambda q: F.concat(F.lit("https://"), h, F.when((q == F.lit("")) | q.startswith("/"), q).otherwise(F.concat(F.lit("/"), q))))

    u = as_col(url)
    return F.when(nonblank(u).isNotNull(), let(_prepared(u), body))


def query_param(url, name: str) -> Column:
    """E5: first value of ``name`` in the query string, percent-decoded.
    ``parse_qsl`` keeps the last duplicate when turned into a dict; the last
    occurrence is taken here too."""
    q = url_query(url)
    vals = F.regexp_extract_all(q, F.lit(r"(?:^|[&;])" + name + r"=([^&;]*)"), 1)
    v = F.element_at(F.when(F.size(vals) > 0, vals), -1)
    return F.try_url_decode(F.regexp_replace(v, r"\+", " "))
