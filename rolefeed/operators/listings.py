"""Conformed jobs to listing rows.

Input: conformed jobs (``canonical_url, raw_url, title, description,
posted_at, employment_type, location, country, company, pay``) with
``company_slug, ats_source`` and ordering columns. Output: one row per
canonical URL in the ``listings`` shape, last poll wins.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import misc, rules
from ..functions import values as V
from ..functions.text import nonblank, truncate
from .dedup import last_wins

LISTING_COLUMNS = [
    "canonical_url", "raw_url", "title", "company_slug", "ats_source", "keywords_matched",
    "company", "snippet", "location", "country", "pay", "posted_at", "last_seen_at",
]


def computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a one-row generator (``inline`` of a one-element
    array). A later filter on them cannot be pushed beneath the generator, so
    the optimizer does not copy the expressions (and their inputs) into the
    filter and evaluate them twice; the generator itself costs nothing."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in cols.items()]))))


def gate(jobs: DataFrame, hard_rules=V.HARD_RULES, field_rules=V.FIELD_RULES, keep_failed: bool = False) -> DataFrame:
    """F1-F3 over conformed jobs: adds ``hard``, ``bag``, ``passed`` and
    ``keywords_matched``. The hard gate (title only) filters first so the
    field rules only run on rows that can still pass."""
    et = F.col("employment_type") if "employment_type" in jobs.columns else None
    d = computed(jobs, hard=rules.hard_gate(F.col("title"), et, hard_rules), _text=rules.field_text(F.col("title"), F.col("description")))
    if not keep_failed:
        d = d.where(F.size("hard") > 0)
    d = computed(d, bag=rules.match_labels(F.col("_text"), field_rules)).drop("_text")
    passed = (F.size("hard") > 0) & (F.size("bag") > 0)
    d = d.withColumn("passed", passed).withColumn(
        "keywords_matched", F.when(passed, rules.keywords(F.col("hard"), F.col("bag"))).otherwise(F.array().cast("array<string>"))
    )
    return d if keep_failed else d.where("passed")


def shape(jobs: DataFrame, seen_at: Column, hard_rules=V.HARD_RULES, field_rules=V.FIELD_RULES, cuts: Mapping[str, int] | None = None) -> DataFrame:
    """F4 + gates + P16: required fields, two gates, pay resolution. Texts are
    kept whole; ``cuts`` (column -> length, E20) shortens snippet, location or
    pay where a consumer wants a preview, and is off by default.
    Extra columns of ``jobs`` (ordering keys) are carried through."""
    d = gate(jobs, hard_rules, field_rules)
    d = d.where((F.col("canonical_url") != "") & (F.col("title") != ""))
    unpaid = misc.is_unpaid(F.col("title"), F.col("description"))
    pay = misc.resolve_pay(F.col("pay"), unpaid)
    cuts = cuts or {}

    def whole(name: str, value: Column) -> Column:
        value = F.coalesce(value, F.lit(""))
        return nonblank(truncate(value, cuts[name]) if name in cuts else value).alias(name)

    carried = [c for c in jobs.columns if c not in LISTING_COLUMNS and c not in ("description", "employment_type", "pay", "location", "country", "company")]
    return d.select(
        "canonical_url",
        "raw_url",
        "title",
        "company_slug",
        "ats_source",
        "keywords_matched",
        nonblank(F.col("company")).alias("company"),
        whole("snippet", F.col("description")),
        whole("location", F.col("location")),
        nonblank(F.col("country")).alias("country"),
        whole("pay", pay),
        F.col("posted_at").cast("string").alias("posted_at"),
        seen_at.alias("last_seen_at"),
        *[c for c in carried if c not in ("hard", "bag", "passed")],
    )


def dedup_listings(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per canonical URL, the last by ``order`` wins."""
    out = last_wins(rows, ["canonical_url"], order)
    return out.select(*LISTING_COLUMNS, *[c for c in out.columns if c not in LISTING_COLUMNS])
