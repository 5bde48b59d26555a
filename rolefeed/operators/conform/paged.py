"""What surrounds the conformers: the detail worklist (J4, J5) and poll outcomes
(E22). A capture holds only pages that were fetched, so all of them are
conformed, whatever their number; the stop rules belong to the fetcher.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import misc
from ...functions.rules import hard_gate
from .feeds import BOARD, FEEDS, SEQ, conform, conform_all, term_rank

CONFORMERS: dict[str, Callable[..., DataFrame]] = {ats: partial(conform, ats) for ats in FEEDS}
conform_workday = CONFORMERS["workday"]

__all__ = ["BOARD", "CONFORMERS", "SEQ", "conform_all", "conform_workday", "detail_worklist", "poll_outcomes"]


def detail_worklist(items: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """J4 + J5: postings whose detail is still needed: they pass the title-only
    hard gate (a necessary condition of the two gates) and no detail payload of
    theirs (``company_slug, ats_source, item_key``) is stored yet."""
    et = F.col("employment_type") if "employment_type" in items.columns else None
    w = items.where(F.size(hard_gate(F.col("title"), et)) > 0)
    return w if details is None else w.join(details.select(*BOARD, "item_key"), [*BOARD, "item_key"], "left_anti")


def poll_outcomes(bronze: DataFrame) -> DataFrame:
    """E22 per (board, run): the first failing list request (by the terms'
    request order and page) decides the status; a list payload that is not valid JSON (JSON feeds) is
    an adapter failure, i.e. ``error``; a workday board without a site is an
    ``error``. Detail failures are tolerated. Otherwise ``ok``."""
    lst = bronze.where(F.coalesce(F.col("page_kind"), F.lit("list")) == "list")
    html_feeds = ["jazzhr", "jobvite"]
    malformed = ~F.col("ats_source").isin(*html_feeds) & F.try_parse_json(F.col("body")).isNull() & F.col("http_status").between(200, 299)
    bare_wd = (F.col("ats_source") == "workday") & ~F.col("company_slug").contains("/")
    st = misc.outcome(F.col("http_status"), F.col("error_kind"), malformed | bare_wd)
    d = lst.withColumn("_st", st)
    first_bad = F.min(F.when(F.col("_st") != "ok", F.struct(term_rank(), F.coalesce(F.col("term"), F.lit("")), "page_no", "_st")))
    return d.groupBy(*SEQ).agg(
        F.coalesce(first_bad.getField("_st"), F.lit("ok")).alias("status"),
        F.max("fetched_at").alias("finished_at"),
        F.max_by("profile", F.struct("fetched_at", term_rank(), "page_no", "profile")).alias("profile"),
    )
