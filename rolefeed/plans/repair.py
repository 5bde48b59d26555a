"""Workday slug repair.

Composite slugs ``tenant.wdN/Site`` are harvested from raw capture text,
split by a verification log into live and dead, and compared with the
workday boards already known: live composites not yet present are added,
and every bare-tenant board (no ``/``) is retired.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import merge
from ..functions import values as V
from ..operators.boards import extract_board


def harvest_composites(captures: DataFrame, text_col: str = "value") -> DataFrame:
    """E23 + P19: every distinct workday composite found in the raw text. The
    shuffle that finds the different URLs also deals them to tasks, by their size."""
    urls = captures.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(V.WORKDAY_URL), 0)).alias("url")).distinct()
    b = extract_board(urls, "url")
    return b.where(F.col("ats_source") == "workday").select(F.col("company_slug").alias("composite")).distinct()


def split_verified(candidates: DataFrame, verification: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates joined to their verification outcome (composite,
    http_status); 200 is live, anything else (or no answer) is dead."""
    v = verification.groupBy("composite").agg(F.max((F.col("http_status") == 200).cast("int")).alias("_live"))
    j = candidates.join(v, "composite", "left")
    live = F.coalesce(F.col("_live"), F.lit(0)) == 1
    return j.where(live).select("composite"), j.where(~live).select("composite")


def plan_repair(candidates: DataFrame, verification: DataFrame, companies: DataFrame) -> dict[str, DataFrame]:
    verified, dead = split_verified(candidates, verification)
    wd = companies.where(F.col("ats_source") == "workday").select("company_slug", "still_active")
    bare = wd.where(~F.col("company_slug").contains("/")).select("company_slug")  # F12
    have = wd.select(F.col("company_slug").alias("composite"))
    new = verified.join(have, "composite", "left_anti")  # J9 (same rows as verified.subtract(have), U5)
    covered = verified.select(F.split(F.col("composite"), r"\.", 2).getItem(0).alias("company_slug")).distinct()
    orphans = bare.join(covered, "company_slug", "left_anti")  # J10
    added = new.select(F.col("composite").alias("company_slug"), F.lit("workday").alias("ats_source"))
    retired = bare.select("company_slug", F.lit("workday").alias("ats_source"), F.lit(False).alias("still_active"))
    report = (
        candidates.agg(F.count(F.lit(1)).alias("candidates"))
        .select(
            "candidates",
            verified.agg(F.count(F.lit(1))).scalar().alias("verified"),
            dead.agg(F.count(F.lit(1))).scalar().alias("dead"),
            wd.agg(F.count(F.lit(1))).scalar().alias("workday_rows"),
            bare.agg(F.count(F.lit(1))).scalar().alias("bare"),
            new.agg(F.count(F.lit(1))).scalar().alias("to_add"),
            orphans.agg(F.count(F.lit(1))).scalar().alias("orphans"),
        )
    )  # A11
    return {"verified": verified, "dead": dead, "added": added, "retired": retired, "orphans": orphans, "report": report}


def apply_repair(companies: DataFrame, plan: dict[str, DataFrame]) -> DataFrame:
    """Q7 -> S4: the found boards added, the bare ones retired, in one upsert."""
    rows = plan["added"].withColumn("still_active", F.lit(None).cast("boolean")).unionByName(plan["retired"])
    return merge(companies, rows, ["company_slug", "ats_source"])
