"""Prune (Q1, Q2, A7, A8, J1, E21): drop listings a healthy board no longer serves.

Buckets, in priority order: orphan (no board row), dead (board retired),
gone (board polled OK more than ``margin`` after the listing was last seen,
both stamps present), keep. A safety gate refuses to delete when the doomed
share is strictly above ``safety`` (an empty table never trips it).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import values as V
from ..session import ensure_checkpoint_dir
from ..sources.tables import KeyedTable

BOARD = ["company_slug", "ats_source"]


class PruneAborted(RuntimeError):
    pass


def classify(listings: DataFrame, companies: DataFrame, margin_hours: float = V.STALE_MARGIN_HOURS) -> DataFrame:
    """Q1: listings plus ``bucket``. J1 is a left join on the board key with a
    presence marker; the companies side is one row per board, so a board
    holding a third of all listings is a skewed key on the listings side only,
    which AQE's skew-join split handles (left side of a left outer join)."""
    c = companies.select(*BOARD, F.col("still_active").alias("_active"), F.col("last_polled_at").alias("_polled"), F.lit(True).alias("_present"))
    j = listings.join(c, BOARD, "left")
    seen = F.col("last_seen_at")
    margin = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(margin_hours) * 3600.0))
    gone = F.col("_polled").isNotNull() & seen.isNotNull() & (F.col("_polled") > seen + margin)
    bucket = (
        F.when(F.col("_present").isNull(), F.lit("orphan"))
        .when(F.col("_active") == F.lit(False), F.lit("dead"))
        .when(gone, F.lit("gone"))
        .otherwise(F.lit("keep"))
    )
    return j.withColumn("bucket", bucket).drop("_active", "_polled", "_present")


def report(classified: DataFrame, safety: float = V.SAFETY_FRACTION) -> DataFrame:
    """A7 + A8: one row with bucket counts, doomed share and the gate verdict."""
    b = F.col("bucket")
    r = classified.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(b == "gone").alias("gone"),
        F.count_if(b == "dead").alias("dead"),
        F.count_if(b == "orphan").alias("orphan"),
    )
    doomed = F.col("gone") + F.col("dead") + F.col("orphan")
    share = F.when(F.col("total") > 0, doomed / F.col("total")).otherwise(F.lit(0.0))
    return r.select("total", "gone", "dead", "orphan", doomed.alias("doomed"), share.alias("share"), (share > F.lit(safety)).alias("breach"))


def bucket_counts(classified: DataFrame) -> DataFrame:
    """A7 as rows: bucket, listings, share of all listings."""
    g = classified.groupBy("bucket").agg(F.count(F.lit(1)).alias("listings"))
    total = classified.agg(F.count(F.lit(1)).alias("t")).scalar()
    return g.withColumn("share", F.col("listings") / total)


def _counted(classified: DataFrame, safety: float) -> tuple[DataFrame, dict]:
    """The classified rows written once, and the report over them, counted by
    the tasks that wrote them: no second scan for the verdict."""
    spark = classified.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/classified-{uuid.uuid4().hex}"
    counts, b = Observation(), F.col("bucket")
    classified.observe(counts, F.count(F.lit(1)).alias("total"), *[F.count_if(b == x).alias(x) for x in ("gone", "dead", "orphan")]).write.parquet(path)
    n = counts.get
    doomed = n["gone"] + n["dead"] + n["orphan"]
    share = doomed / n["total"] if n["total"] else 0.0
    return spark.read.schema(classified.schema).parquet(path), {**n, "doomed": doomed, "share": share, "breach": share > safety}


def survivors(classified: DataFrame, safety: float = V.SAFETY_FRACTION) -> DataFrame:
    """Q2: the listings left after pruning. When the gate trips nothing is
    deleted (every row survives). The join with the boards runs once, in the
    write that also counts the buckets."""
    rows, rep = _counted(classified, safety)
    return rows if rep["breach"] else rows.where(F.col("bucket") == "keep")


def run_prune(listings: KeyedTable, companies: DataFrame, dry_run: bool = False, margin_hours: float = V.STALE_MARGIN_HOURS,
              safety: float = V.SAFETY_FRACTION) -> dict:
    """Q2: classify, gate (one-row action), then delete the doomed rows. A dry
    run reports the breach instead of raising."""
    keyed = classify(listings.read(), companies, margin_hours).select("canonical_url", "bucket")
    keyed, rep = _counted(keyed, safety)
    if rep["breach"] and not dry_run:
        raise PruneAborted(f"would prune {rep['doomed']}/{rep['total']} ({rep['share']:.0%} > {safety:.0%})")
    if dry_run or rep["doomed"] == 0:
        return {**rep, "deleted": 0}
    listings.delete(keyed.where(F.col("bucket") != "keep").select("canonical_url"))
    return {**rep, "deleted": rep["doomed"]}
