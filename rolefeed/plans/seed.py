"""Seed from search captures.

Captures are read, never requested: a response row per (combo, page) with its
credit cost and result count, and one row per organic result.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.boards import extract_board
from ..operators.streaks import running_sum
from ..sources.tables import merge

CAPTURE_SCHEMA = (
    "q string, domain string, ats string, field string, page int, "
    "response struct<credits:int, organic:array<struct<position:int, link:string, title:string>>>"
)
CSV_COLUMNS = ["query", "field", "page", "position", "url", "ats", "slug", "title"]


def domains_table(spark: SparkSession, domains: Sequence[tuple[str, str, str]] = V.SEED_DOMAINS) -> DataFrame:
    return spark.createDataFrame([(i, d, a, s) for i, (d, a, s) in enumerate(domains)], "ordinal int, domain string, ats string, slug_in string")


def build_queries(domains: DataFrame, fields: Sequence[str] = V.FIELD_TERMS, include_bare: bool = True) -> DataFrame:
    """A bare ``site:`` sweep per domain plus one combo per field, in
    plan order. The field list is a fixed parameter, so this is a generator
    over a literal array (linear in the domains), not a join."""
    entries = ([("", 0)] if include_bare else []) + [(f, i + 1) for i, f in enumerate(fields)]
    per = len(entries)
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(j).alias("f_ord")) for j, (f, _) in enumerate(entries)])
    d = domains.select("ordinal", "domain", "ats", F.explode(arr).alias("_f"))
    q = F.concat(F.lit("site:"), F.col("domain"), F.when(F.col("_f.field") != "", F.concat(F.lit(" "), F.col("_f.field"))).otherwise(F.lit("")))
    return d.select((F.col("ordinal") * per + F.col("_f.f_ord")).alias("combo_idx"), q.alias("q"), "domain", "ats", F.col("_f.field").alias("field"))


def preview(plan: DataFrame) -> DataFrame:
    """Combos, bare sweeps, field-sliced combos, distinct domains and fields."""
    return plan.agg(
        F.count(F.lit(1)).alias("combos"),
        F.count_if(F.col("field") == "").alias("bare"),
        F.count_if(F.col("field") != "").alias("sliced"),
        F.count_distinct("domain").alias("domains"),
        F.count_distinct(F.when(F.col("field") != "", F.col("field"))).alias("fields"),
    )


def limit_queries(plan: DataFrame, max_queries: int | None) -> DataFrame:
    """L2: the first ``max_queries`` combos in plan order."""
    return plan if not max_queries else plan.where(F.col("combo_idx") < max_queries)


def spending(responses: DataFrame) -> DataFrame:
    """W5 + W7 over a capture: the credits spent before each captured page, in
    breadth-first order (all page 1s, then page 2s). ``responses``: combo_idx,
    page, credits, n_results, one row per captured page; a page costs
    ``credits``, or 1 when missing or 0. Every captured page is kept: a capture
    holds what was requested, so no budget and no stop rule is replayed."""
    cost = F.when(F.coalesce(F.col("credits"), F.lit(0)) == 0, F.lit(1)).otherwise(F.col("credits"))
    r = responses.withColumn("cost", cost)
    bucket = F.struct(F.col("page").alias("page"), F.floor(F.col("combo_idx") / 1024).alias("block"))
    run = running_sum(r, [], ["page", "combo_idx"], bucket, F.col("cost"), name="_spent")
    return run.withColumn("spent_before", F.col("_spent") - F.col("cost")).drop("_spent")


def flatten(results: DataFrame, plan: DataFrame) -> DataFrame:
    """P17 + S13: one row per organic result of a capture: query, field, page,
    position, url, ats, slug, title. A URL that names no board keeps the
    combo's feed and an empty slug."""
    r = results.join(plan.select("combo_idx", "q", "field", F.col("ats").alias("_q_ats")), "combo_idx")
    b = extract_board(r.withColumnRenamed("link", "url"), "url")
    return b.select(
        "combo_idx",
        F.col("q").alias("query"),
        "field",
        "page",
        "position",
        "url",
        F.coalesce(F.col("ats_source"), F.col("_q_ats")).alias("ats"),
        F.coalesce(F.col("company_slug"), F.lit("")).alias("slug"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
    )


def seed_pairs(flat: DataFrame) -> DataFrame:
    """A5: distinct confident (company_slug, ats_source) pairs."""
    return flat.where(F.col("slug") != "").select(F.col("slug").alias("company_slug"), F.col("ats").alias("ats_source")).dropDuplicates()


def summary(plan: DataFrame, spent: DataFrame, flat: DataFrame) -> DataFrame:
    """Combos, credits used, result rows, unique pairs (one row, built from
    three one-row aggregates joined on a constant-free scalar form)."""
    combos = plan.agg(F.count(F.lit(1)).alias("c")).scalar()
    credits = spent.agg(F.coalesce(F.sum("cost"), F.lit(0))).scalar()
    rows = flat.agg(F.count(F.lit(1))).scalar()
    pairs = seed_pairs(flat).agg(F.count(F.lit(1))).scalar()
    return plan.sparkSession.range(1).select(combos.alias("queries"), credits.alias("credits"), rows.alias("rows"), pairs.alias("unique_pairs"))


def read_captures(spark: SparkSession, path: str, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JSONL captures -> (responses, results), with the combo of the plan
    whose query each capture answers, as ``spending`` and ``flatten`` take them."""
    c = spark.read.schema(CAPTURE_SCHEMA).json(path).join(plan.select("q", "combo_idx"), "q")
    responses = c.select("combo_idx", "page", F.col("response.credits").alias("credits"), F.size(F.coalesce("response.organic", F.array())).alias("n_results"))
    results = c.select("combo_idx", "page", F.explode("response.organic").alias("o")).select("combo_idx", "page", "o.position", "o.link", "o.title")
    return responses, results


def seed_boards(results: DataFrame, plan: DataFrame, companies: DataFrame) -> DataFrame:
    """Q5 -> S4: the boards of a capture upserted into ``companies``; known ones keep their columns."""
    return merge(companies, seed_pairs(flatten(results, plan)), ["company_slug", "ats_source"])


def write_captures(df: DataFrame, path: str) -> None:
    """Raw captures as JSON lines, before any parsing."""
    df.write.mode("errorifexists").json(path)


def write_flat_csv(flat: DataFrame, path: str) -> None:
    """The flattened view with a header."""
    flat.select(*CSV_COLUMNS).write.mode("errorifexists").option("header", True).csv(path)
