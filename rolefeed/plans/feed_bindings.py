"""Feed conformers bound to the driver tables.

Each order is a posting of board ``'c' || o_custkey``. Postings are packed
into bronze payloads of one run per block of order keys (so no payload grows
with the data) and pages of two within a run, so runs have several pages. The payload of each feed
is written in that feed's JSON/HTML dialect; the oracle computes the expected
conformed columns directly from orders and customer, without JSON.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.conform import paged as P
from ..operators.conform.common import BRONZE_SCHEMA
from ..session import ensure_checkpoint_dir
from . import sqlfrag as S
from .catalog import PRIORITY_TITLE, SAMPLE_COUNTRIES, SAMPLE_LOCATIONS, STATUS_DESC, _case, _sql_case, _sql_list, REGISTRY, register, table

RUN_BLOCK = 1 << 15  # order keys of a run; a customer has a handful of orders in it
PAGE_SIZE = 2
FETCHED_AT = "2024-06-15 12:00:00"


def base(spark, sf, run_block: int = RUN_BLOCK) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    d = o.join(c, o.o_custkey == c.c_custkey, "left")
    cc = F.array(*[F.lit(x) if x is not None else F.lit(None).cast("string") for x in SAMPLE_COUNTRIES])
    locs = F.array(*[F.lit(x) for x in SAMPLE_LOCATIONS])
    d = d.select(
        F.col("o_orderkey").alias("oid"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("slug"),
        F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("pr"),
        _case(F.col("o_orderpriority"), PRIORITY_TITLE, "Kitchen Intern").alias("title"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(_case(F.col("o_orderstatus"), STATUS_DESC, "")).alias("descr"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("posted_ms"),
        F.concat(F.lit("City"), F.pmod(F.col("o_custkey"), F.lit(7))).alias("city"),
        F.col("c_mktsegment").alias("region"),
        F.element_at(cc, (F.pmod(F.col("c_nationkey"), F.lit(len(SAMPLE_COUNTRIES))) + 1).cast("int")).alias("cc"),
        F.element_at(locs, (F.pmod(F.col("o_custkey"), F.lit(len(SAMPLE_LOCATIONS))) + 1).cast("int")).alias("loc_text"),
        F.col("c_name").alias("company"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Internship")).otherwise(F.lit("")).alias("etype"),
        F.floor(F.col("o_orderkey") / run_block).alias("block"),
    )
    # position within (board, run)
    w = Window.partitionBy("slug", "block").orderBy("oid")
    return d.withColumn("pos", F.row_number().over(w)).withColumn("page_no", F.floor((F.col("pos") - 1) / PAGE_SIZE).cast("int"))


def sql_base(run_block: int = RUN_BLOCK) -> str:
    return f"""
WITH o AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
b AS (SELECT o_orderkey AS oid, 'c' || o_custkey AS slug, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS pr,
             {_sql_case('o_orderpriority', PRIORITY_TITLE, 'Kitchen Intern')} AS title,
             CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {_sql_case('o_orderstatus', STATUS_DESC, '')} END AS descr,
             strftime(o_orderdate, '%Y-%m-%d') AS posted,
             'City' || (o_custkey % 7) AS city, c_mktsegment AS region,
             {_sql_list(SAMPLE_COUNTRIES)}[(c_nationkey % {len(SAMPLE_COUNTRIES)}) + 1] AS cc,
             {_sql_list(SAMPLE_LOCATIONS)}[(o_custkey % {len(SAMPLE_LOCATIONS)}) + 1] AS loc_text,
             c_name AS company, CASE WHEN o_orderstatus = 'P' THEN 'Internship' ELSE '' END AS etype,
             floor(o_orderkey / {run_block}) AS block
      FROM o),
bb AS (SELECT *, row_number() OVER (PARTITION BY slug, block ORDER BY oid) AS pos FROM b)"""


_SQL_BASE = sql_base()


def vjson(s: Column) -> Column:
    """A JSON string value as VARIANT (for polymorphic payload fields)."""
    return F.try_variant_get(F.parse_json(F.to_json(F.array(s))), "$[0]", "variant")


def bronze_rows(items: DataFrame, ats: str, wrap, slug: Column | None = None, by_page: bool = True, extra_page_cols=None) -> DataFrame:
    """Pack item structs into one list payload per (board, run[, page])."""
    keys = ["slug", "block"] + (["page_no"] if by_page else [])
    by_pos = lambda a, b: F.when(a.getField("pos") < b.getField("pos"), -1).when(a.getField("pos") > b.getField("pos"), 1).otherwise(0)
    g = items.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), F.col("item"))), by_pos).alias("_it"), *(extra_page_cols or []))
    arr = F.transform(F.col("_it"), lambda x: x.getField("item"))
    body = wrap(arr, g)
    return g.select(
        (slug if slug is not None else F.col("slug")).alias("company_slug"),
        F.lit(ats).alias("ats_source"),
        F.concat(F.lit("r"), F.lpad(F.col("block").cast("string"), 8, "0")).alias("run_id"),
        F.lit("FAST").alias("profile"),
        F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"),
        F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error_kind"),
        F.lit("list").alias("page_kind"),
        F.lit(None).cast("string").alias("term"),
        (F.col("page_no") if by_page else F.lit(0)).cast("int").alias("page_no"),
        F.lit(None).cast("string").alias("item_key"),
        body.alias("body"),
    )


def _of_other_runs(details: DataFrame, blank: str, only: Column | None = None) -> DataFrame:
    """The details as an earlier run stored them, an older version beside each,
    and a blank detail that a later run stored for the same posting. ``only``:
    where a blank detail is no defined case (the posting's own is blank too)."""
    at = F.col("fetched_at")
    rows = details if only is None else details.withColumn("_blank", F.get_json_object("body", "$.jobPostingInfo.jobDescription") != "<p></p>")
    later = (rows if only is None else rows.where(only)).withColumn("run_id", F.lit("r-later")).withColumn("fetched_at", at + F.make_interval(days=F.lit(2))).withColumn("body", F.lit(blank))
    older = details.withColumn("run_id", F.lit("r-older")).withColumn("fetched_at", at - F.make_interval(days=F.lit(9))).withColumn("body", F.regexp_replace("body", "<p>", "<p>Old "))
    first = details.withColumn("run_id", F.lit("r-first")).withColumn("fetched_at", at - F.make_interval(days=F.lit(1)))
    return first.unionByName(older).unionByName(later.select(details.columns))


def _obj(**kv) -> Column:
    return F.struct(*[v.alias(k) for k, v in kv.items()])


def _json_root(key: str):
    return lambda arr, g: F.to_json(F.struct(arr.alias(key)))


def _json_array(arr, g):
    return F.to_json(arr)


OUT = ["company_slug", "canonical_url", "raw_url", "title", "description", "posted_at", "employment_type", "location", "country", "company", "pay"]


def _out(df: DataFrame) -> DataFrame:
    return df.select(*OUT)


def _sql_out(**e) -> str:
    return "SELECT " + ", ".join(f"{e[c]} AS {c}" for c in OUT)


FALLBACK = S.display_name("slug")


# --- P1 greenhouse ------------------------------------------------------------
@register("P1_conform_greenhouse", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://job-boards.greenhouse.io/' || slug || '/jobs/' || oid",
    raw_url="'https://boards.greenhouse.io/' || slug || '/jobs/' || oid || '?gh_src=x'",
    title="title", description="trim(descr || ' & more')",
    posted_at="CASE WHEN st = 'F' THEN posted || 'T00:00:00Z' ELSE posted END",
    employment_type="''", location="loc_text", country=S.country_of(None, "loc_text"),
    company=f"CASE WHEN pr = '2-HIGH' THEN {FALLBACK} ELSE company END", pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_greenhouse(spark, sf):
    return _out(P.CONFORMERS["greenhouse"](greenhouse_payloads(spark, sf)))


def greenhouse_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        id=F.col("oid"),
        absolute_url=F.concat(F.lit("https://boards.greenhouse.io/"), F.col("slug"), F.lit("/jobs/"), F.col("oid"), F.lit("?gh_src=x")),
        title=F.col("title"),
        content=F.concat(F.lit("<p>"), F.col("descr"), F.lit(" &amp; more</p>")),
        first_published=F.when(F.col("st") != "F", F.col("posted")),
        updated_at=F.concat(F.col("posted"), F.lit("T00:00:00Z")),
        company_name=F.when(F.col("pr") != "2-HIGH", F.col("company")),
        location=_obj(name=F.col("loc_text")),
    )
    bronze = bronze_rows(b.withColumn("item", item), "greenhouse", _json_root("jobs"), by_page=False)
    return bronze


# --- P2 lever -----------------------------------------------------------------
@register("P2_conform_lever", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://jobs.lever.co/' || slug || '/' || oid",
    raw_url="'https://jobs.lever.co/' || slug || '/' || oid || '/'",
    title="title", description="descr",
    posted_at="strftime(CAST(posted AS DATE), '%Y-%m-%dT%H:%M:%S') || '+00:00'",
    employment_type="etype", location="loc_text", country=S.country_of("cc", "loc_text"),
    company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_lever(spark, sf):
    return _out(P.CONFORMERS["lever"](lever_payloads(spark, sf)))


def lever_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        hostedUrl=F.concat(F.lit("https://jobs.lever.co/"), F.col("slug"), F.lit("/"), F.col("oid"), F.lit("/")),
        text=F.col("title"),
        descriptionPlain=F.col("descr"),
        createdAt=F.col("posted_ms"),
        country=F.col("cc"),
        categories=_obj(location=F.col("loc_text"), commitment=F.col("etype")),
    )
    bronze = bronze_rows(b.withColumn("item", item), "lever", _json_array, by_page=False)
    return bronze


# --- P3 ashby -----------------------------------------------------------------
@register("P3_conform_ashby", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="CASE WHEN st = 'O' THEN 'https://jobs.ashbyhq.com/' || slug || '/apply/' || oid ELSE 'https://jobs.ashbyhq.com/' || slug || '/' || oid END",
    raw_url="CASE WHEN st = 'O' THEN 'https://jobs.ashbyhq.com/' || slug || '/apply/' || oid ELSE 'https://Jobs.AshbyHQ.com/' || slug || '/' || oid || '?src=feed' END",
    title="title", description="descr", posted_at="posted", employment_type="etype",
    location="loc_text", country=S.country_of("cc", "loc_text"), company=FALLBACK,
    pay="CASE WHEN pr = '1-URGENT' THEN '$50K – $60K' ELSE 'EUR 1k' END",
) + " FROM bb WHERE NOT (pr = '4-NOT SPECIFIED' AND st = 'F')")
def q_ashby(spark, sf):
    return _out(P.CONFORMERS["ashby"](ashby_payloads(spark, sf)))


def ashby_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        isListed=~((F.col("pr") == "4-NOT SPECIFIED") & (F.col("st") == "F")),
        jobUrl=F.when(F.col("st") != "O", F.concat(F.lit("https://Jobs.AshbyHQ.com/"), F.col("slug"), F.lit("/"), F.col("oid"), F.lit("?src=feed"))).otherwise(F.lit("")),
        applyUrl=F.concat(F.lit("https://jobs.ashbyhq.com/"), F.col("slug"), F.lit("/apply/"), F.col("oid")),
        title=F.col("title"),
        descriptionPlain=F.col("descr"),
        publishedAt=F.col("posted"),
        employmentType=F.col("etype"),
        location=F.col("loc_text"),
        address=_obj(postalAddress=_obj(addressCountry=F.col("cc"))),
        compensation=_obj(
            compensationTierSummary=F.when(F.col("pr") == "1-URGENT", F.lit("$50K – $60K")).otherwise(F.lit("")),
            scrapeableCompensationSalarySummary=F.lit("EUR 1k"),
        ),
    )
    bronze = bronze_rows(b.withColumn("item", item), "ashby", _json_root("jobs"), by_page=False)
    return bronze


# --- P4 + P14 + S16 smartrecruiters -------------------------------------------
_SR_HARD = S.hard_gate("title", "etype")


@register("P4_P14_conform_smartrecruiters", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://jobs.smartrecruiters.com/' || slug || '/sr' || oid",
    raw_url="'https://jobs.smartrecruiters.com/' || slug || '/sr' || oid",
    title="title",
    description=f"CASE WHEN len({_SR_HARD}) > 0 THEN trim(descr || ' Python') ELSE region || ' Engineering' END",
    posted_at="posted", employment_type="etype", location="city",
    country=S.country_of("cc", "city"), company="company", pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_smartrecruiters(spark, sf):
    return _out(P.CONFORMERS["smartrecruiters"](smartrecruiters_payloads(spark, sf)))


def smartrecruiters_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        id=F.concat(F.lit("sr"), F.col("oid")),
        name=F.col("title"),
        releasedDate=F.col("posted"),
        department=_obj(label=F.col("region")),
        function=_obj(name=F.lit("Engineering")),
        typeOfEmployment=_obj(label=F.col("etype")),
        location=_obj(city=F.col("city"), country=F.col("cc")),
        company=_obj(name=F.col("company")),
    )
    items = b.withColumn("item", item)
    total = F.count(F.lit(1)).over(Window.partitionBy("slug", "block"))
    items = items.withColumn("_total", total)
    lst = bronze_rows(items, "smartrecruiters", lambda arr, g: F.to_json(F.struct(F.col("_total").alias("totalFound"), arr.alias("content"))),
                      extra_page_cols=[F.max("_total").alias("_total")])
    from ..functions.rules import hard_gate
    det = b.where(F.size(hard_gate(F.col("title"), F.col("etype"))) > 0).select(
        F.col("slug").alias("company_slug"), F.lit("smartrecruiters").alias("ats_source"), F.concat(F.lit("r"), F.lpad(F.col("block").cast("string"), 8, "0")).alias("run_id"),
        F.lit("FAST").alias("profile"), F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"), F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error_kind"), F.lit("detail").alias("page_kind"), F.lit(None).cast("string").alias("term"),
        F.lit(0).alias("page_no"), F.concat(F.lit("sr"), F.col("oid")).alias("item_key"),
        F.to_json(_obj(jobAd=_obj(sections=_obj(
            jobDescription=_obj(text=F.concat(F.lit("<p>"), F.col("descr"), F.lit("</p>"))),
            qualifications=_obj(text=F.lit("<ul><li>Python</li></ul>")),
            additionalInformation=_obj(text=F.lit("")),
        )))).alias("body"),
    )
    return lst.unionByName(_of_other_runs(det, '{"jobAd": {"sections": {"jobDescription": {"text": " "}}}}'))


# --- P5 + S15 workable ----------------------------------------------------------
@register("P5_conform_workable", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://apply.workable.com/' || slug || '/j/W' || oid",
    raw_url="'https://apply.workable.com/' || slug || '/j/W' || oid",
    title="title", description="region || ' Ops'", posted_at="posted", employment_type="etype",
    location="city", country=S.country_of("coalesce(nullif(cc, ''), 'XX')", "city"), company=FALLBACK,
    pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_workable(spark, sf):
    return _out(P.CONFORMERS["workable"](workable_payloads(spark, sf)))


def workable_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        shortcode=F.concat(F.lit("W"), F.col("oid")),
        title=F.col("title"),
        department=F.array(vjson(F.col("region")), F.try_variant_get(F.parse_json(F.lit("5")), "$", "variant"), vjson(F.lit("Ops"))),
        published=F.col("posted"),
        type=F.col("etype"),
        location=_obj(city=F.col("city"), country=F.col("cc"), countryCode=F.lit("XX")),
    )
    items = b.withColumn("item", item).withColumn("_last", F.max("page_no").over(Window.partitionBy("slug", "block")))
    wrap = lambda arr, g: F.to_json(F.struct(F.when(F.col("page_no") < F.col("_last"), F.concat(F.lit("tok"), F.col("page_no") + 1)).alias("nextPage"), arr.alias("results")))
    return bronze_rows(items, "workable", wrap, extra_page_cols=[F.max("_last").alias("_last")])


# --- P6 breezy ------------------------------------------------------------------
@register("P6_conform_breezy", _SQL_BASE + ",\nx AS (SELECT *, CASE WHEN st = 'O' THEN city || ', ' || (CASE WHEN st = 'F' THEN 'Texas' ELSE 'CA' END) ELSE loc_text END AS loc FROM bb)\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://' || slug || '.breezy.hr/p/' || oid || '-role'",
    raw_url="'https://' || slug || '.breezy.hr/p/' || oid || '-role/?src=x'",
    title="title", description="region", posted_at="posted", employment_type="etype",
    location="loc", country=S.country_of("cc", "loc"), company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM x")
def q_breezy(spark, sf):
    return _out(P.CONFORMERS["breezy"](breezy_payloads(spark, sf)))


def breezy_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    state = F.when(F.col("st") == "F", F.parse_json(F.lit('{"name": "Texas"}'))).otherwise(vjson(F.lit("CA")))
    country = F.when(F.col("st") == "P", F.try_variant_get(F.parse_json(F.to_json(_obj(name=F.col("cc")))), "$", "variant")).otherwise(vjson(F.col("cc")))
    item = _obj(
        url=F.concat(F.lit("https://"), F.col("slug"), F.lit(".breezy.hr/p/"), F.col("oid"), F.lit("-role/?src=x")),
        name=F.col("title"),
        department=F.col("region"),
        published_date=F.col("posted"),
        type=_obj(name=F.col("etype")),
        location=_obj(name=F.when(F.col("st") != "O", F.col("loc_text")), city=F.col("city"), state=state, country=country),
    )
    return bronze_rows(b.withColumn("item", item), "breezy", _json_array, by_page=False)


# --- P7 recruitee ---------------------------------------------------------------
@register("P7_conform_recruitee", _SQL_BASE + ",\nx AS (SELECT *, CASE WHEN st = 'F' THEN loc_text ELSE city || ', ' || region END AS loc FROM bb)\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://' || slug || '.recruitee.com/o/' || oid",
    raw_url="'https://' || slug || '.recruitee.com/o/' || oid || '/'",
    title="title",
    description="trim(CASE WHEN st = 'O' THEN descr || ' Python & SQL' ELSE descr END)",
    posted_at="posted", employment_type="etype", location="loc",
    country=S.country_of("coalesce(nullif(cc, ''), 'NL')", "loc"),
    company=f"CASE WHEN pr = '3-MEDIUM' THEN {FALLBACK} ELSE company END",
    pay=S.format_salary("CASE WHEN st = 'P' THEN '0' ELSE '2400' END", "CASE WHEN st = 'F' THEN '2400' ELSE '3000' END", "'month'", "'EUR'"),
) + " FROM x")
def q_recruitee(spark, sf):
    return _out(P.CONFORMERS["recruitee"](recruitee_payloads(spark, sf)))


def recruitee_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    item = _obj(
        careers_url=F.concat(F.lit("https://"), F.col("slug"), F.lit(".recruitee.com/o/"), F.col("oid"), F.lit("/")),
        title=F.col("title"),
        description=F.concat(F.lit("<p>"), F.col("descr"), F.lit("</p>")),
        requirements=F.when(F.col("st") == "O", F.lit("<ul><li>Python &amp; SQL</li></ul>")),
        published_at=F.col("posted"),
        employment_type_code=F.col("etype"),
        location=F.when(F.col("st") == "F", F.col("loc_text")).otherwise(F.lit("")),
        city=F.col("city"),
        state_name=F.lit(""),
        region=F.col("region"),
        country=F.col("cc"),
        country_code=F.lit("NL"),
        company_name=F.when(F.col("pr") != "3-MEDIUM", F.col("company")),
        salary=_obj(min=F.when(F.col("st") == "P", F.lit("0")).otherwise(F.lit("2400")), max=F.when(F.col("st") == "F", F.lit("2400")).otherwise(F.lit("3000")),
                    period=F.lit("month"), currency=F.lit("EUR")),
    )
    return bronze_rows(b.withColumn("item", item), "recruitee", _json_root("offers"), by_page=False)


# --- P8 rippling ------------------------------------------------------------------
@register("P8_conform_rippling", _SQL_BASE + ",\nx AS (SELECT *, CASE st WHEN 'F' THEN loc_text WHEN 'O' THEN 'Austin, TX' ELSE (CASE WHEN oid % 2 = 0 THEN 'Berlin, Germany' ELSE 'Remote - US' END) END AS loc FROM bb)\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://ats.rippling.com/' || slug || '/jobs/' || oid",
    raw_url="'https://ats.rippling.com/' || slug || '/jobs/' || oid",
    title="title", description="region", posted_at="CAST(NULL AS VARCHAR)", employment_type="''",
    location="loc", country=S.country_of(None, "loc"), company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM x")
def q_rippling(spark, sf):
    return _out(P.CONFORMERS["rippling"](rippling_payloads(spark, sf)))


def rippling_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    first = F.when(F.pmod(F.col("oid"), F.lit(2)) == 0, vjson(F.lit("Berlin, Germany"))).otherwise(F.parse_json(F.lit('{"name": "Remote - US"}')))
    item = _obj(
        url=F.concat(F.lit("https://ats.rippling.com/"), F.col("slug"), F.lit("/jobs/"), F.col("oid")),
        name=F.col("title"),
        workLocation=F.when(F.col("st") == "F", F.col("loc_text")),
        location=F.when(F.col("st") == "O", F.parse_json(F.lit('{"label": "Austin, TX"}'))),
        locations=F.when(F.col("st") == "P", F.array(first)),
        department=_obj(label=F.col("region")),
    )
    return bronze_rows(b.withColumn("item", item), "rippling", _json_array, by_page=False)


# --- P9 teamtailor ----------------------------------------------------------------
@register("P9_conform_teamtailor", _SQL_BASE + ",\nx AS (SELECT *, CASE WHEN st = 'O' THEN loc_text ELSE city || ', ' || region END AS loc FROM bb)\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://' || slug || '.teamtailor.com/jobs/' || oid",
    raw_url="'https://' || upper(slug) || '.teamtailor.com/jobs/' || oid",
    title="title", description="CASE WHEN descr = '' THEN 'Fallback text' ELSE descr END", posted_at="posted", employment_type="''",
    location="loc", country=f"CASE WHEN st = 'O' THEN {S.country_of(None, 'loc_text')} ELSE {S.country_of('cc', 'loc')} END",
    company=f"CASE WHEN cust % 2 = 0 THEN 'Feed ' || slug ELSE {FALLBACK} END",
    pay="CASE WHEN st = 'F' THEN 'EUR 500/day' ELSE 'EUR 1500–1700/month' END",
) + " FROM x")
def q_teamtailor(spark, sf):
    return _out(P.CONFORMERS["teamtailor"](teamtailor_payloads(spark, sf)))


def teamtailor_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    value = F.when(F.col("st") == "F", _obj(unitText=F.lit("DAY"), minValue=F.lit(None).cast("string"), maxValue=F.lit(None).cast("string"), value=F.lit("500"))).otherwise(
        _obj(unitText=F.lit("MONTH"), minValue=F.lit("1500"), maxValue=F.lit("1700"), value=F.lit(None).cast("string")))
    item = _obj(
        url=F.concat(F.lit("https://"), F.upper(F.col("slug")), F.lit(".teamtailor.com/jobs/"), F.col("oid")),
        title=F.col("title"),
        content_html=F.when(F.col("descr") != "", F.concat(F.lit("<p>"), F.col("descr"), F.lit("</p>"))),
        date_published=F.col("posted"),
        location=F.when(F.col("st") == "O", F.col("loc_text")),
        _jobposting=_obj(
            jobLocation=F.array(_obj(address=_obj(addressLocality=F.col("city"), addressRegion=F.col("region"), addressCountry=F.col("cc")))),
            baseSalary=_obj(currency=F.lit("EUR"), value=value),
            description=F.lit("<div>Fallback text</div>"),
        ),
    )
    items = b.withColumn("item", item)
    wrap = lambda arr, g: F.to_json(F.struct(F.when(F.pmod(F.col("cust"), F.lit(2)) == 0, F.concat(F.lit("Feed "), F.col("slug"))).alias("title"), arr.alias("items")))
    g = bronze_rows(items, "teamtailor", wrap, by_page=False, extra_page_cols=[F.first("cust").alias("cust")])
    return g


# --- P10 bamboohr -------------------------------------------------------------------
@register("P10_conform_bamboohr", _SQL_BASE + ",\nx AS (SELECT *, CASE st WHEN 'F' THEN 'Chicago, ON' WHEN 'O' THEN 'Remote' ELSE city || ', Illinois' END AS loc, CASE WHEN st = 'F' THEN 'Canada' ELSE cc END AS ctry FROM bb)\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://' || slug || '.bamboohr.com/careers/' || oid",
    raw_url="'https://' || slug || '.bamboohr.com/careers/' || oid",
    title="title", description="region", posted_at="CAST(NULL AS VARCHAR)", employment_type="etype",
    location="loc", country=S.country_of("ctry", "loc"), company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM x")
def q_bamboohr(spark, sf):
    return _out(P.CONFORMERS["bamboohr"](bamboohr_payloads(spark, sf)))


def bamboohr_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    ats_loc = F.when(F.col("st") == "F", F.parse_json(F.lit("{}"))).when(
        F.col("st") == "O", F.try_variant_get(F.parse_json(F.to_json(_obj(city=F.lit(""), country=F.col("cc")))), "$", "variant")
    ).otherwise(F.try_variant_get(F.parse_json(F.to_json(_obj(city=F.col("city"), state=F.lit("Illinois"), country=F.col("cc")))), "$", "variant"))
    item = _obj(
        id=F.col("oid"),
        jobOpeningName=F.col("title"),
        departmentLabel=F.col("region"),
        employmentStatusLabel=F.col("etype"),
        atsLocation=ats_loc,
        location=_obj(city=F.lit("Chicago"), province=F.lit("ON"), country=F.lit("Canada")),
        isRemote=F.col("st") == "O",
    )
    return bronze_rows(b.withColumn("item", item), "bamboohr", _json_root("result"), by_page=False)


# --- P11 jazzhr ----------------------------------------------------------------------
@register("P11_conform_jazzhr", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://' || slug || '.applytojob.com/apply/J' || oid",
    raw_url="'https://' || slug || '.applytojob.com/apply/J' || oid",
    title="title", description="''", posted_at="CAST(NULL AS VARCHAR)", employment_type="''",
    location="CASE WHEN st = 'O' THEN '' ELSE loc_text END",
    country=f"CASE WHEN st = 'O' THEN NULL ELSE {S.country_of(None, 'loc_text')} END",
    company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_jazzhr(spark, sf):
    return _out(P.CONFORMERS["jazzhr"](jazzhr_payloads(spark, sf)))


def jazzhr_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    li = F.concat(
        F.lit("<li class=\"list-group-item\">\n  <h3 class='list-group-item-heading'>\n    <a href=\"https://"), F.col("slug"),
        F.lit(".applytojob.com/apply/J"), F.col("oid"), F.lit("/Role-"), F.col("oid"), F.lit("\">\n      "), F.col("title"),
        F.lit("\n    </a>\n  </h3>\n"),
        F.when(F.col("st") != "O", F.concat(F.lit("  <ul class='list-inline'><li><i class='fa fa-map-marker'></i>"), F.col("loc_text"), F.lit("</li></ul>\n"))).otherwise(F.lit("")),
        F.lit("</li>\n"),
    )
    wrap = lambda arr, g: F.concat(F.lit("<html><body><ul>\n"), F.array_join(arr, ""), F.lit("</ul></body></html>"))
    return bronze_rows(b.withColumn("item", li), "jazzhr", wrap, by_page=False)


# --- P12 + S17 jobvite -------------------------------------------------------------------
@register("P12_conform_jobvite", _SQL_BASE + "\n" + _sql_out(
    company_slug="slug",
    canonical_url="'https://jobs.jobvite.com/' || slug || '/job/o' || oid",
    raw_url="'https://jobs.jobvite.com/' || slug || '/job/o' || oid",
    title="title", description="''", posted_at="CAST(NULL AS VARCHAR)", employment_type="''",
    location="city || ', ' || region", country=S.country_of(None, "city || ', ' || region"),
    company=FALLBACK, pay="CAST(NULL AS VARCHAR)",
) + " FROM bb")
def q_jobvite(spark, sf):
    return _out(P.CONFORMERS["jobvite"](jobvite_payloads(spark, sf)))


def jobvite_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    row = F.concat(
        F.lit('<tr>\n  <td class="jv-job-list-name">\n    <a href="/'), F.col("slug"), F.lit("/job/o"), F.col("oid"), F.lit('">'), F.col("title"),
        F.lit('</a>\n  </td>\n  <td class="jv-job-list-location">\n      '), F.col("city"), F.lit(",\n      "), F.col("region"), F.lit("\n  </td>\n</tr>\n"),
    )
    wrap = lambda arr, g: F.concat(F.lit("<table>"), F.array_join(arr, ""), F.lit("</table>"))
    return bronze_rows(b.withColumn("item", row), "jobvite", wrap)


# --- P13 + S18 + W2 + J6 workday -----------------------------------------------------------
_WD_SLUG = "slug || '.wd' || ((cust % 5) + 1) || '/Site' || (cust % 3)"


@register("P13_conform_workday", _SQL_BASE + f",\nx AS (SELECT *, {_WD_SLUG} AS wslug, len({S.hard_gate('title', None)}) > 0 AS det FROM bb)\n" + _sql_out(
    company_slug="wslug",
    canonical_url="'https://' || split_part(wslug, '/', 1) || '.myworkdayjobs.com/en-US/' || split_part(wslug, '/', 2) || '/job/' || city || '/R' || oid",
    raw_url="'https://' || split_part(wslug, '/', 1) || '.myworkdayjobs.com/en-US/' || split_part(wslug, '/', 2) || '/job/' || city || '/R' || oid",
    title="title",
    description="CASE WHEN det THEN descr ELSE '' END",
    posted_at="CASE WHEN det THEN posted WHEN st = 'F' THEN '2024-06-12' WHEN st = 'O' THEN '2024-06-15' END",
    employment_type="''",
    location="CASE WHEN det THEN 'Greater ' || city ELSE loc_text END",
    country=f"CASE WHEN det THEN 'United States' ELSE {S.country_of(None, 'loc_text')} END",
    company=S.display_name("slug"), pay="CAST(NULL AS VARCHAR)",
) + " FROM x")
def q_workday(spark, sf):
    return _out(P.CONFORMERS["workday"](workday_payloads(spark, sf)))


def workday_payloads(spark, sf) -> DataFrame:
    b = base(spark, sf)
    wslug = F.concat(F.col("slug"), F.lit(".wd"), F.pmod(F.col("cust"), F.lit(5)) + 1, F.lit("/Site"), F.pmod(F.col("cust"), F.lit(3)))
    path = F.concat(F.lit("/job/"), F.col("city"), F.lit("/R"), F.col("oid"))
    posted_on = F.when(F.col("st") == "F", F.lit("Posted 3 Days Ago")).when(F.col("st") == "O", F.lit("Posted Today")).otherwise(F.lit("Posted 30+ Days Ago"))
    item = _obj(title=F.col("title"), externalPath=path, locationsText=F.col("loc_text"), postedOn=posted_on)
    items = b.withColumn("item", item).withColumn("_total", F.count(F.lit(1)).over(Window.partitionBy("slug", "block"))).withColumn("wslug", wslug)
    wrap = lambda arr, g: F.to_json(F.struct(F.when(F.col("page_no") == 0, F.col("_total")).alias("total"), arr.alias("jobPostings")))
    lst = bronze_rows(items, "workday", wrap, slug=F.col("wslug"), extra_page_cols=[F.max("_total").alias("_total"), F.first("wslug").alias("wslug")])
    lst = lst.withColumn("term", F.lit("intern"))
    # the same postings also come back under a second term: first wins
    dup = lst.withColumn("term", F.lit("co-op")).withColumn("body", F.regexp_replace("body", "Posted Today", "Posted Yesterday"))
    from ..functions.rules import hard_gate
    det = b.where(F.size(hard_gate(F.col("title"))) > 0).select(
        wslug.alias("company_slug"), F.lit("workday").alias("ats_source"), F.concat(F.lit("r"), F.lpad(F.col("block").cast("string"), 8, "0")).alias("run_id"),
        F.lit("FAST").alias("profile"), F.lit(FETCHED_AT).cast("timestamp").alias("fetched_at"), F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error_kind"), F.lit("detail").alias("page_kind"), F.lit(None).cast("string").alias("term"),
        F.lit(0).alias("page_no"), path.alias("item_key"),
        F.to_json(_obj(jobPostingInfo=_obj(
            jobDescription=F.concat(F.lit("<p>"), F.col("descr"), F.lit("</p>")),
            location=F.concat(F.lit("Greater "), F.col("city")),
            country=_obj(descriptor=F.lit("United States of America")),
            startDate=F.col("posted"),
        ))).alias("body"),
    )
    return lst.unionByName(dup).unionByName(_of_other_runs(det, '{"jobPostingInfo": {"jobDescription": ""}}', F.col("_blank")))


# --- P15 + U1: all feeds in one payload table, conformed in one pass ---------------------------
_ROUTED = {
    "greenhouse": ("P1_conform_greenhouse", greenhouse_payloads), "lever": ("P2_conform_lever", lever_payloads),
    "ashby": ("P3_conform_ashby", ashby_payloads), "smartrecruiters": ("P4_P14_conform_smartrecruiters", smartrecruiters_payloads),
    "workable": ("P5_conform_workable", workable_payloads), "breezy": ("P6_conform_breezy", breezy_payloads),
    "recruitee": ("P7_conform_recruitee", recruitee_payloads), "rippling": ("P8_conform_rippling", rippling_payloads),
    "teamtailor": ("P9_conform_teamtailor", teamtailor_payloads), "bamboohr": ("P10_conform_bamboohr", bamboohr_payloads),
    "jazzhr": ("P11_conform_jazzhr", jazzhr_payloads), "jobvite": ("P12_conform_jobvite", jobvite_payloads),
    "workday": ("P13_conform_workday", workday_payloads),
}


def bronze_table(spark, sf) -> DataFrame:
    """The payloads of all feeds as one table in the shared folder, partitioned by feed."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze-{uuid.uuid4().hex}"
    for _, build in _ROUTED.values():
        build(spark, sf).write.mode("append").partitionBy("ats_source").parquet(path)
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


@register("P15_U1_conform_all", "SELECT * FROM (" + "\n) UNION ALL SELECT * FROM (".join(REGISTRY[name][1] for name, _ in _ROUTED.values()) + ")")
def q_conform_all(spark, sf):
    return _out(P.conform_all(bronze_table(spark, sf)))


# --- J4 + J5: postings that still need a detail ------------------------------------------------
@register("J4_J5_detail_worklist", _SQL_BASE + f"""
SELECT slug AS company_slug, 'sr' || oid AS item_key FROM bb WHERE len({_SR_HARD}) > 0 AND oid % 3 <> 0""")
def q_detail_worklist(spark, sf):
    b = base(spark, sf)
    items = b.select(F.col("slug").alias("company_slug"), F.lit("smartrecruiters").alias("ats_source"), F.concat(F.lit("sr"), F.col("oid")).alias("item_key"),
                     "title", F.col("etype").alias("employment_type"), "oid")
    stored = items.where(F.pmod(F.col("oid"), F.lit(3)) == 0)
    return P.detail_worklist(items, stored).select("company_slug", "item_key")
