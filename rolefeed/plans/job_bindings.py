"""End-to-end jobs bound to the driver tables: refresh (Q3), seed (Q5, Q6),
slug repair (Q7), report (Q8), table writes (S1, S3-S6) and the poll queue
(F5, W8, A10). Each has a DuckDB oracle that re-states it in SQL.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.urls import host
from ..operators import health
from ..operators.boards import registry_table
from ..sources import tables as T
from . import feed_bindings as FB
from ..session import cut_lineage, ensure_checkpoint_dir
from . import refresh as R
from . import repair as RP
from . import seed as SD
from . import sqlfrag as S
from .catalog import _sql_extract, register, table, ts_text

# ---------------------------------------------------------------------------
# Q3 refresh: greenhouse payloads of every (board, run) of orders; runs whose
# block is a multiple of 5 failed with 503, of 11 (otherwise) with 404.
# ---------------------------------------------------------------------------


REFRESH_BLOCK = 64  # order keys of a run: many runs a board


def refresh_inputs(spark, sf):
    b = FB.base(spark, sf, REFRESH_BLOCK)
    item = F.struct(
        F.col("oid").alias("id"),
        F.concat(F.lit("https://boards.greenhouse.io/"), F.col("slug"), F.lit("/jobs/"), F.col("oid"), F.lit("?gh_src=x")).alias("absolute_url"),
        F.col("title").alias("title"),
        F.concat(F.lit("<p>"), F.col("descr"), F.lit(" &amp; more</p>")).alias("content"),
        F.col("posted").alias("first_published"),
        F.struct(F.col("loc_text").alias("name")).alias("location"),
    )
    bronze = FB.bronze_rows(b.withColumn("item", item), "greenhouse", FB._json_root("jobs"), by_page=False)
    block = F.substring("run_id", 2, 16).cast("bigint")
    status = F.when(F.pmod(block, F.lit(5)) == 0, F.lit(503)).when(F.pmod(block, F.lit(11)) == 0, F.lit(404)).otherwise(F.lit(200))
    bronze = bronze.withColumn("http_status", status)
    c = table(spark, sf, "customer")
    companies = c.select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("company_slug"),
        F.lit("greenhouse").alias("ats_source"),
        F.when(F.col("c_acctbal") < -900, F.lit(False)).alias("still_active"),
        F.lit(None).cast("int").alias("fail_count"),
        F.lit(None).cast("timestamp").alias("last_polled_at"),
    )
    return bronze, companies


def _refresh(spark, sf):
    bronze, companies = refresh_inputs(spark, sf)
    # the derived bronze is read by every branch: materialise it once in the
    # session's checkpoint folder instead of re-deriving it per branch
    return R.refresh(cut_lineage(bronze), companies, feeds=["greenhouse"])


_SQL_REFRESH = FB.sql_base(REFRESH_BLOCK) + f""",
c AS (SELECT 'c' || c_custkey AS slug, CASE WHEN c_acctbal < -900 THEN false END AS still_active FROM customer),
r AS (SELECT bb.*, CASE WHEN block % 5 = 0 THEN 'error' WHEN block % 11 = 0 THEN 'dead404' ELSE 'ok' END AS status
      FROM bb JOIN c USING (slug) WHERE c.still_active IS NULL),
j AS (SELECT *, trim(descr || ' & more') AS description, {S.country_of(None, 'loc_text')} AS country,
             'https://job-boards.greenhouse.io/' || slug || '/jobs/' || oid AS canonical_url,
             'https://boards.greenhouse.io/' || slug || '/jobs/' || oid || '?gh_src=x' AS raw_url FROM r WHERE status = 'ok'),
g AS (SELECT *, {S.hard_gate('title', "''")} AS hard, {S.labels(S.field_text('title', 'description'), V.FIELD_RULES)} AS bag FROM j),
l AS (SELECT canonical_url, raw_url, title, slug AS company_slug, 'greenhouse' AS ats_source,
             array_to_string({S.keywords('hard', 'bag')}, '|') AS keywords_matched,
             {S.display_name('slug')} AS company,
             nullif(description, '') AS snippet, nullif(loc_text, '') AS location, nullif(country, '') AS country,
             CASE WHEN {S.is_unpaid('title', 'description')} THEN 'Unpaid' END AS pay,
             '{FB.FETCHED_AT}.000000' AS first_seen_at, '{FB.FETCHED_AT}.000000' AS last_seen_at, block
      FROM g WHERE len(hard) > 0 AND len(bag) > 0)"""


@register("Q3_refresh_listings", _SQL_REFRESH + """
SELECT canonical_url, company_slug, keywords_matched, company, snippet, pay, country, first_seen_at, last_seen_at FROM l""")
def q_refresh_listings(spark, sf):
    out = _refresh(spark, sf)["listings"]
    return out.select(
        "canonical_url", "company_slug", F.array_join("keywords_matched", "|").alias("keywords_matched"), "company", "snippet", "pay", "country",
        ts_text(F.col("first_seen_at")).alias("first_seen_at"), ts_text(F.col("last_seen_at")).alias("last_seen_at"),
    )


@register("Q3_refresh_companies", FB.sql_base(REFRESH_BLOCK) + f""",
c AS (SELECT 'c' || c_custkey AS slug, CASE WHEN c_acctbal < -900 THEN false END AS still_active FROM customer),
r AS (SELECT DISTINCT slug, block, CASE WHEN block % 5 = 0 THEN 'error' WHEN block % 11 = 0 THEN 'dead404' ELSE 'ok' END AS status FROM bb),
f AS (SELECT slug, min(block) FILTER (WHERE status = 'dead404') AS ret FROM r GROUP BY slug),
s AS (SELECT r.slug, max(f.ret) AS ret, count(*) FILTER (WHERE r.status = 'ok' AND (f.ret IS NULL OR r.block < f.ret)) AS oks
      FROM r JOIN f USING (slug) GROUP BY r.slug)
SELECT c.slug AS company_slug,
       CASE WHEN c.still_active IS NULL AND s.oks > 0 THEN 0 END AS fail_count,
       CASE WHEN c.still_active IS NULL AND s.ret IS NOT NULL THEN false ELSE c.still_active END AS still_active,
       CASE WHEN c.still_active IS NULL AND s.oks > 0 THEN '{FB.FETCHED_AT}.000000' END AS last_polled_at
FROM c LEFT JOIN s USING (slug)""")
def q_refresh_companies(spark, sf):
    out = _refresh(spark, sf)["companies"]
    return out.select("company_slug", "fail_count", "still_active", ts_text(F.col("last_polled_at")).alias("last_polled_at"))


@register("Q8_listings_report", _SQL_REFRESH + """
SELECT ats_source, company_slug, company, pay, title, keywords_matched, location, country, first_seen_at, last_seen_at, canonical_url, raw_url FROM l""")
def q_report(spark, sf):
    out = _refresh(spark, sf)["listings"]
    rep = out.select(
        "ats_source", "company_slug", "company", "pay", "title", F.array_join("keywords_matched", "|").alias("keywords_matched"), "location",
        "country", ts_text(F.col("first_seen_at")).alias("first_seen_at"), ts_text(F.col("last_seen_at")).alias("last_seen_at"), "canonical_url", "raw_url",
    )
    return rep.orderBy("ats_source", "title")


@register("S1_scan_listings", _SQL_REFRESH + "\nSELECT canonical_url, title FROM l WHERE country = 'United States'")
def q_scan(spark, sf):
    out = _refresh(spark, sf)["listings"]
    return out.where(F.col("country") == "United States").select("canonical_url", "title").orderBy("title")


# ---------------------------------------------------------------------------
# Q5 seed: all events as organic results of the 14 bare site sweeps;
# combo = user_id % 14, page = day of month.
# ---------------------------------------------------------------------------
def seed_inputs(spark, sf):
    plan = SD.build_queries(SD.domains_table(spark), fields=[], include_bare=True)
    e = table(spark, sf, "events")
    combo = F.pmod(F.col("user_id"), F.lit(len(V.SEED_DOMAINS))).cast("int")
    ev = e.select("event_id", "user_id", "event_type", combo.alias("combo_idx"), F.dayofmonth("ts").alias("page"))
    ev = ev.join(plan.select("combo_idx", "domain", "ats"), "combo_idx")
    dom_kind = F.create_map(*[x for d, a, s in V.SEED_DOMAINS for x in (F.lit(d), F.lit(s))])
    kind = F.try_element_at(dom_kind, F.col("domain"))
    link = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("https://www.linkedin.com/jobs/view/"), F.col("event_id")))
        .when(F.col("ats") == "workday", F.concat(F.lit("https://co"), F.col("user_id"), F.lit(".wd1.myworkdayjobs.com/en-US/Site/job/"), F.col("event_id")))
        .when(kind == "path", F.concat(F.lit("https://"), F.col("domain"), F.lit("/co"), F.col("user_id"), F.lit("/"), F.col("event_id")))
        .otherwise(F.concat(F.lit("https://co"), F.col("user_id"), F.lit("."), F.col("domain"), F.lit("/jobs/"), F.col("event_id")))
    )
    results = ev.select("combo_idx", "page", F.col("event_id").alias("position"), link.alias("link"), F.concat(F.lit("Result "), F.col("event_id")).alias("title"))
    responses = results.groupBy("combo_idx", "page").agg(F.count(F.lit(1)).alias("n_results")).withColumn("credits", F.lit(None).cast("int"))
    return plan, responses, results


def _seed(spark, sf):
    plan, responses, results = seed_inputs(spark, sf)
    return plan, SD.spending(responses), SD.flatten(results, plan)


_DOMAIN_VALUES = ", ".join(f"({i}, {S.q(d)}, {S.q(a)}, {S.q(s)})" for i, (d, a, s) in enumerate(V.SEED_DOMAINS))
_SQL_SEED = f"""
WITH sd(ordinal, domain, ats, slug_in) AS (VALUES {_DOMAIN_VALUES}),
plan AS (SELECT ordinal AS combo_idx, 'site:' || domain AS q, domain, ats, slug_in FROM sd),
ev AS (SELECT event_id, user_id, event_type, CAST(user_id % {len(V.SEED_DOMAINS)} AS INTEGER) AS combo_idx, CAST(day(ts) AS INTEGER) AS page FROM events),
res AS (SELECT ev.combo_idx, ev.page, ev.event_id AS position, 'Result ' || ev.event_id AS title,
               CASE WHEN event_type = 'signup' THEN 'https://www.linkedin.com/jobs/view/' || event_id
                    WHEN plan.ats = 'workday' THEN 'https://co' || user_id || '.wd1.myworkdayjobs.com/en-US/Site/job/' || event_id
                    WHEN plan.slug_in = 'path' THEN 'https://' || plan.domain || '/co' || user_id || '/' || event_id
                    ELSE 'https://co' || user_id || '.' || plan.domain || '/jobs/' || event_id END AS url
        FROM ev JOIN plan USING (combo_idx)),
kept AS (SELECT combo_idx, page, row_number() OVER (ORDER BY page, combo_idx) - 1 AS spent_before FROM (SELECT DISTINCT combo_idx, page FROM res)),
kr AS (SELECT res.*, row_number() OVER () AS rid FROM res),""" + _sql_extract("kr", V.SEED_DOMAINS) + """,
flat AS (SELECT e.rid, e.combo_idx, plan.q AS query, e.page, e.position, e.url, coalesce(e.ats_source, plan.ats) AS ats,
                coalesce(e.company_slug, '') AS slug, e.title AS title FROM e JOIN plan USING (combo_idx))"""


@register("W5_W6_W7_requests", _SQL_SEED.split(",\nkr AS")[0] + "\nSELECT combo_idx, page, CAST(spent_before AS BIGINT) AS spent_before FROM kept")
def q_requests(spark, sf):
    _, kept, _ = _seed(spark, sf)
    return kept.select("combo_idx", "page", F.col("spent_before").cast("bigint").alias("spent_before"))


@register("Q5_P17_seed_rows", _SQL_SEED + "\nSELECT query, page, position, url, ats, slug, title FROM flat")
def q_seed_rows(spark, sf):
    _, _, flat = _seed(spark, sf)
    return flat.select("query", "page", "position", "url", "ats", "slug", "title")


@register("A5_seed_pairs", _SQL_SEED + "\nSELECT DISTINCT slug AS company_slug, ats AS ats_source FROM flat WHERE slug <> ''")
def q_seed_pairs(spark, sf):
    _, _, flat = _seed(spark, sf)
    return SD.seed_pairs(flat)


@register("A9_seed_summary", _SQL_SEED + f"""
SELECT CAST((SELECT count(*) FROM plan) AS BIGINT) AS queries, CAST((SELECT count(*) FROM kept) AS BIGINT) AS credits,
       CAST((SELECT count(*) FROM flat) AS BIGINT) AS rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT slug, ats FROM flat WHERE slug <> '')) AS BIGINT) AS unique_pairs""")
def q_seed_summary(spark, sf):
    plan, kept, flat = _seed(spark, sf)
    return SD.summary(plan, kept, flat).select(
        F.col("queries").cast("bigint"), F.col("credits").cast("bigint"), F.col("rows").cast("bigint"), F.col("unique_pairs").cast("bigint")
    )


# ---------------------------------------------------------------------------
# Q6 query plan: the hosts of pages as domains (numbered by their first page),
# the fixed field list as slices.
# ---------------------------------------------------------------------------
def _host_domains(spark, sf) -> DataFrame:
    p = table(spark, sf, "pages").select(host("url").alias("domain"), F.col("page_id").alias("id")).where(F.col("domain") != "")
    return p.groupBy("domain").agg(F.min("id").alias("ordinal")).select(
        "ordinal", "domain", F.concat(F.lit("site_"), F.pmod(F.col("ordinal"), F.lit(5))).alias("ats"))


_FIELDS_VALUES = ", ".join(f"({i}, {S.q(f)})" for i, f in enumerate([""] + list(V.FIELD_TERMS)))
_SQL_PLAN = f"""
WITH f(f_ord, field) AS (VALUES {_FIELDS_VALUES}),
h AS (SELECT {S.host('url')} AS domain, min(page_id) AS ordinal FROM pages GROUP BY 1 HAVING domain <> ''),
p AS (SELECT ordinal * {len(V.FIELD_TERMS) + 1} + f_ord AS combo_idx,
             'site:' || domain || CASE WHEN field <> '' THEN ' ' || field ELSE '' END AS q,
             domain, 'site_' || (ordinal % 5) AS ats, field
      FROM h CROSS JOIN f)"""


@register("Q6_J8_query_plan", _SQL_PLAN + "\nSELECT combo_idx, q, domain, ats, field FROM p")
def q_plan(spark, sf):
    return SD.build_queries(_host_domains(spark, sf))


@register("A6_plan_profile", _SQL_PLAN + """
SELECT CAST(count(*) AS BIGINT) AS combos, CAST(count(*) FILTER (WHERE field = '') AS BIGINT) AS bare,
       CAST(count(*) FILTER (WHERE field <> '') AS BIGINT) AS sliced, CAST(count(DISTINCT domain) AS BIGINT) AS domains,
       CAST(count(DISTINCT field) FILTER (WHERE field <> '') AS BIGINT) AS fields FROM p""")
def q_plan_profile(spark, sf):
    return SD.preview(SD.build_queries(_host_domains(spark, sf)))


@register("L2_query_limit", _SQL_PLAN + "\nSELECT combo_idx, q FROM p WHERE combo_idx < 100")
def q_plan_limit(spark, sf):
    return SD.limit_queries(SD.build_queries(_host_domains(spark, sf)), 100).select("combo_idx", "q")


# ---------------------------------------------------------------------------
# Q7 workday repair: capture text from events, verification by tenant number,
# workday boards from customer segments.
# ---------------------------------------------------------------------------
def repair_inputs(spark, sf):
    e = table(spark, sf, "events")
    url = F.when(
        F.col("event_type").isin("click", "purchase"),
        F.concat(F.lit("https://co"), F.col("user_id"), F.lit(".wd"), F.pmod(F.col("user_id"), F.lit(5)) + 1, F.lit(".myworkdayjobs.com/en-US/Site"),
                 F.pmod(F.col("user_id"), F.lit(3)), F.lit("/job/R"), F.col("event_id")),
    ).otherwise(F.concat(F.lit("https://jobs.lever.co/co"), F.col("user_id"), F.lit("/"), F.col("event_id")))
    captures = e.select(F.concat(F.lit('{"link": "'), url, F.lit('", "q": "site:myworkdayjobs.com"}')).alias("value"))
    candidates = cut_lineage(RP.harvest_composites(captures))  # read by the verification and every branch of the plan
    verification = candidates.select("composite", F.when(F.pmod(F.regexp_extract("composite", "^co([0-9]+)", 1).cast("int"), F.lit(4)) == 0, F.lit(404)).otherwise(F.lit(200)).alias("http_status"))
    c = table(spark, sf, "customer")
    slug = (
        F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), F.concat(F.lit("co"), F.col("c_custkey")))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("co"), F.col("c_custkey"), F.lit(".wd"), F.pmod(F.col("c_custkey"), F.lit(5)) + 1, F.lit("/Site"), F.pmod(F.col("c_custkey"), F.lit(3))))
        .otherwise(F.concat(F.lit("c"), F.col("c_custkey")))
    )
    ats = F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY", "BUILDING"), F.lit("workday")).otherwise(F.lit("greenhouse"))
    companies = c.select(slug.alias("company_slug"), ats.alias("ats_source"), F.lit(None).cast("boolean").alias("still_active"))
    return RP.plan_repair(candidates, verification, companies) | {"companies": companies}


_SQL_REPAIR = f"""
WITH cap AS (SELECT '{{"link": "' || CASE WHEN event_type IN ('click', 'purchase')
                 THEN 'https://co' || user_id || '.wd' || ((user_id % 5) + 1) || '.myworkdayjobs.com/en-US/Site' || (user_id % 3) || '/job/R' || event_id
                 ELSE 'https://jobs.lever.co/co' || user_id || '/' || event_id END || '", "q": "site:myworkdayjobs.com"}}' AS value FROM events),
urls AS (SELECT unnest(regexp_extract_all(value, {S.q(V.WORKDAY_URL)})) AS url FROM cap),
u0 AS (SELECT url, row_number() OVER () AS rid FROM urls),""" + _sql_extract("u0", V.SEED_DOMAINS) + f""",
cand AS (SELECT DISTINCT company_slug AS composite FROM e WHERE ats_source = 'workday'),
ver AS (SELECT composite, CAST(regexp_extract(composite, '^co([0-9]+)', 1) AS INTEGER) % 4 <> 0 AS live FROM cand),
comp AS (SELECT CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN 'co' || c_custkey
                     WHEN c_mktsegment = 'BUILDING' THEN 'co' || c_custkey || '.wd' || ((c_custkey % 5) + 1) || '/Site' || (c_custkey % 3)
                     ELSE 'c' || c_custkey END AS company_slug,
                CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING') THEN 'workday' ELSE 'greenhouse' END AS ats_source FROM customer),
wd AS (SELECT * FROM comp WHERE ats_source = 'workday'),
bare AS (SELECT company_slug FROM wd WHERE NOT contains(company_slug, '/')),
new AS (SELECT composite FROM ver WHERE live AND composite NOT IN (SELECT company_slug FROM wd)),
covered AS (SELECT DISTINCT split_part(composite, '.', 1) AS t FROM ver WHERE live),
orph AS (SELECT company_slug FROM bare WHERE company_slug NOT IN (SELECT t FROM covered))"""


@register("Q7_J9_repair_added", _SQL_REPAIR + "\nSELECT composite AS company_slug, 'workday' AS ats_source FROM new")
def q_repair_added(spark, sf):
    return repair_inputs(spark, sf)["added"]


@register("Q7_F12_repair_retired", _SQL_REPAIR + "\nSELECT company_slug, 'workday' AS ats_source, false AS still_active FROM bare")
def q_repair_retired(spark, sf):
    return repair_inputs(spark, sf)["retired"]


@register("J10_repair_orphans", _SQL_REPAIR + "\nSELECT company_slug FROM orph")
def q_repair_orphans(spark, sf):
    return repair_inputs(spark, sf)["orphans"]


@register("A11_repair_report", _SQL_REPAIR + """
SELECT CAST((SELECT count(*) FROM cand) AS BIGINT) AS candidates, CAST((SELECT count(*) FROM ver WHERE live) AS BIGINT) AS verified,
       CAST((SELECT count(*) FROM ver WHERE NOT live) AS BIGINT) AS dead, CAST((SELECT count(*) FROM wd) AS BIGINT) AS workday_rows,
       CAST((SELECT count(*) FROM bare) AS BIGINT) AS bare, CAST((SELECT count(*) FROM new) AS BIGINT) AS to_add,
       CAST((SELECT count(*) FROM orph) AS BIGINT) AS orphans""")
def q_repair_report(spark, sf):
    return repair_inputs(spark, sf)["report"]


# ---------------------------------------------------------------------------
# S3-S6 on customer: upsert from negative balances and suppliers, patch,
# keyed delete and append.
# ---------------------------------------------------------------------------
def _cust(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))


def _upsert_src(spark, sf):
    c = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("key"), F.lit("DELINQUENT").alias("segment"), F.lit(None).cast("double").alias("balance")
    )
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000).alias("key"), F.lit("SUPPLIER").alias("segment"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s)


@register("S4_upsert", """
WITH t AS (SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation FROM customer),
s AS (SELECT c_custkey AS key, 'DELINQUENT' AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer WHERE c_acctbal < 0
      UNION ALL SELECT s_suppkey + 1000000, 'SUPPLIER', s_acctbal FROM supplier)
SELECT coalesce(t.key, s.key) AS key, t.name AS name,
       CASE WHEN s.key IS NOT NULL THEN s.segment ELSE t.segment END AS segment,
       CASE WHEN s.key IS NOT NULL THEN s.balance ELSE t.balance END AS balance, t.nation AS nation
FROM t FULL OUTER JOIN s ON t.key = s.key""")
def q_upsert(spark, sf):
    return T.merge(_cust(spark, sf), _upsert_src(spark, sf), ["key"])


@register("S5_patch", """
SELECT c_custkey AS key, c_name AS name, CASE WHEN c_acctbal > 9000 THEN 'VIP' ELSE c_mktsegment END AS segment,
       c_acctbal AS balance, c_nationkey AS nation FROM customer""")
def q_patch(spark, sf):
    return T.patch(_cust(spark, sf), F.col("balance") > 9000, {"segment": F.lit("VIP")})


@register("S6_delete", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation FROM customer
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)""")
def q_delete(spark, sf):
    n = table(spark, sf, "nation").where(F.col("n_regionkey") == 0).select(F.col("n_nationkey").alias("nation"))
    return T.delete(_cust(spark, sf), n, ["nation"])


@register("S3_append", """
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey + 1000000, s_name, NULL, s_acctbal, s_nationkey FROM supplier""")
def q_append(spark, sf):
    s = table(spark, sf, "supplier").select((F.col("s_suppkey") + 1000000).alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return _cust(spark, sf).unionByName(s, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Poll queue: customers as boards of five feeds (one not pollable).
# ---------------------------------------------------------------------------
SEGMENT_FEED = [("AUTOMOBILE", "greenhouse"), ("BUILDING", "lever"), ("FURNITURE", "breezy"), ("HOUSEHOLD", "workday"), ("MACHINERY", "icims")]
PER_HOST = 12


def queue_companies(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    feed = None
    for seg, ats in SEGMENT_FEED:
        feed = F.when(F.col("c_mktsegment") == seg, F.lit(ats)) if feed is None else feed.when(F.col("c_mktsegment") == seg, F.lit(ats))
    return c.select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("company_slug"),
        feed.alias("ats_source"),
        F.when(F.col("c_acctbal") < -500, F.lit(False)).alias("still_active"),
    )


_SEG_CASE = "CASE " + " ".join(f"WHEN c_mktsegment = {S.q(s)} THEN {S.q(a)}" for s, a in SEGMENT_FEED) + " END"
_REG_VALUES = ", ".join(f"({S.q(a)}, {S.q(s)}, {S.q(h) if h else 'NULL'})" for a, _, s, h in V.REGISTRY)
_SQL_QUEUE = f"""
WITH reg(ats, slug_in, api_host) AS (VALUES {_REG_VALUES}),
c AS (SELECT 'c' || c_custkey AS company_slug, {_SEG_CASE} AS ats_source, CASE WHEN c_acctbal < -500 THEN false END AS still_active FROM customer),
p AS (SELECT c.*, CASE WHEN reg.slug_in = 'path' THEN 'shared' ELSE 'unique' END AS host_class,
             CASE WHEN reg.slug_in = 'path' THEN reg.api_host END AS host
      FROM c JOIN reg ON reg.ats = c.ats_source WHERE c.still_active IS NULL OR c.still_active)"""


@register("F5_pollable", _SQL_QUEUE + "\nSELECT company_slug, ats_source FROM p")
def q_pollable(spark, sf):
    return health.pollable(queue_companies(spark, sf)).select("company_slug", "ats_source")


@register("W8_host_load", _SQL_QUEUE + """
SELECT host, CAST(count(*) AS BIGINT) AS boards, CAST(count(DISTINCT ats_source) AS BIGINT) AS feeds FROM p GROUP BY host""")
def q_host_load(spark, sf):
    return health.host_load(health.with_host(health.pollable(queue_companies(spark, sf)), registry_table(spark)))


@register("A10_queue_profile", _SQL_QUEUE + """
SELECT host_class, host, CAST(count(*) AS BIGINT) AS boards FROM p GROUP BY host_class, host
UNION ALL SELECT 'total', NULL, CAST(count(*) AS BIGINT) FROM c
UNION ALL SELECT 'pollable', NULL, CAST(count(*) AS BIGINT) FROM p""")
def q_queue_profile(spark, sf):
    return health.queue_profile(queue_companies(spark, sf), registry_table(spark))


# ---------------------------------------------------------------------------
# A1-A3 of a refresh: jobs seen, listings, boards with a match, retired boards.
# ---------------------------------------------------------------------------
@register("A1_A3_refresh_summary", _SQL_REFRESH + """,
polls AS (SELECT block, slug, status, count(*) AS seen FROM r GROUP BY ALL),
first404 AS (SELECT slug, min(block) AS block FROM polls WHERE status = 'dead404' GROUP BY slug)
SELECT 'r' || lpad(CAST(CAST(p.block AS BIGINT) AS VARCHAR), 8, '0') AS run_id,
       CAST(coalesce(sum(seen) FILTER (WHERE status = 'ok'), 0) AS BIGINT) AS jobs_seen,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors, CAST(count(*) FILTER (WHERE status = 'dead404') AS BIGINT) AS dead404,
       CAST((SELECT count(DISTINCT company_slug) FROM l WHERE l.block = p.block) AS BIGINT) AS boards_matched,
       CAST((SELECT count(DISTINCT canonical_url) FROM l WHERE l.block = p.block) AS BIGINT) AS listings,
       CAST((SELECT count(*) FROM first404 f WHERE f.block = p.block) AS BIGINT) AS retired
FROM polls p GROUP BY p.block""")
def q_refresh_summary(spark, sf):
    return _refresh(spark, sf)["summary"].select("run_id", "jobs_seen", "errors", "dead404", "boards_matched", "listings", "retired")


# ---------------------------------------------------------------------------
# A2 by stored sketches, beside the exact counts: years of orders as runs.
# ---------------------------------------------------------------------------
_SQL_URL = "'https://jobs.example.com/c' || o_custkey || '/' || substr(o_orderpriority, 1, 1)"
SKETCH_ERROR = 3 * 1.04 / (1 << 6)  # three standard errors of 2^12 registers


@register("A2_distinct_sketches", f"""
SELECT strftime(o_orderdate, '%Y') AS run_id, CAST(count(DISTINCT {_SQL_URL}) AS BIGINT) AS listings, true AS within FROM orders GROUP BY 1
UNION ALL SELECT 'all', CAST(count(DISTINCT {_SQL_URL}) AS BIGINT), true FROM orders""")
def q_distinct_sketches(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("run_id"),
        F.concat(F.lit("https://jobs.example.com/c"), F.col("o_custkey"), F.lit("/"), F.substring("o_orderpriority", 1, 1)).alias("canonical_url"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    health.listing_sketches(rows).write.parquet(path)
    sketches = spark.read.schema("run_id string, sketch binary").parquet(path)
    guess = health.united(sketches, "run_id").unionByName(health.united(sketches).select(F.lit("all").alias("run_id"), "listings"))
    exact = rows.groupBy("run_id").agg(F.count_distinct("canonical_url").alias("exact"))
    exact = exact.unionByName(rows.agg(F.count_distinct("canonical_url").alias("exact")).select(F.lit("all").alias("run_id"), "exact"))
    within = F.abs(F.col("listings") - F.col("exact")) <= F.col("exact") * SKETCH_ERROR
    return exact.join(guess, "run_id").select("run_id", F.col("exact").alias("listings"), within.alias("within"))


# ---------------------------------------------------------------------------
# Boards upserts: after discover (Q4), from a capture (Q5), after repair (Q7).
# ---------------------------------------------------------------------------
def _known_boards(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(F.concat(F.lit("co"), F.col("c_custkey")).alias("company_slug"), F.lit("lever").alias("ats_source"), F.col("c_nationkey").alias("fail_count"))


@register("Q5_S4_seed_boards", _SQL_SEED + """,
known AS (SELECT 'co' || c_custkey AS company_slug, 'lever' AS ats_source, c_nationkey AS fail_count FROM customer),
pairs AS (SELECT DISTINCT slug AS company_slug, ats AS ats_source FROM flat WHERE slug <> '')
SELECT company_slug, ats_source, known.fail_count FROM known FULL OUTER JOIN pairs USING (company_slug, ats_source)""")
def q_seed_boards(spark, sf):
    plan, _, results = seed_inputs(spark, sf)
    return SD.seed_boards(results, plan, _known_boards(spark, sf))


@register("Q7_S4_repair_companies", _SQL_REPAIR + """
SELECT coalesce(c.company_slug, n.composite) AS company_slug, coalesce(c.ats_source, 'workday') AS ats_source,
       CASE WHEN c.ats_source = 'workday' AND NOT contains(c.company_slug, '/') THEN false END AS still_active
FROM comp c FULL OUTER JOIN new n ON c.company_slug = n.composite AND c.ats_source = 'workday'""")
def q_repair_companies(spark, sf):
    plan = repair_inputs(spark, sf)
    return RP.apply_repair(plan["companies"], plan)


# ---------------------------------------------------------------------------
# Captures written as JSON lines, read back, flattened to CSV, read back.
# ---------------------------------------------------------------------------
@register("S11_S13_capture_round_trip", _SQL_SEED + "\nSELECT query, page, position, url, ats, slug, title FROM flat")
def q_capture_round_trip(spark, sf):
    plan, responses, results = seed_inputs(spark, sf)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/captures-{uuid.uuid4().hex}"
    # one capture per result here: how results are grouped into pages is the fetcher's business
    rows = results.join(plan, "combo_idx").select(
        "q", "domain", "ats", "field", F.col("page").cast("int").alias("page"),
        F.struct(F.lit(1).alias("credits"), F.array(F.struct(F.col("position").cast("int").alias("position"), "link", "title")).alias("organic")).alias("response"))
    SD.write_captures(rows, f"{base}/raw")
    _, back = SD.read_captures(spark, f"{base}/raw", plan)
    SD.write_flat_csv(SD.flatten(back, plan), f"{base}/flat")
    schema = "query string, field string, page int, position bigint, url string, ats string, slug string, title string"
    flat = spark.read.schema(schema).option("header", True).csv(f"{base}/flat")
    return flat.select("query", "page", "position", "url", "ats", F.coalesce("slug", F.lit("")).alias("slug"), "title")
