"""Registered queries: each operator bound to the driver tables, plus an
independent DuckDB re-statement used as the correctness oracle.

Bindings (how the job-board operators read the TPC-H-style tables):

* pages        -> URL index and page text (E1-E4, W1, J7, P18, Q4)
* orders       -> postings (F1-F8, P16, W1) and boards for prune (Q1, Q2)
* lineitem     -> listings for prune (Q1, Q2)
* events       -> poll log: board = user_id, order = (ts, event_id);
                  error -> pfail, view -> error, a few signups -> dead404,
                  others -> ok (W3, W4, A1, A13)
* customer     -> boards table and locations (W8, A10, E6, E16, S4-S6)
* part, documents -> rule tables over names and whole texts (F1-F3)

Every query reads whole tables; nothing is sampled or capped.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, misc, rules, text, urls
from ..functions import values as V
from ..operators import dedup, health, listings
from ..operators.boards import classify_ats, extract_board
from . import discover as disc
from . import prune as pr
from . import sqlfrag as S
from ..session import ensure_checkpoint_dir
from ..sources.tables import KeyedTable

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ts_text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---------------------------------------------------------------------------
# Binding parameters (fixture values of the bindings, not reference values).
# ---------------------------------------------------------------------------
PAGE_RULES = [("copyright", "©"), ("german", r"\b(und|der|die)\b"), ("spanish", r"\b(para|los)\b")]
EXAMPLE_DOMAINS = [
    ("www.cheap-pills.example.com", "pills", "path"),
    ("example.com", "sites_com", "subdomain"),
    ("example.org", "sites_org", "subdomain"),
    ("example.net", "sites_net", "subdomain"),
]
SAMPLE_LOCATIONS = ["San Francisco, CA", "London, UK", "Berlin, Germany", "Remote - US", "Bengaluru, KA", "Toronto", "Paris – France", "Nederland"]
SAMPLE_COUNTRIES = ["us", "Deutschland", "Remote", None, "cote d'ivoire", "U.K."]
DOC_RULES = [("license", r"\blicen[cs]e\b"), ("mit", r"\bmit\b"), ("apache", r"\bapache\b"), ("gpl", r"\bgpl\b"), ("copyright", r"\bcopyright\b")]
PART_HARD = [("bolt", r"\bbolts?\b"), ("gear", r"\bgears?\b")]
PART_FIELD = [("small", r"\bsmall\b"), ("red", r"\bred\b"), ("hot", r"\bhot\b")]

PRIORITY_TITLE = [
    ("1-URGENT", "Software Engineering Intern"),
    ("2-HIGH", "Data Co-op"),
    ("3-MEDIUM", "Senior Backend Engineer"),
    ("4-NOT SPECIFIED", "Internal Audit Manager"),
    ("5-LOW", "Kitchen Intern"),
]
STATUS_DESC = [("F", "This is an unpaid internship in data science"), ("O", "Work on cloud software with our research lab")]


def _case(col, pairs, default):
    e = None
    for k, v in pairs:
        e = F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v))
    return e.otherwise(F.lit(default))


def _sql_case(col, pairs, default):
    return "CASE " + " ".join(f"WHEN {col} = {S.q(k)} THEN {S.q(v)}" for k, v in pairs) + f" ELSE {S.q(default)} END"


def _sql_list(xs):
    return "[" + ", ".join("NULL" if x is None else S.q(x) for x in xs) + "]"


# ---------------------------------------------------------------------------
# Flagship: pages -> canonical URL -> text -> rules -> last-wins -> per host
# ---------------------------------------------------------------------------
def page_digest(pages: DataFrame, page_rules=PAGE_RULES) -> DataFrame:
    d = pages.select(
        "page_id",
        urls.normalize_url(F.col("url")).alias("canonical_url"),
        urls.host(F.col("url")).alias("host"),
        text.strip_html(F.col("html")).alias("text"),
        text.strip_html(text.html_title(F.col("html"))).alias("title"),
    )
    d = dedup.last_wins(d, ["canonical_url"], ["page_id"])
    d = d.withColumn("labels", rules.match_labels(F.col("text"), page_rules))
    return d.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.length("text")).alias("text_chars"),
        F.count_if(F.col("title") != "").alias("titled"),
        F.count_if(F.size("labels") > 0).alias("tagged"),
    )


def _sql_page_digest():
    lab = S.labels("text", PAGE_RULES, unicode_words=True)
    return f"""
WITH p AS (SELECT page_id, {S.normalize_url('url')} AS canonical_url, {S.host('url')} AS host,
                  {S.strip_html_known('html')} AS text,
                  {S.strip_html_known("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages),
w AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY page_id DESC) = 1)
SELECT host, CAST(count(*) AS BIGINT) AS pages, CAST(sum(length(text)) AS BIGINT) AS text_chars,
       CAST(count(*) FILTER (WHERE title <> '') AS BIGINT) AS titled,
       CAST(count(*) FILTER (WHERE len({lab}) > 0) AS BIGINT) AS tagged
FROM w GROUP BY host"""


@register("flagship_page_digest", _sql_page_digest())
def q_flagship(spark, sf):
    return page_digest(table(spark, sf, "pages"))


@register("E2_W1_canonical_pages", f"""
SELECT {S.normalize_url('url')} AS canonical_url, {S.host('url')} AS host,
       CAST(len({S.path_segments('url')}) AS INTEGER) AS depth,
       max(page_id) AS page_id, CAST(count(*) AS BIGINT) AS copies
FROM pages GROUP BY 1, 2, 3""")
def q_canonical_pages(spark, sf):
    p = table(spark, sf, "pages").select(
        urls.normalize_url(F.col("url")).alias("canonical_url"),
        urls.host(F.col("url")).alias("host"),
        F.size(urls.path_segments(F.col("url"))).alias("depth"),
        "page_id",
        F.lit(1).alias("n"),
    )
    w = dedup.last_wins(p.drop("n"), ["canonical_url"], ["page_id"])
    c = p.groupBy("canonical_url").agg(F.count(F.lit(1)).alias("copies"))
    return w.join(c, "canonical_url").select("canonical_url", "host", "depth", "page_id", "copies")


@register("E1_page_text", f"""
SELECT page_id, {S.strip_html_known('html')} AS text,
       {S.strip_html_known("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages""")
def q_page_text(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", text.strip_html(F.col("html")).alias("text"), text.strip_html(text.html_title(F.col("html"))).alias("title"))


# ---------------------------------------------------------------------------
# Prune: lineitem as listings, orders as boards
# ---------------------------------------------------------------------------
def prune_inputs(spark, sf, variant: str):
    li = table(spark, sf, "lineitem")
    od = table(spark, sf, "orders")
    lag_days = 1460 if variant == "apply" else 0
    listings_df = li.select(
        F.concat(F.lit("https://jobs.example.com/"), F.col("l_orderkey"), F.lit("/"), F.col("l_linenumber")).alias("canonical_url"),
        F.col("l_orderkey").cast("string").alias("company_slug"),
        F.lit("greenhouse").alias("ats_source"),
        (F.col("l_shipdate").cast("timestamp") + F.make_interval(days=F.lit(lag_days))).alias("last_seen_at"),
    )
    if variant == "apply":
        orphan = F.col("o_orderpriority") == "5-LOW"
        inactive = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    else:
        orphan = F.col("o_orderstatus") == "P"
        inactive = F.col("o_orderstatus") == "F"
    companies = od.select(
        F.concat(F.when(orphan, "other-").otherwise(""), F.col("o_orderkey").cast("string")).alias("company_slug"),
        F.lit("greenhouse").alias("ats_source"),
        F.when(inactive, F.lit(False)).alias("still_active"),
        F.col("o_orderdate").cast("timestamp").alias("last_polled_at"),
    )
    return listings_df, companies


def _sql_prune_classified(variant: str) -> str:
    lag = "INTERVAL 1460 DAY" if variant == "apply" else "INTERVAL 0 DAY"
    if variant == "apply":
        orphan, inactive = "o_orderpriority = '5-LOW'", "o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED'"
    else:
        orphan, inactive = "o_orderstatus = 'P'", "o_orderstatus = 'F'"
    return f"""
WITH l AS (SELECT 'https://jobs.example.com/' || l_orderkey || '/' || l_linenumber AS canonical_url,
                  CAST(l_orderkey AS VARCHAR) AS company_slug, 'greenhouse' AS ats_source,
                  CAST(l_shipdate AS TIMESTAMP) + {lag} AS last_seen_at FROM lineitem),
c AS (SELECT CASE WHEN {orphan} THEN 'other-' ELSE '' END || o_orderkey AS company_slug, 'greenhouse' AS ats_source,
             CASE WHEN {inactive} THEN false END AS still_active, CAST(o_orderdate AS TIMESTAMP) AS last_polled_at
      FROM orders),
k AS (SELECT l.*, CASE WHEN c.company_slug IS NULL THEN 'orphan' WHEN c.still_active = false THEN 'dead'
             WHEN c.last_polled_at IS NOT NULL AND l.last_seen_at IS NOT NULL AND c.last_polled_at > l.last_seen_at + INTERVAL 2 HOUR THEN 'gone'
             ELSE 'keep' END AS bucket
      FROM l LEFT JOIN c USING (company_slug, ats_source))"""


@register("Q1_prune_classify", _sql_prune_classified("report") + "\nSELECT canonical_url, company_slug, bucket FROM k")
def q_prune_classify(spark, sf):
    l, c = prune_inputs(spark, sf, "report")
    return pr.classify(l, c).select("canonical_url", "company_slug", "bucket")


@register("A7_prune_buckets", _sql_prune_classified("report") + "\nSELECT bucket, CAST(count(*) AS BIGINT) AS listings FROM k GROUP BY bucket")
def q_prune_buckets(spark, sf):
    l, c = prune_inputs(spark, sf, "report")
    return pr.classify(l, c).groupBy("bucket").agg(F.count(F.lit(1)).alias("listings"))


_GATE_SQL = """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE bucket = 'gone') AS BIGINT) AS gone,
       CAST(count(*) FILTER (WHERE bucket = 'dead') AS BIGINT) AS dead,
       CAST(count(*) FILTER (WHERE bucket = 'orphan') AS BIGINT) AS orphan,
       CAST(count(*) FILTER (WHERE bucket <> 'keep') AS BIGINT) AS doomed,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE bucket <> 'keep') / count(*) ELSE 0 END, 9) AS share,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE bucket <> 'keep') / count(*) ELSE 0 END > 0.4 AS breach
FROM k"""


@register("A8_prune_gate", _sql_prune_classified("report") + _GATE_SQL)
def q_prune_gate(spark, sf):
    l, c = prune_inputs(spark, sf, "report")
    return pr.report(pr.classify(l, c)).withColumn("share", F.round("share", 9))


@register("A8_prune_gate_pass", _sql_prune_classified("apply") + _GATE_SQL)
def q_prune_gate_pass(spark, sf):
    l, c = prune_inputs(spark, sf, "apply")
    return pr.report(pr.classify(l, c)).withColumn("share", F.round("share", 9))


@register("Q2_prune_apply", _sql_prune_classified("apply") + f"""
, g AS (SELECT count(*) FILTER (WHERE bucket <> 'keep') / count(*) > 0.4 AS breach FROM k)
SELECT canonical_url, company_slug, {S.ts_text('last_seen_at')} AS last_seen_at FROM k, g WHERE bucket = 'keep' OR g.breach""")
def q_prune_apply(spark, sf):
    l, c = prune_inputs(spark, sf, "apply")
    kept = pr.survivors(pr.classify(l, c))
    return kept.select("canonical_url", "company_slug", ts_text(F.col("last_seen_at")).alias("last_seen_at"))


@register("Q2_S6_prune_table", _sql_prune_classified("apply") + f"""
, u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY last_seen_at DESC NULLS LAST, company_slug DESC) = 1),
g AS (SELECT count(*) FILTER (WHERE bucket <> 'keep') / count(*) > 0.4 AS breach FROM u)
SELECT canonical_url, company_slug, {S.ts_text('last_seen_at')} AS last_seen_at FROM u, g WHERE bucket = 'keep' OR g.breach""")
def q_prune_table(spark, sf):
    """The same on a stored table with one row a URL: classified, gated, and the
    doomed rows deleted by key."""
    l, c = prune_inputs(spark, sf, "apply")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/listings-{uuid.uuid4().hex}"
    stored = KeyedTable(spark, path, ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in l.schema), ["canonical_url"], 4)
    stored.create(dedup.last_wins(l, ["canonical_url"], ["last_seen_at", "company_slug"]))
    pr.run_prune(stored, c)
    return stored.read().select("canonical_url", "company_slug", ts_text(F.col("last_seen_at")).alias("last_seen_at"))


@register("Q2_prune_apply_breach", _sql_prune_classified("report") + f"""
, g AS (SELECT count(*) FILTER (WHERE bucket <> 'keep') / count(*) > 0.4 AS breach FROM k)
SELECT canonical_url, company_slug, {S.ts_text('last_seen_at')} AS last_seen_at FROM k, g WHERE bucket = 'keep' OR g.breach""")
def q_prune_apply_breach(spark, sf):
    l, c = prune_inputs(spark, sf, "report")
    kept = pr.survivors(pr.classify(l, c))
    return kept.select("canonical_url", "company_slug", ts_text(F.col("last_seen_at")).alias("last_seen_at"))


# ---------------------------------------------------------------------------
# Board health: events as the poll log
# ---------------------------------------------------------------------------
def poll_log(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    gone = (F.col("event_type") == "signup") & (F.pmod(F.col("event_id"), F.lit(97)) == 0)
    status = F.when(F.col("event_type") == "error", "pfail").when(F.col("event_type") == "view", "error").when(gone, "dead404").otherwise("ok")
    return e.select(
        F.col("user_id").cast("string").alias("company_slug"),
        F.lit("lever").alias("ats_source"),
        F.col("ts").cast("timestamp").alias("finished_at"),
        F.col("event_id").alias("seq"),
        status.alias("status"),
        F.pmod(F.col("user_id"), F.lit(10)).cast("string").alias("host"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("run_id"),
        F.floor(F.col("value")).cast("bigint").alias("seen"),
        F.when(F.col("value") > 30, 1).otherwise(0).alias("matched"),
    )


_SQL_POLLS = """
WITH p AS (SELECT CAST(user_id AS VARCHAR) AS company_slug, CAST(ts AS TIMESTAMP) AS ts, event_id,
                  CASE event_type WHEN 'error' THEN 'pfail' WHEN 'view' THEN 'error'
                       ELSE CASE WHEN event_type = 'signup' AND event_id % 97 = 0 THEN 'dead404' ELSE 'ok' END END AS status,
                  CAST(user_id % 10 AS VARCHAR) AS host, strftime(ts, '%Y-%m-%d') AS run_id,
                  CAST(floor(value) AS BIGINT) AS seen, CASE WHEN value > 30 THEN 1 ELSE 0 END AS matched FROM events)"""

_SQL_HEALTH_CORE = _SQL_POLLS + """,
g AS (SELECT *, sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY company_slug ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp,
             row_number() OVER (PARTITION BY company_slug ORDER BY ts, event_id) AS rk FROM p),
n AS (SELECT *, sum(CASE WHEN status = 'pfail' THEN 1 ELSE 0 END) OVER (PARTITION BY company_slug, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM g),
r AS (SELECT company_slug, min(rk) AS ret_rk FROM n WHERE status = 'dead404' OR (status = 'pfail' AND n >= 3) GROUP BY 1),
j AS (SELECT n.*, r.ret_rk FROM n LEFT JOIN r USING (company_slug))"""


@register("W3_board_health", _SQL_HEALTH_CORE + f"""
SELECT company_slug,
       CAST(arg_max(CASE WHEN status = 'ok' THEN 0 ELSE n END, rk) FILTER (WHERE (ret_rk IS NULL OR rk < ret_rk) AND status IN ('ok', 'pfail')) AS INTEGER) AS fail_count,
       CASE WHEN max(ret_rk) IS NOT NULL THEN false END AS still_active,
       {S.ts_text("max(ts) FILTER (WHERE status = 'ok' AND (ret_rk IS NULL OR rk < ret_rk))")} AS last_polled_at,
       {S.ts_text("max(ts) FILTER (WHERE rk = ret_rk)")} AS retired_at,
       CAST(count(*) FILTER (WHERE ret_rk IS NULL OR rk <= ret_rk) AS BIGINT) AS polls_used
FROM j GROUP BY company_slug""")
def q_board_health(spark, sf):
    h = health.board_health(poll_log(spark, sf), order=["finished_at", "seq"])
    return h.select(
        "company_slug", "fail_count", "still_active",
        ts_text(F.col("last_polled_at")).alias("last_polled_at"), ts_text(F.col("retired_at")).alias("retired_at"), "polls_used",
    )


@register("A1_run_summary", _SQL_HEALTH_CORE + """,
ret AS (SELECT run_id, count(*) AS condemned FROM j WHERE rk = ret_rk GROUP BY run_id)
SELECT p.run_id, CAST(coalesce(sum(seen) FILTER (WHERE status = 'ok'), 0) AS BIGINT) AS jobs_seen,
       CAST(count(*) FILTER (WHERE status = 'pfail') AS BIGINT) AS persistent_fail,
       CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS errors,
       CAST(count(*) FILTER (WHERE status = 'dead404') AS BIGINT) AS dead404,
       CAST(count(*) FILTER (WHERE status = 'ok' AND matched > 0) AS BIGINT) AS boards_matched,
       CAST(coalesce(max(ret.condemned), 0) AS BIGINT) AS retired
FROM p LEFT JOIN ret USING (run_id) GROUP BY p.run_id""")
def q_run_summary(spark, sf):
    polls = poll_log(spark, sf)
    retired = health.retired_in(health.board_health(polls))
    return health.run_summary(polls, retired=retired).select("run_id", "jobs_seen", "persistent_fail", "errors", "dead404", "boards_matched", "retired")


_SQL_TRIPS = _SQL_POLLS + """,
g AS (SELECT *, sum(CASE WHEN status IN ('ok', 'dead404') THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp,
             row_number() OVER (PARTITION BY host ORDER BY ts, event_id) AS rk FROM p),
n AS (SELECT *, sum(CASE WHEN status IN ('error', 'pfail') THEN 1 ELSE 0 END) OVER (PARTITION BY host, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS n FROM g),
t AS (SELECT host, min(rk) AS trip_rk FROM n WHERE status IN ('error', 'pfail') AND n >= 8 GROUP BY host),
h AS (SELECT n.host, CAST(count(*) AS BIGINT) AS polls, max(t.trip_rk) IS NOT NULL AS tripped,
             max(ts) FILTER (WHERE rk = trip_rk) AS tripped_at
      FROM n LEFT JOIN t USING (host) GROUP BY n.host)"""


@register("W4_host_trips", _SQL_TRIPS + f"\nSELECT host, polls, tripped, {S.ts_text('tripped_at')} AS tripped_at FROM h")
def q_host_trips(spark, sf):
    t = health.host_trips(poll_log(spark, sf), trip_after=8)
    return t.select("host", "polls", "tripped", ts_text(F.col("tripped_at")).alias("tripped_at"))


@register("A13_tripped_summary", _SQL_TRIPS + """
SELECT strftime(tripped_at, '%Y-%m-%d') AS tripped_on, CAST(count(*) AS BIGINT) AS hosts_tripped FROM h WHERE tripped GROUP BY 1""")
def q_tripped_summary(spark, sf):
    s = health.tripped_summary(health.host_trips(poll_log(spark, sf), trip_after=8))
    return s.select(F.date_format("tripped_on", "yyyy-MM-dd").alias("tripped_on"), "hosts_tripped")


# ---------------------------------------------------------------------------
# Discover: pages as a two-crawl URL index
# ---------------------------------------------------------------------------
def url_index(spark, sf) -> DataFrame:
    p = table(spark, sf, "pages")
    return p.select(
        F.to_json(F.struct(F.col("url"), F.lit("200").alias("status"))).alias("value"),
        F.when(F.col("url").startswith("https:"), F.lit("crawl-2")).otherwise(F.lit("crawl-1")).alias("crawl_id"),
        F.lit(0).alias("page_no"),
    )


def _sql_extract(url_sql_table: str, domains) -> str:
    vals = ", ".join(f"({i}, {S.q(d)}, {S.q(a)}, {S.q(s)})" for i, (d, a, s) in enumerate(domains))
    generic = _sql_list(V.GENERIC_LABELS)
    label = "regexp_replace(h[1:length(h) - length(d.domain)], '\\.+$', '')"
    not_site = _sql_list(V.WORKDAY_NOT_SITE)
    wsegs = f"CASE WHEN coalesce(regexp_full_match(segs[1], {S.q(V.WORKDAY_LOCALE[1:-1])}), false) THEN segs[2:] ELSE segs END"
    tenant = f"split_part({label}, '.', 1)"
    wd = (f"CASE WHEN contains({label}, '.') AND {tenant} <> '' AND NOT list_contains({generic}, {tenant}) "
          f"AND ({wsegs})[1] IS NOT NULL AND NOT list_contains({not_site}, lower(({wsegs})[1])) "
          f"THEN lower({label}) || '/' || ({wsegs})[1] END")
    return f"""
d(ordinal, domain, ats, slug_in) AS (VALUES {vals}),
u AS (SELECT *, {S.host('url')} AS h, {S.path_segments('url')} AS segs FROM {url_sql_table}),
m AS (SELECT u.rid, min(d.ordinal) AS o FROM u JOIN d ON (d.slug_in = 'path' AND u.h = d.domain)
          OR (d.slug_in = 'subdomain' AND (u.h = d.domain OR u.h LIKE '%.' || d.domain)) GROUP BY u.rid),
b AS (SELECT u.*, d.domain, d.slug_in,
             CASE WHEN d.slug_in = 'path' THEN CASE WHEN NOT list_contains({generic}, lower(segs[1])) THEN lower(segs[1]) END
                  WHEN d.ats = 'workday' THEN {wd}
                  ELSE CASE WHEN {label} <> '' THEN lower(list_filter(string_split({label}, '.'), lambda x: NOT list_contains({generic}, x))[1]) END
             END AS company_slug, d.ats
      FROM u JOIN m USING (rid) JOIN d ON d.ordinal = m.o),
e AS (SELECT u.*, b.company_slug, CASE WHEN b.company_slug IS NOT NULL THEN b.ats END AS ats_source,
             b.domain, b.slug_in FROM u LEFT JOIN b USING (rid))"""


@register("P18_extract_board", "WITH pg AS (SELECT page_id AS rid, url FROM pages)," + _sql_extract("pg", EXAMPLE_DOMAINS) + """
SELECT rid AS page_id, ats_source, company_slug FROM e""")
def q_extract_board(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return extract_board(p, "url", EXAMPLE_DOMAINS).select("page_id", "ats_source", "company_slug")


_SQL_DISCOVER = """WITH idx AS (SELECT page_id AS rid, url, CASE WHEN url LIKE 'https:%' THEN 'crawl-2' ELSE 'crawl-1' END AS crawl FROM pages WHERE url <> ''),""" + _sql_extract("idx", EXAMPLE_DOMAINS) + """,
f AS (SELECT crawl, company_slug, ats_source, arg_min(CASE WHEN slug_in = 'path' THEN domain || '/*' ELSE '*.' || domain END, o) AS pattern
      FROM e JOIN m USING (rid) WHERE company_slug IS NOT NULL GROUP BY crawl, company_slug, ats_source),
new AS (SELECT company_slug, ats_source, pattern FROM f WHERE crawl = 'crawl-2'
        AND (company_slug, ats_source) NOT IN (SELECT (company_slug, ats_source) FROM f WHERE crawl = 'crawl-1'))"""


def _discover(spark, sf):
    idx = url_index(spark, sf)
    existing = extract_board(disc.index_urls(idx, crawl_id="crawl-1"), "url", EXAMPLE_DOMAINS).where(F.col("company_slug").isNotNull())
    return disc.discover(disc.index_urls(idx), existing.select("company_slug", "ats_source"), EXAMPLE_DOMAINS)


@register("Q4_discover", _SQL_DISCOVER + "\nSELECT company_slug, ats_source, pattern FROM new")
def q_discover(spark, sf):
    return _discover(spark, sf)


@register("F13_S8_pattern_index", _SQL_DISCOVER + "\nSELECT company_slug, ats_source, pattern FROM new")
def q_pattern_index(spark, sf):
    """Q4 over an index that is stored by reversed host and read by pattern."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/url-index-{uuid.uuid4().hex}"
    for crawl in ("crawl-1", "crawl-2"):
        disc.write_index(disc.index_urls(url_index(spark, sf), crawl), path, crawl)
    known = extract_board(disc.read_index(spark, path, EXAMPLE_DOMAINS, "crawl-1"), "url", EXAMPLE_DOMAINS).where(F.col("company_slug").isNotNull())
    return disc.discover(disc.read_index(spark, path, EXAMPLE_DOMAINS), known.select("company_slug", "ats_source"), EXAMPLE_DOMAINS)


_ONE_FEED = EXAMPLE_DOMAINS[0][1]


@register("F11_discover_one_feed", _SQL_DISCOVER.replace(_sql_extract("idx", EXAMPLE_DOMAINS), _sql_extract("idx", [d for d in EXAMPLE_DOMAINS if d[1] == _ONE_FEED]))
          + "\nSELECT company_slug, ats_source, pattern FROM new")
def q_discover_one_feed(spark, sf):
    idx = url_index(spark, sf)
    known = extract_board(disc.index_urls(idx, crawl_id="crawl-1"), "url", EXAMPLE_DOMAINS).where(F.col("company_slug").isNotNull())
    return disc.discover(disc.index_urls(idx), known.select("company_slug", "ats_source"), EXAMPLE_DOMAINS, only=_ONE_FEED)


@register("E8_parse_iso", f"""
SELECT o_orderkey, {S.ts_text("CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 9 HOUR WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 7 HOUR WHEN 2 THEN CAST(o_orderdate AS TIMESTAMP) END")} AS at
FROM orders""")
def q_parse_iso(spark, sf):
    """Stamps in UTC, with an offset, dates alone, and texts that are none."""
    day, form = F.date_format("o_orderdate", "yyyy-MM-dd"), F.pmod(F.col("o_orderkey"), F.lit(4))
    text = (F.when(form == 0, F.concat(day, F.lit("T09:00:00Z"))).when(form == 1, F.concat(day, F.lit("T09:00:00+02:00")))
            .when(form == 2, day).otherwise(F.concat(F.lit("about "), day)))
    return table(spark, sf, "orders").select("o_orderkey", ts_text(misc.parse_iso(text)).alias("at"))


@register("P20_P21_E5_classify_ats", """
SELECT page_id, CASE WHEN page_id % 6 < 5 THEN ['greenhouse', 'greenhouse', 'breezy', 'lever', 'greenhouse'][(page_id % 6) + 1] END AS ats_source,
       CASE WHEN page_id % 6 < 4 THEN 'co' || page_id END AS company_slug FROM pages""")
def q_classify_ats(spark, sf):
    """Board URLs of the page ids in the forms of the registry; the sixth keeps its own URL."""
    p = table(spark, sf, "pages")
    n, form = F.concat(F.lit("Co"), F.col("page_id")), F.pmod(F.col("page_id"), F.lit(6))
    url = (F.when(form == 0, F.concat(F.lit("https://boards.greenhouse.io/"), n, F.lit("/jobs/1")))
           .when(form == 1, F.concat(F.lit("https://boards.greenhouse.io/embed/job_board?x=1&for="), n))
           .when(form == 2, F.concat(F.lit("https://"), n, F.lit(".breezy.hr/p/1"))).when(form == 3, F.concat(F.lit("https://jobs.lever.co/"), n))
           .when(form == 4, F.lit("https://job-boards.greenhouse.io/")).otherwise(F.col("url")))
    return classify_ats(p.select("page_id", url.alias("url"))).select("page_id", "ats_source", "company_slug")


@register("A4_discover_counts", _SQL_DISCOVER + "\nSELECT pattern, CAST(count(*) AS BIGINT) AS new_boards FROM new GROUP BY ROLLUP (pattern)")
def q_discover_counts(spark, sf):
    return disc.counts_by_pattern(_discover(spark, sf))


# ---------------------------------------------------------------------------
# Postings from orders: gates, pay, shaping, last-wins dedup
# ---------------------------------------------------------------------------
def postings(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    d = o.join(c, o.o_custkey == c.c_custkey, "left")
    digit = F.substring("o_orderpriority", 1, 1)
    locs = F.array(*[F.lit(x) for x in SAMPLE_LOCATIONS])
    loc = F.element_at(locs, (F.pmod(F.col("o_custkey"), F.lit(len(SAMPLE_LOCATIONS))) + 1).cast("int"))
    return d.select(
        F.concat(F.lit("https://job-boards.greenhouse.io/c"), F.col("o_custkey"), F.lit("/jobs/"), digit).alias("canonical_url"),
        F.concat(F.lit("https://boards.greenhouse.io/c"), F.col("o_custkey"), F.lit("/jobs/"), digit, F.lit("?o="), F.col("o_orderkey")).alias("raw_url"),
        _case(F.col("o_orderpriority"), PRIORITY_TITLE, "Kitchen Intern").alias("title"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(_case(F.col("o_orderstatus"), STATUS_DESC, "")).alias("description"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_at"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Internship")).otherwise(F.lit("")).alias("employment_type"),
        loc.alias("location"),
        geo.country_of(None, loc).alias("country"),
        F.col("c_name").alias("company"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"), F.lit("EUR 1500–1700/month")).alias("pay"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("company_slug"),
        F.lit("greenhouse").alias("ats_source"),
        F.col("o_orderdate").cast("timestamp").alias("finished_at"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey"),
    )


_SQL_POSTINGS = f"""
WITH o AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
j AS (SELECT 'https://job-boards.greenhouse.io/c' || o_custkey || '/jobs/' || o_orderpriority[1] AS canonical_url,
             'https://boards.greenhouse.io/c' || o_custkey || '/jobs/' || o_orderpriority[1] || '?o=' || o_orderkey AS raw_url,
             {_sql_case('o_orderpriority', PRIORITY_TITLE, 'Kitchen Intern')} AS title,
             CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE {_sql_case('o_orderstatus', STATUS_DESC, '')} END AS description,
             strftime(o_orderdate, '%Y-%m-%d') AS posted_at,
             CASE WHEN o_orderstatus = 'P' THEN 'Internship' ELSE '' END AS employment_type,
             {_sql_list(SAMPLE_LOCATIONS)}[(o_custkey % {len(SAMPLE_LOCATIONS)}) + 1] AS location,
             c_name AS company,
             CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN 'EUR 1500–1700/month' END AS pay,
             'c' || o_custkey AS company_slug, 'greenhouse' AS ats_source, CAST(o_orderdate AS TIMESTAMP) AS finished_at, o_orderkey
      FROM o),
g AS (SELECT *, {S.hard_gate('title', 'employment_type')} AS hard, {S.labels(S.field_text('title', 'description'), V.FIELD_RULES)} AS bag FROM j)"""


@register("F3_two_gate", _SQL_POSTINGS + f"""
SELECT o_orderkey, len(hard) > 0 AND len(bag) > 0 AS passed, array_to_string(hard, '|') AS hard,
       array_to_string(bag, '|') AS bag,
       CASE WHEN len(hard) > 0 AND len(bag) > 0 THEN array_to_string({S.keywords('hard', 'bag')}, '|') ELSE '' END AS keywords
FROM g""")
def q_two_gate(spark, sf):
    g = listings.gate(postings(spark, sf), keep_failed=True)
    return g.select(
        "o_orderkey", "passed", F.array_join("hard", "|").alias("hard"), F.array_join("bag", "|").alias("bag"),
        F.array_join("keywords_matched", "|").alias("keywords"),
    )


@register("P16_W1_listings", _SQL_POSTINGS + f"""
, s AS (SELECT *, {S.keywords('hard', 'bag')} AS kw FROM g WHERE canonical_url <> '' AND title <> '' AND len(hard) > 0 AND len(bag) > 0),
w AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY finished_at DESC, o_orderkey DESC) = 1)
SELECT canonical_url, raw_url, title, company_slug, ats_source, array_to_string(kw, '|') AS keywords_matched,
       nullif(company, '') AS company, nullif(coalesce(description, ''), '') AS snippet,
       nullif(coalesce(location, ''), '') AS location, nullif({S.country_of(None, 'location')}, '') AS country,
       nullif(coalesce(coalesce(nullif(pay, ''), CASE WHEN {S.is_unpaid('title', 'description')} THEN 'Unpaid' END), ''), '') AS pay,
       posted_at, {S.ts_text('finished_at')} AS last_seen_at
FROM w""")
def q_listings(spark, sf):
    p = postings(spark, sf)
    shaped = listings.shape(p, F.col("finished_at"))
    out = listings.dedup_listings(shaped, ["last_seen_at", "seq"])
    return out.select(
        "canonical_url", "raw_url", "title", "company_slug", "ats_source",
        F.array_join("keywords_matched", "|").alias("keywords_matched"),
        "company", "snippet", "location", "country", "pay", "posted_at", ts_text(F.col("last_seen_at")).alias("last_seen_at"),
    )


@register("F2_document_rules", f"""
SELECT doc_id, array_to_string({S.labels('text', DOC_RULES, unicode_words=True)}, '|') AS labels FROM documents""")
def q_document_rules(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.array_join(rules.match_labels(F.col("text"), DOC_RULES), "|").alias("labels"))


@register("F1_part_gate", f"""
WITH g AS (SELECT p_partkey, {S.labels('p_name', PART_HARD)} AS hard, {S.labels(S.field_text('p_name', 'p_type'), PART_FIELD)} AS bag FROM part)
SELECT p_partkey, len(hard) > 0 AND len(bag) > 0 AS passed,
       CASE WHEN len(hard) > 0 AND len(bag) > 0 THEN array_to_string({S.keywords('hard', 'bag')}, '|') ELSE '' END AS keywords FROM g""")
def q_part_gate(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_type").alias("description"))
    g = listings.gate(p, PART_HARD, PART_FIELD, keep_failed=True)
    return g.select("p_partkey", "passed", F.array_join("keywords_matched", "|").alias("keywords"))


# ---------------------------------------------------------------------------
# Names and countries from customer
# ---------------------------------------------------------------------------
@register("E6_display_name", f"""
WITH s AS (SELECT c_custkey, lower(c_mktsegment) || '-' || c_custkey AS slug, lower(c_name) AS name_slug FROM customer)
SELECT c_custkey, slug, {S.display_name('slug')} AS company, {S.display_name('name_slug')} AS company_from_name FROM s""")
def q_display_name(spark, sf):
    c = table(spark, sf, "customer")
    s = c.select("c_custkey", F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_custkey")).alias("slug"), F.lower("c_name").alias("name_slug"))
    return s.select("c_custkey", "slug", misc.display_name(F.col("slug")).alias("company"), misc.display_name(F.col("name_slug")).alias("company_from_name"))


@register("E16_country_of", f"""
WITH s AS (SELECT c_custkey, {_sql_list(SAMPLE_COUNTRIES)}[(c_nationkey % {len(SAMPLE_COUNTRIES)}) + 1] AS structured,
                  {_sql_list(SAMPLE_LOCATIONS)}[(c_custkey % {len(SAMPLE_LOCATIONS)}) + 1] AS location FROM customer)
SELECT c_custkey, structured, location, {S.country_of('structured', 'location')} AS country,
       {S.country_of(None, 'location')} AS country_from_location FROM s""")
def q_country_of(spark, sf):
    c = table(spark, sf, "customer")
    sc = F.array(*[F.lit(x) if x is not None else F.lit(None).cast("string") for x in SAMPLE_COUNTRIES])
    locs = F.array(*[F.lit(x) for x in SAMPLE_LOCATIONS])
    s = c.select(
        "c_custkey",
        F.element_at(sc, (F.pmod(F.col("c_nationkey"), F.lit(len(SAMPLE_COUNTRIES))) + 1).cast("int")).alias("structured"),
        F.element_at(locs, (F.pmod(F.col("c_custkey"), F.lit(len(SAMPLE_LOCATIONS))) + 1).cast("int")).alias("location"),
    )
    return s.select("c_custkey", "structured", "location", geo.country_of(F.col("structured"), F.col("location")).alias("country"),
                    geo.country_of(None, F.col("location")).alias("country_from_location"))
