"""Board extraction from URLs (P18-P21) and the host-suffix match.

``host == d or host.endswith('.' + d)`` written as a join condition plans as a
nested loop. Here every host is expanded into its dot suffixes (a handful per
host) and each suffix is an equality probe:

* a parameter domain list (the usual case: 14 seed domains, 13 feeds) becomes
  a literal map in the plan, probed per row: no join and no shuffle at all;
* a domain *table* is equi-joined on the suffix, keyed by distinct host (so
  only one row per host is shuffled) and joined back on the host.

The lowest ordinal wins, as the first match in list order does.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import values as V
from .listings import computed

Domains = Sequence[tuple[str, str, str]]


def registry_domains() -> list[tuple[str, str, str]]:
    """Registry as (host, ats, slug_in) in feed order (P20 classification)."""
    return [(h, ats, slug_in) for ats, hosts, slug_in, _ in V.REGISTRY for h in hosts]


def domain_table(spark: SparkSession, domains: Domains = V.SEED_DOMAINS) -> DataFrame:
    rows = [(i, d, a, s) for i, (d, a, s) in enumerate(domains)]
    return spark.createDataFrame(rows, "ordinal int, domain string, ats_source string, slug_in string")


def registry_table(spark: SparkSession) -> DataFrame:
    rows = [(a, s, h, ",".join(hs)) for a, hs, s, h in V.REGISTRY]
    return spark.createDataFrame(rows, "ats_source string, slug_in string, api_host string, hosts string")


def _suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def domain_match(host: Column, domains: Domains) -> Column:
    """J7 as an expression: struct(ordinal, domain, ats_source, slug_in) of the
    first domain (list order) the host matches, else NULL."""
    entries = []
    for i, (d, a, s) in enumerate(domains):
        if d in entries[::2]:
            continue
        entries += [d, (i, a, s)]
    args = []
    for k, (i, a, s) in zip(entries[::2], entries[1::2]):
        args += [F.lit(k), F.struct(F.lit(i).alias("ordinal"), F.lit(k).alias("domain"), F.lit(a).alias("ats_source"), F.lit(s).alias("slug_in"))]
    m = F.create_map(*args)
    sfx = _suffixes(host)
    hits = F.transform(sfx, lambda x, i: F.when((i == 0) | (F.try_element_at(m, x).getField("slug_in") == "subdomain"), F.try_element_at(m, x)))
    return F.array_min(F.filter(hits, lambda h: h.isNotNull()))


def match_domain_table(df: DataFrame, url_col: str, dim: DataFrame) -> DataFrame:
    """J7 against a domain *table* (ordinal, domain, ats_source, slug_in); the
    planner decides from its measured size whether it is broadcast."""
    d = df.withColumn("_host", urls.host(F.col(url_col)))
    hosts = d.select("_host").distinct()
    ex = hosts.select("_host", F.posexplode(_suffixes(F.col("_host"))).alias("_pos", "domain"))
    dm = dim.select("ordinal", "domain", "ats_source", "slug_in")
    hits = ex.join(dm, "domain").where((F.col("slug_in") == "subdomain") | (F.col("_pos") == 0))
    best = hits.groupBy("_host").agg(F.min(F.struct("ordinal", "domain", "ats_source", "slug_in")).alias("_m"))
    return d.join(best, "_host", "left")


def _with_match(df: DataFrame, url_col: str, domains: Domains | DataFrame) -> DataFrame:
    if isinstance(domains, DataFrame):
        return match_domain_table(df, url_col, domains)
    d = computed(df, _host=urls.host(F.col(url_col)))
    return d.withColumn("_m", domain_match(F.col("_host"), domains))


def extract_board(df: DataFrame, url_col: str = "url", domains: Domains | DataFrame = V.SEED_DOMAINS) -> DataFrame:
    """Add ``ats_source`` and ``company_slug`` (NULL when the URL names
    no board). The first matching domain decides, even when it yields NULL.

    Path feeds: first path segment, lowered, unless generic. Subdomain feeds:
    first non-generic label left of the base domain, lowered. Workday: the
    composite ``tenant.wdN/Site`` (site case kept, a leading locale skipped,
    reserved segments rejected).
    """
    m = F.col("_m")
    m = computed(_with_match(df, url_col, domains), _segs=urls.path_segments(F.col(url_col)), _domain=m["domain"], _ats=m["ats_source"], _slug_in=m["slug_in"])
    generic = F.array(*[F.lit(x) for x in V.GENERIC_LABELS])
    not_site = F.array(*[F.lit(x) for x in V.WORKDAY_NOT_SITE])
    h, dom, segs, label = F.col("_host"), F.col("_domain"), F.col("_segs"), F.col("_label")
    m = computed(m, _label=F.regexp_replace(F.substring(h, F.lit(1), F.length(h) - F.length(dom)), r"\.+$", ""))
    first = F.lower(F.try_element_at(segs, F.lit(1)))
    path_slug = F.when(~F.array_contains(generic, first), first)
    parts = F.filter(F.split(label, r"\.", -1), lambda p: ~F.array_contains(generic, p))
    sub_slug = F.when(label != F.lit(""), F.lower(F.try_element_at(parts, F.lit(1))))
    tenant = F.split(label, r"\.", -1).getItem(0)
    lead = F.try_element_at(segs, F.lit(1))
    wsegs = F.when(F.coalesce(lead.rlike(V.WORKDAY_LOCALE), F.lit(False)), F.slice(segs, 2, 1 << 20)).otherwise(segs)
    site = F.try_element_at(wsegs, F.lit(1))
    wd_ok = label.contains(".") & (tenant != F.lit("")) & ~F.array_contains(generic, tenant) & site.isNotNull() & ~F.array_contains(not_site, F.lower(site))
    wd_slug = F.when(wd_ok, F.concat(F.lower(label), F.lit("/"), site))
    slug = (
        F.when(F.col("_slug_in") == "path", path_slug)
        .when(F.col("_ats") == "workday", wd_slug)
        .when(F.col("_slug_in") == "subdomain", sub_slug)
    )
    # a filter on the outcome stays above these steps, where nothing is evaluated twice
    out = computed(m, _slug=slug).withColumn("company_slug", F.col("_slug")).withColumn("domain", dom).withColumn("slug_in", F.col("_slug_in"))
    out = out.withColumn("ats_source", F.when(F.col("company_slug").isNotNull(), F.col("_ats")))
    return out.drop("_host", "_m", "_segs", "_domain", "_ats", "_slug_in", "_label", "_slug")


def classify_ats(df: DataFrame, url_col: str = "url") -> DataFrame:
    """The registry feed owning the URL (path feeds by host equality,
    subdomain feeds by suffix) and its slug: first path segment lowered, the
    greenhouse ``embed?for=`` form, or the label left of the feed's host."""
    m = _with_match(df, url_col, registry_domains())
    segs = urls.path_segments(F.col(url_col))
    first = F.lower(F.try_element_at(segs, F.lit(1)))
    forv = urls.query_param(F.col(url_col), "for")
    path_slug = F.when((F.col("_m.ats_source") == "greenhouse") & (first == "embed"), F.lower(F.when(forv != "", forv))).otherwise(first)
    h, dom = F.col("_host"), F.col("_m.domain")
    lead = F.split(F.substring(h, F.lit(1), F.length(h) - F.length(dom) - 1), r"\.", -1).getItem(0)
    sub_slug = F.when(h.endswith(F.concat(F.lit("."), dom)), lead)
    slug = F.when(F.col("_m.slug_in") == "path", path_slug).when(F.col("_m.slug_in") == "subdomain", sub_slug)
    return m.withColumn("ats_source", F.col("_m.ats_source")).withColumn("company_slug", slug).drop("_host", "_m")
