"""All feeds conformed in one pass (P1-P15, S14-S19, U1), driven by tables of paths.

A payload is parsed once and its items are exploded once, whatever its feed:
the tables below say where each feed keeps its items and its fields. The raw
fields of all feeds share columns, so a shared rule (HTML to text, canonical
URL, country, company name, pay) stands in the plan once and not once a feed.

Two feeds store details of single postings, and one returns a posting under
several terms: their rows alone are dealt by board and posting, where the
newest detail (J6) and the first occurrence (W2) are found. Their payloads and
those of the other feeds are disjoint slices of bronze by ``ats_source``, so no
payload is read or parsed twice.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...functions import geo, misc, urls
from ...functions import values as V
from ...functions.text import first_truthy, first_truthy_once, let, nonblank, nonblank_once, or_empty, strip_html
from .common import CONFORMED, LINEAGE, is_object, join_str_parts, label, truthy_object, vget, vs, vstr

# Patterns of the two server-rendered boards.
JAZZ_SPLIT = "list-group-item-heading"
JAZZ_LINK = r'<a\s+href="(https://[^"]+/apply/([A-Za-z0-9]+))[^"]*"\s*>\s*(.*?)\s*</a>'
JAZZ_LOC = r"""fa-map-marker['"]>\s*</i>\s*([^<]+)"""
JV_ROW = (
    r'<td class="jv-job-list-name">\s*<a href="(/[^"/]+/job/([^"]+))"\s*>(.*?)</a>\s*</td>\s*'
    r'<td class="jv-job-list-location">\s*(.*?)\s*</td>'
)
BOARD = ["company_slug", "ats_source"]
SEQ = [*BOARD, "run_id"]
SLUG, KEY, TENANT, SITE = "<slug>", "<key>", "<tenant>", "<site>"

HTML_FEEDS = ("jazzhr", "jobvite")
#: Feeds whose postings have stored details, matched by the posting's key.
DETAILED = ("smartrecruiters", "workday")

ITEMS = {
    "greenhouse": "$.jobs", "lever": "$", "ashby": "$.jobs", "smartrecruiters": "$.content", "workable": "$.results", "breezy": "$",
    "recruitee": "$.offers", "rippling": "$", "teamtailor": "$.items", "bamboohr": "$.result", "workday": "$.jobPostings",
}
POSTING_KEY = {"greenhouse": "$.id", "smartrecruiters": "$.id", "workable": "$.shortcode", "bamboohr": "$.id", "workday": "$.externalPath"}
URL = {
    "greenhouse": "$.absolute_url", "lever": "$.hostedUrl", "breezy": "$.url", "recruitee": "$.careers_url", "rippling": "$.url",
    "teamtailor": "$.url",
}
#: Postings without this are skipped: a key that is null, or a key or URL that is null or empty.
NEED_KEY, NEED_FULL_KEY = ("greenhouse", "smartrecruiters", "bamboohr"), ("workable", "workday")
NEED_URL = ("lever", "ashby", "breezy", "recruitee", "rippling", "teamtailor")
#: Canonical URLs made from the board and the key; the other feeds' URLs are normalised.
BUILT = {
    "greenhouse": ("https://job-boards.greenhouse.io/", SLUG, "/jobs/", KEY),
    "smartrecruiters": ("https://jobs.smartrecruiters.com/", SLUG, "/", KEY),
    "workable": ("https://apply.workable.com/", SLUG, "/j/", KEY),
    "bamboohr": ("https://", SLUG, ".bamboohr.com/careers/", KEY),
    "jazzhr": ("https://", SLUG, ".applytojob.com/apply/", KEY),
    "jobvite": ("https://jobs.jobvite.com/", SLUG, "/job/", KEY),
    "workday": ("https://", TENANT, ".myworkdayjobs.com/en-US/", SITE, KEY),
}
#: Feeds whose raw URL is the built one.
NO_URL = ("smartrecruiters", "workable", "bamboohr", "workday")
TITLE = {
    "greenhouse": "$.title", "lever": "$.text", "ashby": "$.title", "smartrecruiters": "$.name", "workable": "$.title", "breezy": "$.name",
    "recruitee": "$.title", "rippling": "$.name", "teamtailor": "$.title", "bamboohr": "$.jobOpeningName", "workday": "$.title",
}
TEXT = {"lever": "$.descriptionPlain", "ashby": "$.descriptionPlain", "bamboohr": "$.departmentLabel"}
TEXT_LABEL = {"rippling": "$.department"}
POSTED = {
    "lever": "$.createdAt", "ashby": "$.publishedAt", "smartrecruiters": "$.releasedDate", "workable": "$.published", "breezy": "$.published_date",
    "recruitee": "$.published_at", "workday": "$.postedOn",
}
EMPLOYMENT = {
    "lever": "$.categories.commitment", "ashby": "$.employmentType", "workable": "$.type", "recruitee": "$.employment_type_code",
    "bamboohr": "$.employmentStatusLabel",
}
EMPLOYMENT_LABEL = {"smartrecruiters": "$.typeOfEmployment", "breezy": "$.type"}
PLACE = {"greenhouse": "$.location.name", "lever": "$.categories.location", "ashby": "$.location", "workday": "$.locationsText"}
PLACE_PARTS = {"smartrecruiters": ("$.location.city", "$.location.region"), "workable": ("$.location.city", "$.location.region")}
COUNTRY = {
    "lever": "$.country", "ashby": "$.address.postalAddress.addressCountry", "smartrecruiters": "$.location.country",
    "workable": ("$.location.country", "$.location.countryCode"), "recruitee": ("$.country", "$.country_code"),
}
COMPANY = {"greenhouse": "$.company_name", "smartrecruiters": "$.company.name", "recruitee": "$.company_name"}

DETAIL = "told boolean, fetched_at timestamp, run_id string, text string, place string, country string, day string"


class _Feeds:
    """Expressions for the feeds of one pass: cases of other feeds are left out."""

    def __init__(self, feeds: Iterable[str]):
        self.feeds = list(feeds)

    def has(self, *feeds: str) -> bool:
        return any(f in self.feeds for f in feeds)

    def is_(self, *feeds: str) -> Column:
        held = [f for f in feeds if f in self.feeds]
        return F.lit(False) if not held else F.col("ats_source") == held[0] if len(held) == 1 else F.col("ats_source").isin(*held)

    def case(self, *cases: tuple[str | tuple[str, ...], Column], otherwise: Column | None = None, kind: str = "string") -> Column:
        """The value of the row's feed; of several feeds, one value."""
        out = None
        for feeds, value in cases:
            feeds = (feeds,) if isinstance(feeds, str) else feeds
            if self.has(*feeds):
                out = (F if out is None else out).when(self.is_(*feeds), value)
        rest = F.lit(None).cast(kind) if otherwise is None else otherwise
        return rest if out is None else out.otherwise(rest)

    def paths(self, *tables: tuple[dict, Callable], otherwise: Column | None = None) -> Column:
        """One case per different path of the tables; several paths: the first
        that is not empty."""
        by_path: dict = {}
        for table, read in tables:
            for feed, path in table.items():
                by_path.setdefault((path, read), []).append(feed)
        of = lambda path, read: first_truthy_once(*[read(F.col("j"), p) for p in path]) if isinstance(path, tuple) else read(F.col("j"), path)
        return self.case(*[(tuple(feeds), of(*key)) for key, feeds in by_path.items()], otherwise=otherwise)


def field_names() -> list[str]:
    """The raw fields of a posting."""
    return list(_fields(_Feeds(())))


def _items(f: _Feeds) -> Column:
    """The items of a payload: ``j`` of a JSON feed, ``g`` (texts) of an HTML one."""
    by_root: dict[str, list[str]] = {}
    for feed, root in ITEMS.items():
        by_root.setdefault(root, []).append(feed)
    none = F.lit(None).cast("array<string>")
    entries = [(tuple(feeds), F.try_variant_get("v", root, "array<variant>")) for root, feeds in by_root.items()]
    of_json = F.transform(f.case(*entries, kind="array<variant>"), lambda x: F.struct(x.alias("j"), none.alias("g")))
    body = F.coalesce("body", F.lit(""))
    texts = lambda *g: F.struct(F.lit(None).cast("variant").alias("j"), F.array(*g).alias("g"))
    chunks = F.transform(F.split(body, JAZZ_SPLIT, -1), lambda c, i: texts(F.when(i > 0, c)))
    rows = F.arrays_zip(*[F.regexp_extract_all(body, F.lit("(?sU)" + JV_ROW), g).alias(f"g{g}") for g in (1, 2, 3, 4)])
    rows = F.transform(rows, lambda r: texts(*[r[f"g{g}"] for g in (1, 2, 3, 4)]))
    return f.case(("jazzhr", chunks), ("jobvite", rows), otherwise=of_json if f.has(*ITEMS) else None, kind="array<struct<j:variant,g:array<string>>>")


def _place(f: _Feeds) -> Column:
    j = F.col("j")
    parts = {feed: join_str_parts(*[vstr(j, p) for p in paths]) for feed, paths in PLACE_PARTS.items()}
    state = F.coalesce(label(j, "$.location.state"), vstr(j, "$.location.state"), F.lit(""))
    of_region = F.coalesce(nonblank_once(vstr(j, "$.state_name")), F.when(nonblank_once(vs(j, "$.state_name")).isNull(), vstr(j, "$.region")))
    rippling = first_truthy_once(vs(j, "$.workLocation"), label(j, "$.location"), label(j, "$.locations[0]"), vstr(j, "$.locations[0]"))
    own = F.when(nonblank_once(vs(F.col("spot"), "$.state")).isNotNull(), vstr(F.col("spot"), "$.state")).otherwise(vstr(F.col("spot"), "$.province"))
    bamboo = join_str_parts(vstr(F.col("spot"), "$.city"), own)
    remote = F.coalesce(F.try_variant_get(j, "$.isRemote", "boolean"), F.lit(False))
    return f.case(
        *parts.items(),
        ("breezy", F.coalesce(nonblank_once(vs(j, "$.location.name")), join_str_parts(vstr(j, "$.location.city"), state))),
        ("recruitee", F.coalesce(nonblank_once(vs(j, "$.location")), join_str_parts(vstr(j, "$.city"), of_region))),
        ("rippling", rippling),
        ("teamtailor", F.coalesce(nonblank_once(vstr(j, "$.location")), join_str_parts(vstr(F.col("spot"), "$.addressLocality"), vstr(F.col("spot"), "$.addressRegion")))),
        ("bamboohr", F.coalesce(nonblank_once(bamboo), F.when(remote, F.lit("Remote")).otherwise(F.lit("")))),
        otherwise=f.paths((PLACE, vs)))


def _schema_org_address() -> Column:
    """The address of the first place of a schema.org posting."""
    place = "$._jobposting.jobLocation"  # an object, or an array of them: only one of the paths leads anywhere
    return F.coalesce(vget(F.col("j"), f"{place}.address"), vget(F.col("j"), f"{place}[0].address"))


def _bamboo_place() -> Column:
    found = F.array(vget(F.col("j"), "$.atsLocation"), vget(F.col("j"), "$.location"))
    return F.get(F.filter(found, truthy_object), F.lit(0))


def _spot(f: _Feeds) -> Column:
    """The part of an item that several fields of its place are read from."""
    return f.case(("teamtailor", _schema_org_address()), ("bamboohr", _bamboo_place()), kind="variant")


def _country(f: _Feeds) -> Column:
    j = F.col("j")
    breezy = let(vget(j, "$.location.country"), lambda x: F.when(is_object(x), vs(x, "$.name")).otherwise(vs(x, "$")))
    return f.case(
        ("breezy", breezy),
        ("teamtailor", F.when(nonblank_once(vstr(j, "$.location")).isNull(), vs(F.col("spot"), "$.addressCountry"))),
        ("bamboohr", vs(F.col("spot"), "$.country")),
        otherwise=f.paths((COUNTRY, vs)))


def _label_text(v: Column, path: str) -> Column:
    return F.coalesce(label(v, path), F.lit(""))


def _text(f: _Feeds) -> Column:
    """Descriptions that are no HTML."""
    j = F.col("j")
    departments = F.try_variant_get(j, "$.department", "array<variant>")
    departments = F.transform(F.filter(departments, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    return f.case(
        ("smartrecruiters", F.concat_ws(" ", label(j, "$.department"), label(j, "$.function"))),
        ("workable", F.array_join(departments, " ")),
        ("breezy", vstr(j, "$.department")),
        otherwise=f.paths((TEXT, vs), (TEXT_LABEL, _label_text)))


def _fields(f: _Feeds) -> dict[str, Column]:
    """Raw fields of an item, as texts."""
    j, g = F.col("j"), F.col("g")
    chunk, link, loc = F.get(g, F.lit(0)), "(?sU)" + JAZZ_LINK, "(?sU)" + JAZZ_LOC
    job, value, salary = "$._jobposting", "$._jobposting.baseSalary.value", "$.salary"
    two = lambda *paths: F.concat_ws(" ", *[nonblank_once(vs(j, p)) for p in paths])
    return {
        "key": f.case(("jazzhr", F.when(chunk.rlike(link), F.regexp_extract(chunk, link, 2))), ("jobvite", F.get(g, F.lit(1))),
                      otherwise=f.paths((POSTING_KEY, vs))),
        "url": f.case(("ashby", first_truthy_once(vs(j, "$.jobUrl"), vs(j, "$.applyUrl"))), ("jazzhr", F.regexp_extract(chunk, link, 1)),
                      ("jobvite", F.concat(F.lit("https://jobs.jobvite.com"), F.get(g, F.lit(0)))), otherwise=f.paths((URL, vs))),
        "name": f.paths((TITLE, vs)),
        "name_html": f.case(("jazzhr", F.regexp_extract(chunk, link, 3)), ("jobvite", F.get(g, F.lit(2)))),
        "text": _text(f),
        "html": f.case(("greenhouse", vs(j, "$.content")), ("recruitee", two("$.description", "$.requirements")), ("teamtailor", vs(j, "$.content_html"))),
        "html_else": f.case(("teamtailor", vs(j, f"{job}.description"))),
        "posted": f.case(("greenhouse", first_truthy_once(vs(j, "$.first_published"), vs(j, "$.updated_at"))),
                         ("teamtailor", first_truthy_once(vs(j, "$.date_published"), vs(j, "$._jobposting.datePosted"))), otherwise=f.paths((POSTED, vs))),
        "employment": f.paths((EMPLOYMENT, vs), (EMPLOYMENT_LABEL, _label_text)),
        "place": _place(f),
        "place_html": f.case(("jazzhr", F.when(chunk.rlike(loc), F.regexp_extract(chunk, loc, 1))), ("jobvite", F.get(g, F.lit(3)))),
        "nation": _country(f),
        "firm": f.case(("teamtailor", F.col("feed_title")), otherwise=f.paths((COMPANY, vs))),
        "pay_text": f.case(("ashby", first_truthy_once(vs(j, "$.compensation.compensationTierSummary"), vs(j, "$.compensation.scrapeableCompensationSalarySummary")))),
        "pay_min": f.case(("recruitee", vs(j, f"{salary}.min")), ("teamtailor", first_truthy_once(vs(j, f"{value}.minValue"), vs(j, f"{value}.value")))),
        "pay_max": f.case(("recruitee", vs(j, f"{salary}.max")), ("teamtailor", vs(j, f"{value}.maxValue"))),
        "pay_period": f.case(("recruitee", vs(j, f"{salary}.period")), ("teamtailor", F.lower(F.coalesce(vs(j, f"{value}.unitText"), F.lit(""))))),
        "pay_currency": f.case(("recruitee", vs(j, f"{salary}.currency")), ("teamtailor", vs(j, f"{job}.baseSalary.currency"))),
    }


def _kept(f: _Feeds) -> Column:
    """Items that are postings. F6: an explicit isListed=false drops one; a
    workday board without a site is a poll error and has none."""
    unlisted = F.coalesce(let(vget(F.col("j"), "$.isListed"), lambda x: (F.schema_of_variant(x) == "BOOLEAN") & ~F.try_variant_get(x, "$", "boolean")), F.lit(False))
    keep = f.case(((*NEED_KEY, "jazzhr"), F.col("key").isNotNull()), (NEED_FULL_KEY, nonblank("key").isNotNull()),
                  (NEED_URL, nonblank("url").isNotNull()), otherwise=F.lit(True))
    if f.has("ashby"):
        keep = keep & ~(f.is_("ashby") & unlisted)
    if f.has("workday"):
        keep = keep & (~f.is_("workday") | F.col("company_slug").contains("/"))
    return keep


def detail_description(v: Column) -> Column:
    """Three ``jobAd.sections.*.text`` parts, blanks dropped, joined by a
    space, then E1."""
    parts = [vs(v, f"$.jobAd.sections.{k}.text") for k in ("jobDescription", "qualifications", "additionalInformation")]
    return let(F.concat_ws(" ", *[nonblank_once(p) for p in parts]), lambda text: strip_html(text))


def _detail(f: _Feeds) -> Column:
    """A stored detail in the order in which the greatest one counts; NULL if it
    says nothing: smartrecruiters, the newest that is not blank; workday, the
    newest with a description, else the newest."""
    j = F.col("j")
    text, info = nonblank_once(detail_description(j)), "$.jobPostingInfo"
    nation = let(vget(j, f"{info}.country"), lambda x: F.when(is_object(x), vs(x, "$.descriptor")).when(F.schema_of_variant(x) == "STRING", vs(x, "$")))
    none = F.lit(None).cast("string")
    row = lambda told, *fields: F.struct(told, F.col("fetched_at"), F.col("run_id"), *fields).cast(f"struct<{DETAIL}>")
    told = lambda words: row(nonblank(words).isNotNull(), words, vs(j, f"{info}.location"), nation, vs(j, f"{info}.startDate"))
    return f.case(
        ("smartrecruiters", let(text, lambda t: F.when(t.isNotNull(), row(F.lit(True), t, none, none, none)))),
        ("workday", F.when(is_object(j, info), let(vs(j, f"{info}.jobDescription"), told))),
        kind=f"struct<{DETAIL}>")


def term_rank() -> Column:
    """Request order of a search term: the fixed list, then any other term."""
    ranks = F.create_map(*[x for i, t in enumerate(V.WORKDAY_TERMS) for x in (F.lit(t), F.lit(i))])
    return F.coalesce(F.try_element_at(ranks, F.col("term")), F.lit(len(V.WORKDAY_TERMS)))


def _is_detail() -> Column:
    return F.coalesce("page_kind", F.lit("list")) == "detail"


def _fetched(bronze: DataFrame, f: _Feeds) -> DataFrame:
    """The payloads of these feeds that were fetched successfully, parsed once."""
    b = bronze.where(F.col("ats_source").isin(*f.feeds) & F.col("http_status").between(200, 299) & (F.coalesce("error_kind", F.lit("")) == ""))
    return b.withColumn("v", F.when(~F.col("ats_source").isin(*HTML_FEEDS), F.try_parse_json("body")) if f.has(*ITEMS) else F.lit(None).cast("variant"))


def _rows(payloads: DataFrame, f: _Feeds, items: Column) -> DataFrame:
    """One row per item: what its payload says of all of them comes along, not
    the payload itself, which would be copied to every item."""
    title = f.case(("teamtailor", vs(F.col("v"), "$.title"))).alias("feed_title")
    rows = payloads.select(*SEQ, "fetched_at", "page_kind", "term", "page_no", "item_key", title, F.posexplode(items).alias("item_pos", "_i"))
    rows = rows.select("*", F.col("_i.j").alias("j"), F.col("_i.g").alias("g")).drop("_i")
    return rows.withColumn("spot", _spot(f))


def _plain_items(bronze: DataFrame, f: _Feeds) -> DataFrame:
    rows = _rows(_fetched(bronze, f).where(F.coalesce("page_kind", F.lit("list")) == "list"), f, _items(f))
    fields = _fields(f)
    rows = rows.select(*LINEAGE, "j", *[c.alias(n) for n, c in fields.items()]).where(_kept(f))
    return rows.select(*LINEAGE, *fields, F.lit(None).cast(f"struct<{DETAIL}>").alias("info"))


def detailed_rows(bronze: DataFrame, feeds: Iterable[str] = DETAILED) -> DataFrame:
    """Raw fields of the postings and details of feeds that store details, from
    one scan: ``detail`` tells them apart, ``key`` names the posting, ``info``
    is what a detail says. A detail payload is its own only item."""
    f = _Feeds(x for x in DETAILED if x in set(feeds))
    lists_or_details = F.coalesce("page_kind", F.lit("list")).isin("list", "detail")
    own = F.array(F.struct(F.col("v").alias("j"), F.lit(None).cast("array<string>").alias("g")))
    rows = _rows(_fetched(bronze, f).where(lists_or_details), f, F.when(_is_detail(), own).otherwise(_items(f)))
    fields = _fields(f)
    fields["key"] = F.when(_is_detail(), F.col("item_key")).otherwise(fields["key"])
    fields["info"] = F.when(_is_detail(), _detail(f))
    rows = rows.select(*LINEAGE, _is_detail().alias("detail"), term_rank().alias("term_no"), "j", *[c.alias(n) for n, c in fields.items()])
    return rows.where(F.when(F.col("detail"), F.col("key").isNotNull()).otherwise(_kept(f))).drop("j")


def first_of_run(rows: DataFrame) -> DataFrame:
    """Of a workday posting, the first of a run across terms, pages and positions."""
    first = F.row_number().over(Window.partitionBy(*BOARD, "key", "run_id").orderBy("term_no", "page_no", "item_pos"))
    return rows.withColumn("_nth", first).where((F.col("_nth") == 1) | (F.col("ats_source") != "workday")).drop("_nth")


def _detailed_items(bronze: DataFrame, f: _Feeds) -> DataFrame:
    """The newest detail of a posting, of whichever run."""
    rows = detailed_rows(bronze, f.feeds)
    rows = rows.withColumn("info", F.max("info").over(Window.partitionBy(*BOARD, "key"))).where(~F.col("detail"))
    rows = first_of_run(rows) if f.has("workday") else rows
    return rows.drop("detail", "term_no")


def _conformed(rows: DataFrame, f: _Feeds, as_of: Column | None) -> DataFrame:
    """The shared rules over the raw fields of all feeds."""
    hostpart, site = (F.split(F.col("company_slug"), "/", 2).getItem(k) for k in (0, 1))
    named = {SLUG: F.col("company_slug"), KEY: F.col("key"), TENANT: hostpart, SITE: site}
    built = f.case(*[(feed, F.concat(*[named[p] if p in named else F.lit(p) for p in parts])) for feed, parts in BUILT.items()])
    day = as_of if as_of is not None else F.to_date(F.col("fetched_at"))
    info = lambda c: F.col(f"info.{c}")
    html = f.case(("workday", info("text")), otherwise=F.col("html"))
    texts = [html, *([F.col(c) for c in ("html_else", "name_html", "place_html")] if f.has(*HTML_FEEDS, "teamtailor") else [])]
    rows = rows.withColumn("stripped", F.transform(F.array(*texts), lambda x: strip_html(x)) if len(texts) > 1 else F.array(strip_html(html)))
    rows = rows.select(
        "*", built.alias("built"), f.case((HTML_FEEDS, F.get("stripped", F.lit(3))), ("workday", first_truthy(info("place"), F.col("place"))), otherwise=F.col("place")).alias("spot"),
        f.case(("workday", F.split(hostpart, r"\.", 2).getItem(0)), otherwise=F.col("company_slug")).alias("board_name"))
    of_html = F.coalesce(nonblank(F.get("stripped", F.lit(0))), F.get("stripped", F.lit(1)), F.lit(""))
    pay = misc.format_salary(F.col("pay_min"), F.col("pay_max"), F.col("pay_period"), F.col("pay_currency")) if f.has("recruitee", "teamtailor") else None
    columns = {
        "canonical_url": f.case((tuple(BUILT), F.col("built")), otherwise=urls.normalize_url(F.col("url")) if set(f.feeds) - set(BUILT) else None),
        "raw_url": f.case((NO_URL, F.col("built")), otherwise=F.col("url")),
        "title": f.case((HTML_FEEDS, F.get("stripped", F.lit(2))), otherwise=or_empty("name")),
        "description": f.case((("greenhouse", "recruitee", "teamtailor", "workday"), of_html), ("smartrecruiters", F.coalesce(info("text"), F.col("text"))),
                              otherwise=or_empty("text")),
        "posted_at": f.case(("lever", misc.ms_to_iso(F.col("posted"))), ("workday", F.coalesce(nonblank(info("day")), misc.relative_posted(F.col("posted"), day))),
                            otherwise=F.col("posted")),
        "employment_type": or_empty("employment"),
        "location": or_empty("spot"),
        "country": geo.country_of(f.case(("workday", info("country")), otherwise=F.col("nation")), F.col("spot")),
        "company": F.coalesce(nonblank("firm"), misc.display_name(F.col("board_name"))),
        "pay": f.case((("recruitee", "teamtailor"), pay) if pay is not None else ((), None), otherwise=F.col("pay_text")),
    }
    return rows.select(*[columns[c].cast("string").alias(c) for c in CONFORMED], *LINEAGE)


FEEDS = tuple(dict.fromkeys([*ITEMS, *HTML_FEEDS]))


def conform_all(bronze: DataFrame, feeds: Iterable[str] | None = None, as_of: Column | None = None) -> DataFrame:
    """P15 + U1: the postings of every captured page of the feeds (default all)
    in the conformed shape. One pass over the payloads of the feeds without
    details, one over those with details, disjoint by ``ats_source``."""
    wanted = [x for x in FEEDS if feeds is None or x in set(feeds)]
    f, plain, detailed = _Feeds(wanted), _Feeds(x for x in wanted if x not in DETAILED), _Feeds(x for x in wanted if x in DETAILED)
    parts = ([_plain_items(bronze, plain)] if plain.feeds else []) + ([_detailed_items(bronze, detailed)] if detailed.feeds else [])
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _conformed(rows, f, as_of)


def conform_detailed(rows: DataFrame, feeds: Iterable[str] = DETAILED, as_of: Column | None = None) -> DataFrame:
    """The conformed shape of postings (``detailed_rows``) beside their details."""
    return _conformed(rows, _Feeds(x for x in DETAILED if x in set(feeds)), as_of)


def conform(ats: str, bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The postings of one feed."""
    return conform_all(bronze, [ats], as_of)
