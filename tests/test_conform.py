"""Feed conformers over payloads of invented boards: the branches of each
dialect, several pages, details of other runs, and first failures."""
import datetime as dt
import json

from pyspark.sql import functions as F

from rolefeed.operators.conform import paged as P
from rolefeed.operators.conform.common import BRONZE_SCHEMA

DAY = dt.datetime(2025, 3, 10, 8, 30)


def bronze(spark, ats, slug, bodies, kind="list", term=None, keys=None, status=200, run="run-b", at=DAY):
    rows = []
    for page, body in enumerate(bodies):
        text = body if isinstance(body, str) else json.dumps(body)
        rows.append((slug, ats, run, "FAST", at, status, None, kind, term, page, keys[page] if keys else None, text))
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def conform(spark, ats, slug, bodies, extra=None):
    b = bronze(spark, ats, slug, bodies)
    b = b if extra is None else b.unionByName(extra)
    return [r.asDict() for r in P.CONFORMERS[ats](b).orderBy("page_no", "item_pos").collect()]


def test_bamboohr_place_falls_back_to_remote(spark):
    page = {"result": [
        {"id": 88, "jobOpeningName": "Lab Assistant", "departmentLabel": "Chemistry", "employmentStatusLabel": "Part-Time",
         "atsLocation": {"country": "Germany", "state": None, "province": "Hesse", "city": "Kassel"}},
        {"id": "89", "jobOpeningName": "Tester", "isRemote": True, "location": {"city": "", "state": ""}},
        {"id": None, "jobOpeningName": "No id"}]}
    a, b = conform(spark, "bamboohr", "quarry", [page])
    assert (a["canonical_url"], a["title"]) == ("https://quarry.bamboohr.com/careers/88", "Lab Assistant")
    assert (a["description"], a["employment_type"], a["location"], a["country"]) == ("Chemistry", "Part-Time", "Kassel, Hesse", "Germany")
    assert b["location"] == "Remote" and b["company"] == "Quarry"
    assert conform(spark, "bamboohr", "quarry", [{"result": None}, "[]"]) == []


def jazz_row(key, title, place, gap=""):
    spot = f"{gap}<ul><li><i class='fa fa-map-marker'></i> {place}</li></ul>" if place else ""
    return f"<h3 class='list-group-item-heading'><a href=\"https://quarry.applytojob.com/apply/{key}/x-y\">{title}</a></h3>{spot}"


def test_jazzhr_place_is_found_however_far_it_stands(spark):
    page = "<div>" + jazz_row("k1", "Sales &amp; Service", "Lyon, France") + jazz_row("k2", "Far", "Porto, Portugal", "<p>" + "z" * 9000 + "</p>") + jazz_row("k3", "None", "")
    a, b, c = conform(spark, "jazzhr", "quarry", [page])
    assert (a["canonical_url"], a["title"], a["location"], a["country"]) == ("https://quarry.applytojob.com/apply/k1", "Sales & Service", "Lyon, France", "France")
    assert (b["location"], b["country"], c["location"]) == ("Porto, Portugal", "Portugal", "")


def jobvite_row(key, title, place):
    return (f'<tr><td class="jv-job-list-name"> <a href="/harbor/job/{key}">{title}</a> </td>\n'
            f'<td class="jv-job-list-location">{place}</td></tr>')


def test_jobvite_conforms_every_captured_page(spark):
    pages = [jobvite_row("o1", "Dock Clerk", "Gdansk,\n  Poland"), jobvite_row("o2", "Crane Operator", "Oslo, Norway"), "<html></html>", jobvite_row("o3", "Pilot", "")]
    jobs = conform(spark, "jobvite", "harbor", pages)
    assert [j["canonical_url"] for j in jobs] == [f"https://jobs.jobvite.com/harbor/job/o{i}" for i in (1, 2, 3)]
    assert [(j["title"], j["location"], j["country"]) for j in jobs[:2]] == [("Dock Clerk", "Gdansk, Poland", "Poland"), ("Crane Operator", "Oslo, Norway", "Norway")]


def test_workable_and_smartrecruiters_keep_pages_after_a_last_one(spark):
    pages = [{"results": [{"shortcode": f"S{i}", "title": f"T{i}"}], "nextPage": None} for i in range(155)]
    assert len(conform(spark, "workable", "harbor", pages)) == 155
    pages = [{"totalFound": 1, "content": [{"id": f"p{i}", "name": f"N{i}"}]} for i in range(4)] + [{"content": []}, {"content": [{"id": "late"}]}]
    assert [j["canonical_url"].rsplit("/", 1)[1] for j in conform(spark, "smartrecruiters", "harbor", pages)] == ["p0", "p1", "p2", "p3", "late"]


SMART = {"totalFound": 1, "content": [{"id": "77", "name": "Optics Intern", "department": {"label": "Lenses"}, "function": {"name": "Research"}}]}


def smart_detail(*texts):
    names = ("jobDescription", "qualifications", "additionalInformation")
    return {"jobAd": {"sections": {n: {"text": t} for n, t in zip(names, texts)}}}


def test_detail_of_an_earlier_run_and_beside_a_blank_one(spark):
    def detail(body, run, days):
        return bronze(spark, "smartrecruiters", "prism", [body], kind="detail", keys=["77"], run=run, at=DAY + dt.timedelta(days=days))

    old, new = detail(smart_detail("<p>Grind</p>"), "run-0", -5), detail(smart_detail("<p>Polish <i>glass</i></p>", "", "<b>soon</b>"), "run-a", -1)
    blank = detail(smart_detail(" ", "<p> </p>"), "run-c", 3)
    texts = lambda *extra: [j["description"] for j in conform(spark, "smartrecruiters", "prism", [SMART], _union(extra))]
    assert texts(old) == ["Grind"] and texts(old, new) == texts(new, old, blank) == ["Polish glass soon"]
    assert texts(blank) == ["Lenses Research"]


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def workday_page(*rows):
    return {"total": len(rows), "jobPostings": [dict(zip(("title", "externalPath", "locationsText", "postedOn"), r)) for r in rows]}


def test_workday_terms_pages_and_details(spark):
    slug = "loom.wd2/Weavers"
    first = [workday_page(("Yarn Trainee", "/job/Turin/Y1", "Turin, Italy", "Posted 4 Days Ago")), workday_page(("Dye Intern", "/job/Turin/Y2", "Turin, Italy", "Posted Today"))]
    again = [workday_page(("Other title", "/job/Turin/Y1", "Rome, Italy", "Posted Today"), ("Extra", "/job/Turin/Y3", "", "soon"))]
    told = {"jobPostingInfo": {"jobDescription": "<p>Mix <b>colours</b></p>", "location": "Greater Turin", "country": {"descriptor": "Italy"}, "startDate": "2025-02-02"}}
    bare = {"jobPostingInfo": {"jobDescription": "", "location": "Elsewhere"}}
    b = _union([
        bronze(spark, "workday", slug, again, term="co-op"), bronze(spark, "workday", slug, first, term="intern"),
        bronze(spark, "workday", slug, [told], kind="detail", keys=["/job/Turin/Y2"], run="run-a", at=DAY - dt.timedelta(days=1)),
        bronze(spark, "workday", slug, [bare], kind="detail", keys=["/job/Turin/Y2"], run="run-c", at=DAY + dt.timedelta(days=1)),
        bronze(spark, "workday", "loom", first, term="intern")])
    got = {r["canonical_url"].rsplit("/", 1)[1]: r for r in P.conform_workday(b).collect()}
    assert set(got) == {"Y1", "Y2", "Y3"}
    assert got["Y1"]["canonical_url"] == "https://loom.wd2.myworkdayjobs.com/en-US/Weavers/job/Turin/Y1" and got["Y1"]["company"] == "Loom"
    assert (got["Y1"]["title"], got["Y1"]["location"], got["Y1"]["posted_at"], got["Y1"]["description"]) == ("Yarn Trainee", "Turin, Italy", "2025-03-06", "")
    assert (got["Y2"]["description"], got["Y2"]["location"], got["Y2"]["country"], got["Y2"]["posted_at"]) == ("Mix colours", "Greater Turin", "Italy", "2025-02-02")
    assert got["Y3"]["posted_at"] is None


def test_teamtailor_place_and_pay_of_the_embedded_posting(spark):
    pay = lambda unit, **v: {"currency": "SEK", "value": {"unitText": unit, **v}}
    feed = {"title": "Fjord Works", "items": [
        {"url": "https://fjord.teamtailor.com/jobs/9-welder?x=1", "title": "Welder", "content_html": "<p>Hot &amp; bright</p>", "location": None,
         "_jobposting": {"jobLocation": {"address": {"addressLocality": "Bergen", "addressRegion": "Vestland", "addressCountry": "NO"}}, "baseSalary": pay("HOUR", minValue="200", maxValue="260")}},
        {"url": "https://fjord.teamtailor.com/jobs/8", "title": "Cook", "_jobposting": {"description": "<i>Soup</i>", "baseSalary": pay("WEEK", value="900")}},
        {"url": "", "title": "dropped"}, {"url": "https://fjord.teamtailor.com/jobs/7", "title": "Bare", "location": "Malmo, Sweden"}]}
    a, b, c = conform(spark, "teamtailor", "fjord", [feed])
    assert (a["canonical_url"], a["location"], a["country"], a["pay"]) == ("https://fjord.teamtailor.com/jobs/9-welder", "Bergen, Vestland", "Norway", "SEK 200–260/hour")
    assert (a["description"], a["company"]) == ("Hot & bright", "Fjord Works")
    assert (b["description"], b["pay"], b["location"]) == ("Soup", "SEK 900/week", "") and (c["pay"], c["country"]) == (None, "Sweden")


def test_ashby_unlisted_and_lever_epoch(spark):
    jobs = conform(spark, "ashby", "orchard", [{"jobs": [
        {"isListed": False, "jobUrl": "https://jobs.ashbyhq.com/orchard/hidden"}, {"jobUrl": None, "applyUrl": "https://jobs.ashbyhq.com/orchard/pear?from=z", "title": "Picker"}]}])
    assert [j["canonical_url"] for j in jobs] == ["https://jobs.ashbyhq.com/orchard/pear"]
    (j,) = conform(spark, "lever", "orchard", [[{"hostedUrl": "https://jobs.lever.co/orchard/plum/", "text": "Sorter", "createdAt": 1735689600500,
                                                "categories": {"location": "Austin, TX", "commitment": "Temp"}}]])
    assert (j["posted_at"], j["country"], j["employment_type"]) == ("2025-01-01T00:00:00.500000+00:00", "United States", "Temp")
    assert conform(spark, "lever", "orchard", [{"jobs": []}, "null"]) == []


def test_poll_outcomes_and_first_failure_by_request_order(spark):
    def poll(slug, ats, status, kind=None, term=None, body="[]", page=0, profile="FAST", at=DAY):
        return (slug, ats, "r", profile, at, status, kind, "list", term, page, None, body)

    rows = [poll("fine", "lever", 200), poll("broken", "lever", 200, body="{oops"), poll("gone", "lever", 404), poll("slow", "lever", None, "timeout"),
            poll("left", "lever", 410), poll("busy", "lever", 503), poll("nosite", "workday", 200, term="intern", body="{}"),
            # the first term of the fixed list fails first, though another name sorts before it
            poll("a.wd1/S", "workday", 404, term="intern", body=None), poll("a.wd1/S", "workday", 503, term="co-op", body=None),
            # the profile is that of the newest request
            poll("deep", "lever", 200, profile="FAST"), poll("deep", "lever", 200, page=1, profile="DEEP", at=DAY + dt.timedelta(minutes=1))]
    got = {r["company_slug"]: (r["status"], r["profile"]) for r in P.poll_outcomes(spark.createDataFrame(rows, BRONZE_SCHEMA)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"fine": "ok", "broken": "error", "gone": "dead404", "slow": "pfail", "left": "pfail", "busy": "error",
                                                 "nosite": "error", "a.wd1/S": "dead404", "deep": "ok"}
    assert got["deep"][1] == "DEEP"


def test_detail_worklist(spark):
    items = spark.createDataFrame([("c", "workday", "1", "Data Intern"), ("c", "workday", "2", "Data Intern"), ("c", "workday", "3", "Manager")],
                                  "company_slug string, ats_source string, item_key string, title string")
    stored = items.where(F.col("item_key") == "2").select("company_slug", "ats_source", "item_key")
    assert [r.item_key for r in P.detail_worklist(items, stored).collect()] == ["1"]
    assert sorted(r.item_key for r in P.detail_worklist(items).collect()) == ["1", "2"]
