"""Cell tests for the Column expressions: literal expected values."""
from pyspark.sql import functions as F

from conftest import evaluate
from rolefeed.functions import geo, misc, rules, text, urls


def one(spark, value, expr_fn, typ="string"):
    return evaluate(spark, [(value,)], f"x {typ}", r=expr_fn(F.col("x")))[0]["r"]


def test_country(spark):
    cases = [("fr", None, "France"), ("JP", None, "Japan"), ("italy", None, "Italy"), ("United States of America", None, "United States"),
             ("Scotland", None, "United Kingdom"), ("Worldwide", None, None), (None, None, None), ("Espana", None, "Spain"),
             (None, "Denver, CO", "United States"), (None, "Boise, ID, United States", "United States"), (None, "Leeds, UK", "United Kingdom"),
             (None, "Graz, Austria", "Austria"), (None, "Anywhere - US", "United States"), (None, "Pune, MH", None), (None, "", None),
             ("nz", "Napier", "New Zealand"), ("U.S.", None, "United States"), (None, "Dover, DE", "United States")]
    got = evaluate(spark, [c[:2] for c in cases], "s string, l string", r=geo.country_of(F.col("s"), F.col("l")))
    assert {c[:2]: g["r"] for c, g in zip(cases, got)} == {c[:2]: c[2] for c in cases}


def test_normalize_url(spark):
    cases = {"https://jobs.ashbyhq.com/Orchard/pear/?ref=mail#top": "https://jobs.ashbyhq.com/Orchard/pear",
             "http://JOBS.Ashbyhq.COM/x": "https://jobs.ashbyhq.com/x", "https://apply.workable.com:443/harbor/": "https://apply.workable.com/harbor",
             "https://me:pw@Breezy.HR:99/a//": "https://breezy.hr/a", "\t https://under_score.test/y ": "https://under_score.test/y",
             "breezy.hr/x": "https:///breezy.hr/x", "": None}
    got = evaluate(spark, [(u,) for u in cases], "u string", r=urls.normalize_url(F.col("u")), twice=urls.normalize_url(urls.normalize_url(F.col("u"))))
    assert [g["r"] for g in got] == [g["twice"] for g in got] == list(cases.values())
    assert one(spark, None, urls.normalize_url) is None


def test_query_param(spark):
    assert one(spark, "https://boards.greenhouse.io/embed/job_board?x=0&for=Green%20Meadow", lambda c: urls.query_param(c, "for")) == "Green Meadow"
    assert one(spark, "https://boards.greenhouse.io/embed", lambda c: urls.query_param(c, "for")) is None


def test_salary(spark):
    cases = [("18", "22", "hour", "CHF", "CHF 18–22/hour"), ("700", None, "week", "NOK", "NOK 700/week"), (None, "31000", "year", None, "31000/year"),
             (None, "", "year", "GBP", None), ("0.0", "0", "day", "GBP", None), ("95", "95", "", "PLN", "PLN 95")]
    got = evaluate(spark, [c[:4] for c in cases], "a string, b string, p string, c string", r=misc.format_salary(F.col("a"), F.col("b"), F.col("p"), F.col("c")))
    assert [g["r"] for g in got] == [c[4] for c in cases]


def test_unpaid(spark):
    cases = [("Trainee", "Please note that this internship is unpaid", True), ("Unpaid internship", None, True), ("Volunteer position", "Help out", True),
             ("Helper", "No compensation", True), ("Clerk", "You may take unpaid leave", False), ("Clerk", "Pay is monthly", False), ("Clerk", "", False)]
    got = evaluate(spark, [c[:2] for c in cases], "t string, d string", r=misc.is_unpaid(F.col("t"), F.col("d")))
    assert [g["r"] for g in got] == [c[2] for c in cases]


def test_display_name(spark):
    cases = {"green-meadow": "Green Meadow", "fjord_works_ab": "Fjord Works Ab", "LOOM": "Loom", "prism-20240101": "Prism", "77-88": "77 88", "": None, "--": None}
    got = evaluate(spark, [(a,) for a in cases], "s string", r=misc.display_name(F.col("s")))
    assert [g["r"] for g in got] == list(cases.values())


def test_ms_to_iso(spark):
    cases = {"1735689600000": "2025-01-01T00:00:00+00:00", "1735689600007": "2025-01-01T00:00:00.007000+00:00", "": None, "soon": None,
             "88888888888888888888": None, "-86400000": "1969-12-31T00:00:00+00:00"}
    got = evaluate(spark, [(a,) for a in cases], "s string", r=misc.ms_to_iso(F.col("s")))
    assert [g["r"] for g in got] == list(cases.values())


def test_relative_posted(spark):
    cases = {"Posted Today": "2025-03-10", "posted yesterday": "2025-03-09", "Posted 9 Days Ago": "2025-03-01", "Posted 30+ Days Ago": None, "Posted": None}
    got = evaluate(spark, [(a,) for a in cases], "s string", r=misc.relative_posted(F.col("s"), "2025-03-10"))
    assert [g["r"] for g in got] == list(cases.values())


def test_strip_html(spark):
    cases = {"<div>Glass <em>and</em> sand</div>": "Glass and sand", "x &lt;y&gt; &amp;amp; z": "x &amp; z", "&copy; 1999 &middot; &quot;a&quot;": "© 1999 · \"a\"",
             "no semicolon &amp here &ltb": "no semicolon & here <b", "&notin; &#252; &#x1F680; &#128;": "∉ ü 🚀 €", "a \t\n b\x1fc": "a b c",
             "<ol><li>one</li><li>two</li></ol>": "one two", "": "", "&nbsp;&nbsp;edge&nbsp;": "edge", "3 < 4 > 2": "3 2", "&bogus; &": "&bogus; &"}
    got = evaluate(spark, [(s,) for s in cases], "s string", r=text.strip_html(F.col("s")))
    assert {s: g["r"] for s, g in zip(cases, got)} == cases
    assert one(spark, None, text.strip_html) == ""


def test_two_gates(spark):
    cases = [("Cloud Intern", "Run servers", "", ["intern"], True), ("Avionics Co-op", "Fly", "", ["co-op"], True), ("Bakery Intern", "Knead dough", "", ["intern"], False),
             ("Lead Developer", "Software", "", [], False), ("Internet Developer", "Sites", "", [], False), ("Cooperation Data Lead", "Data", "", [], False),
             ("Data Analyst", "Tables", "Internship", ["intern"], True), ("New-Grad Developer", "Code", "", ["new grad"], True),
             ("Early Career ML Role", "", "", ["early career"], True), ("ñintern data", "", "", [], False)]
    hard, bag = rules.hard_gate(F.col("t"), F.col("e")), rules.field_bag(F.col("t"), F.col("d"))
    got = evaluate(spark, [c[:3] for c in cases], "t string, d string, e string", h=hard, b=bag, k=rules.keywords(hard, bag))
    assert [g["h"] for g in got] == [c[3] for c in cases]
    assert [bool(g["h"]) and bool(g["b"]) for g in got] == [c[4] for c in cases]
    assert got[0]["k"] == ["cloud", "intern"]


def test_unescape_is_that_of_the_standard_library(spark):
    import html
    import random

    r = random.Random(9)
    bits = ["&", "#", "x", "X", ";", "amp", "lt", "notin", "notit", "copy", "Copy", "AMP", "CounterClockwiseContourIntegral", "acE", "38", "0", "128", "159",
            "00000065", "D800", "110000", "99999999999999999999", "fdd0", "1F600", "11", "1", "a", " ", "é", "\t", "𝔸", "=", "NotEqualTilde;", "&&", "&#", "fffe"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(1, 12))) for _ in range(1500)]
    texts += [f"&{k}" for k in list(html.entities.html5)[::7]] + [f"&#{n};" for n in range(0, 300)] + [f"&#x{n:x}" for n in (0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 0xDFFF, 0xE000)]
    got = evaluate(spark, [(t,) for t in texts], "s string", r=text.unescape(F.col("s")))
    wrong = [(t, g["r"], html.unescape(t)) for t, g in zip(texts, got) if g["r"] != html.unescape(t)]
    assert wrong == []


def test_page_text_runs_no_python(spark):
    df = spark.createDataFrame([("&amp;",)], "s string").select(text.strip_html(F.col("s")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
