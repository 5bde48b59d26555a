"""Board extraction and classification over invented boards."""
from rolefeed.operators import boards


def run(spark, fn, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "i int, url string")
    return [(r["ats_source"], r["company_slug"]) for r in fn(df).orderBy("i").collect()]


def test_extract(spark):
    cases = {
        "https://loom.wd2.myworkdayjobs.com/de-DE/Weavers/job/Turin/Y1": ("workday", "loom.wd2/Weavers"),
        "https://loom.wd2.myworkdayjobs.com/Dyers_Only": ("workday", "loom.wd2/Dyers_Only"),
        "https://LOOM.wd12.myworkdayjobs.com/it/MixedCase": ("workday", "loom.wd12/MixedCase"),
        "https://loom.wd2.myworkdayjobs.com": (None, None),
        "https://loom.wd2.myworkdayjobs.com/login/x": (None, None),
        "https://loom.myworkdayjobs.com/Weavers": (None, None),
        "https://jobs.ashbyhq.com/Orchard/pear": ("ashby", "orchard"),
        "https://jobs.ashbyhq.com/static/app.js": (None, None),
        "https://talent.fjord.teamtailor.com/jobs/9": ("teamtailor", "fjord"),
        "https://breezy.hr/about": (None, None),
        "https://quarry.test/jobs": (None, None)}
    assert run(spark, lambda d: boards.extract_board(d, "url"), list(cases)) == list(cases.values())


def test_a_domain_table_gives_the_same_as_the_list(spark):
    urls = ["https://a.fjord.recruitee.com/o/1", "https://apply.workable.com/harbor/j/1", "https://quarry.applytojob.com", "https://apply.workable.com.bad.test/a"]
    want = [("recruitee", "a"), ("workable", "harbor"), ("jazzhr", "quarry"), (None, None)]
    assert run(spark, lambda d: boards.extract_board(d, "url"), urls) == want
    assert run(spark, lambda d: boards.extract_board(d, "url", boards.domain_table(spark)), urls) == want


def test_classify(spark):
    cases = {
        "https://job-boards.greenhouse.io/Meadow/jobs/3": ("greenhouse", "meadow"),
        "https://boards.greenhouse.io/embed/job_board?b=2&for=Meadow": ("greenhouse", "meadow"),
        "https://boards.greenhouse.io": ("greenhouse", None),
        "https://jobs.smartrecruiters.com/prism/77": ("smartrecruiters", "prism"),
        "https://quarry.bamboohr.com/careers/88": ("bamboohr", "quarry"),
        "https://jobs.lever.co.other.test/x": (None, None), "https://harbor.test": (None, None)}
    assert run(spark, lambda d: boards.classify_ats(d, "url"), list(cases)) == list(cases.values())
