"""Boards are extracted once a URL, and different URLs only."""
from pyspark.sql import functions as F

from rolefeed.operators.boards import extract_board
from rolefeed.plans.repair import harvest_composites


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_the_board_does_not_repeat_the_extraction(spark):
    urls = spark.createDataFrame([("https://co1.wd2.myworkdayjobs.com/en-US/Site/job/1",), (None,)], "url string")
    found = extract_board(urls).where(F.col("ats_source") == "workday")
    assert [r["company_slug"] for r in found.collect()] == ["co1.wd2/Site"]
    assert not [x for x in _plan(found).splitlines() if "Filter" in x and "regexp" in x]


def test_a_url_captured_often_is_looked_at_once(spark):
    captures = spark.createDataFrame([('"https://co1.wd2.myworkdayjobs.com/en-US/Site/job/1"',)] * 3, "value string")
    found = harvest_composites(captures)
    assert [tuple(r) for r in found.collect()] == [("co1.wd2/Site",)]
    assert _plan(found).count("Aggregate") == 2
