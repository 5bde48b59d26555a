"""Conforming looks at a payload once: shallow type tests, no payload per item."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from rolefeed.functions.text import py_strip
from rolefeed.operators.conform import common
from rolefeed.operators.conform.feeds import conform


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text, array, object_, full", [("[]", True, False, False), ("{}", False, True, False), ('{"a": null}', False, True, True),
                                                         ("null", False, False, False), ('"x"', False, False, False), ("1", False, False, False)])
def test_types_are_told_by_one_level(spark, text, array, object_, full):
    v = F.try_parse_json(F.lit(text))
    kinds = [common.is_array(v), common.is_object(v), common.truthy_object(v)]
    assert list(spark.range(1).select(*[k.alias(str(i)) for i, k in enumerate(kinds)]).first()) == [array, object_, full]
    assert not any("schema_of_variant" in str(k._jc) for k in map(lambda f: f(F.col("v")), (common.is_array, common.is_object, common.truthy_object)))


def test_items_do_not_carry_their_payload(spark):
    body = '{"title": "Feed", "items": [{"url": "https://a.teamtailor.com/jobs/1", "title": "T", "_jobposting": {"jobLocation": [{"address": {"addressLocality": "Oslo"}}]}}]}'
    row = ("a", "teamtailor", "r1", "FAST", dt.datetime(2024, 1, 1), 200, None, "list", None, 0, None, body)
    jobs = conform("teamtailor", spark.createDataFrame([row], common.BRONZE_SCHEMA))
    assert [(r["company"], r["location"]) for r in jobs.collect()] == [("Feed", "Oslo")]
    (generate,) = [x for x in _plan(jobs).splitlines() if "Generate posexplode" in x]
    assert "feed_title" in _plan(jobs) and not generate.split("[")[-1].startswith("v#")


def test_strip_is_pythons_for_every_character(spark):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rows = spark.createDataFrame([(i, c + "a" + c + "b" + c) for i, c in enumerate(points) if c.isspace() or i % 97 == 0], "i int, t string")
    assert all(r["s"] == r["t"].strip() for r in rows.select("t", py_strip("t").alias("s")).collect())
    assert "regexp" not in str(py_strip(F.col("t"))._jc)
