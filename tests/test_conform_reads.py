"""A field is read from its payload once."""
import datetime as dt
import json

from pyspark.sql import functions as F

from rolefeed.functions import misc
from rolefeed.operators.conform import common, feeds

SR = feeds._Feeds(["smartrecruiters"])


def _count(column, name):
    return str(column._jc).count(f"{name}(")


def test_a_field_stands_in_the_plan_once(spark):
    fields = feeds._fields(SR)
    assert _count(fields["text"], "variant_get") == 4  # label or name of two objects
    assert _count(fields["place"], "variant_get") == 4  # two texts, each taken out and told by its type
    assert _count(fields["employment"], "variant_get") == 2
    assert _count(feeds.detail_description(F.col("j")), "variant_get") == 3
    assert _count(misc.display_name(F.col("s")), "rlike") == 1


def test_labels_and_texts_of_any_type(spark):
    item = lambda **kv: {"id": "1", "name": "T", **kv}
    items = [item(department={"label": "", "name": "Eng"}, function={"label": "Ops", "name": "x"}, location={"city": "Oslo", "region": " "}),
             item(department="Eng", function=None, location={"city": 5, "region": "Viken"}, typeOfEmployment={"label": 7}),
             item(department={"label": {"b": 1, "a": 2}}, location="Oslo"), item(location={"city": "", "region": ""})]
    rows = [("a", "smartrecruiters", "r1", "FAST", dt.datetime(2024, 1, 1), 200, None, "list", None, 0, None, json.dumps({"content": items}))]
    rows += [("a", "smartrecruiters", "r1", "FAST", dt.datetime(2024, 1, 1), 200, None, "detail", None, 0, "9", json.dumps(d))
             for d in ({"jobAd": {"sections": {"jobDescription": {"text": ""}, "qualifications": {"text": "<b>Q</b> &amp; A"}}}}, {"jobAd": 3})]
    got = feeds.detailed_rows(spark.createDataFrame(rows, common.BRONZE_SCHEMA), ["smartrecruiters"]).collect()
    lists = sorted((r for r in got if not r["detail"]), key=lambda r: r["item_pos"])
    assert [(r["text"], r["place"], r["employment"]) for r in lists] == [("Eng Ops", "Oslo", ""), ("", "Viken", "7"), ('{"a":2,"b":1}', "", ""), ("", "", "")]
    assert sorted(str(r["info"] and r["info"]["text"]) for r in got if r["detail"]) == ["None", "Q & A"]


def test_workday_details_of_any_type(spark):
    infos = [{"jobDescription": "", "country": {"descriptor": "Norway"}}, {"jobDescription": "D", "country": "Peru", "location": "Lima"}, {"country": 5}, "x", None]
    rows = [("t.wd1/S", "workday", "r1", "FAST", dt.datetime(2024, 1, 1), 200, None, "detail", None, 0, str(i), json.dumps({"jobPostingInfo": x})) for i, x in enumerate(infos)]
    got = feeds.detailed_rows(spark.createDataFrame(rows, common.BRONZE_SCHEMA), ["workday"]).collect()
    said = {r["key"]: r["info"] and tuple(r["info"][c] for c in ("told", "text", "place", "country")) for r in got}
    assert said == {"0": (False, "", None, "Norway"), "1": (True, "D", "Lima", "Peru"), "2": (False, None, None, None), "3": None, "4": None}
