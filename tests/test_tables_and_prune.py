"""S3-S6 semantics and prune boundaries (FIXTURES D)."""
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rolefeed.plans import prune as pr
from rolefeed.sources import tables as T
from rolefeed.sources.tables import BUCKET

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
LS = "canonical_url string, company_slug string, ats_source string, last_seen_at timestamp"
CS = "company_slug string, ats_source string, still_active boolean, last_polled_at timestamp"


def test_upsert_semantics(spark):
    tgt = spark.createDataFrame([("u1", "A", 1.0, T0), ("u2", "B", 2.0, T0)], "k string, name string, v double, first_seen timestamp")
    src = spark.createDataFrame([("u1", None), ("u3", 5.0)], "k string, v double")
    out = {r["k"]: r for r in T.merge(tgt, src, ["k"], insert_defaults={"first_seen": F.lit(T0 + dt.timedelta(days=1))}).collect()}
    assert out["u1"]["v"] is None and out["u1"]["name"] == "A" and out["u1"]["first_seen"] == T0  # NULL overwrites, absent kept
    assert out["u2"]["v"] == 2.0
    assert out["u3"]["name"] is None and out["u3"]["first_seen"] == T0 + dt.timedelta(days=1)


def test_monotone_stamp(spark):
    tgt = spark.createDataFrame([("u1", T0)], "k string, seen timestamp")
    src = spark.createDataFrame([("u1", T0 - dt.timedelta(hours=1))], "k string, seen timestamp")
    assert T.merge(tgt, src, ["k"], monotone=["seen"]).collect()[0]["seen"] == T0


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/rows") for f in names if f.startswith("part-") and BUCKET in d}


def test_keyed_table_rewrites_touched_buckets_only(spark):
    path = tempfile.mkdtemp(prefix="rolefeed-keyed-") + "/t"
    t = T.KeyedTable(spark, path, "id int, s string", ["id"], 8).create(spark.createDataFrame([(i, f"v{i}") for i in range(100)], "id int, s string"))
    rows = lambda: dict(map(tuple, t.read().collect()))
    before = _files(path)
    t.upsert(spark.createDataFrame([(7, "new")], "id int, s string"))
    after = _files(path)
    assert before < after and len(after - before) == 1 and rows()[7] == "new" and len(rows()) == 100
    t.patch(F.col("id") == 9, {"s": F.lit("patched")})
    t.delete(spark.createDataFrame([(3,)], "id int"))
    kept = _files(path)
    t.append(spark.createDataFrame([(500, "added")], "id int, s string"))
    assert kept < _files(path)
    assert rows() == {i: f"v{i}" for i in range(100) if i != 3} | {7: "new", 9: "patched", 500: "added"}
    assert [r["s"] for r in t.select(["s"], F.col("id") > 98, ["s"]).collect()] == ["added", "v99"]
    t.delete(t.read().select("id"))
    assert t.read().collect() == []


def test_readers_stay_on_their_version_and_an_emptied_bucket_goes_alone(spark):
    path = tempfile.mkdtemp(prefix="rolefeed-keyed-") + "/t"
    t = T.KeyedTable(spark, path, "id int, s string", ["id"], 4).create(spark.createDataFrame([(i, "old") for i in range(40)], "id int, s string"))
    opened = t.read()
    in_bucket = t.near(spark.createDataFrame([(5, "")], "id int, s string"))
    doomed = sorted(r["id"] for r in in_bucket.collect())
    before = _files(path)
    t.delete(in_bucket.select("id"))
    assert _files(path) == before  # no other bucket is written, no file is touched
    t.upsert(spark.createDataFrame([(39, "new"), (99, "new")], "id int, s string"))
    assert sorted(r["id"] for r in opened.collect()) == list(range(40)) and {r["s"] for r in opened.collect()} == {"old"}
    left = {r["id"]: r["s"] for r in t.read().collect()}
    assert sorted(left) == sorted({*range(40), 39, 99} - set(doomed) | {39}) and left[39] == left[99] == "new"
    with pytest.raises(ValueError):
        t.create()


def test_prune_boundaries(spark):
    lst = spark.createDataFrame([
        ("exact", "b1", "lever", T0), ("over", "b2", "lever", T0 - dt.timedelta(microseconds=1)),
        ("nullseen", "b1", "lever", None), ("dead", "b3", "lever", T0 + dt.timedelta(days=9)), ("orphan", "zz", "lever", T0),
    ], LS)
    comp = spark.createDataFrame([
        ("b1", "lever", None, T0 + dt.timedelta(hours=2)), ("b2", "lever", True, T0 + dt.timedelta(hours=2)), ("b3", "lever", False, None),
    ], CS)
    got = {r["canonical_url"]: r["bucket"] for r in pr.classify(lst, comp).collect()}
    assert got == {"exact": "keep", "over": "gone", "nullseen": "keep", "dead": "dead", "orphan": "orphan"}


def test_gate_share_boundaries(spark):
    def share(n_doomed, n_total):
        rows = [(f"u{i}", "b", "lever", T0) for i in range(n_total)]
        lst = spark.createDataFrame(rows, LS)
        comp = spark.createDataFrame([("b", "lever", None, T0)], CS)
        cl = pr.classify(lst, comp).withColumn("bucket", F.when(F.col("canonical_url").isin([f"u{i}" for i in range(n_doomed)]), "gone").otherwise("keep"))
        return pr.report(cl).collect()[0]
    assert share(2, 5)["breach"] is False   # exactly 0.40 is allowed
    assert share(3, 5)["breach"] is True
    empty = pr.report(pr.classify(spark.createDataFrame([], LS), spark.createDataFrame([], CS))).collect()[0]
    assert empty["total"] == 0 and empty["breach"] is False


def test_run_prune_apply_and_abort(spark):
    t = T.KeyedTable(spark, tempfile.mkdtemp(prefix="rolefeed-prune-") + "/t", LS, ["canonical_url"], 4)
    t.create(spark.createDataFrame([(f"u{i}", "b", "lever", T0) for i in range(10)] + [("x", "gone", "lever", T0)], LS))
    healthy = spark.createDataFrame([("b", "lever", None, T0), ("gone", "lever", None, T0 + dt.timedelta(days=1))], CS)
    assert pr.run_prune(t, healthy)["deleted"] == 1 and t.read().count() == 10
    retired = spark.createDataFrame([("b", "lever", False, T0)], CS)
    with pytest.raises(pr.PruneAborted):
        pr.run_prune(t, retired)
    assert pr.run_prune(t, retired, dry_run=True)["breach"] is True and t.read().count() == 10
