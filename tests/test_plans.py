"""Plan checks over every registered query: no cross products or nested-loop
joins, and scans read only the columns they need."""
import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_no_cross_products(spark):
    bad = {}
    for name, fn in E.queries().items():
        if name.startswith(("op", "pipeline")):  # tests/llm
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
        if hits:
            bad[name] = hits
    assert bad == {}


def test_prune_scan_is_pruned(spark):
    plan = E.queries()["Q1_prune_classify"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("l_comment" not in s and "l_quantity" not in s for s in schemas)


def test_one_streak_pass_and_one_prune_join(spark):
    count = lambda name, what: len(re.findall(what, E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()))
    assert count("W3_board_health", "FileScan") <= 2 and count("W4_host_trips", "FileScan") <= 2
    assert count("Q2_prune_apply", "Join ") == 0  # reads the classified rows, joined once
