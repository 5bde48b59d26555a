from collections import defaultdict

import duckdb

from rolefeed.llm import exact_dedup, queries
from tests.llm.helpers import DATA, documents, edge_rows


def test_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    res = con.execute(queries.ORACLES["op8_exact_dedup"])
    names = [d[0] for d in res.description]
    want = sorted(tuple(r) for r in res.fetchall())
    got = sorted(tuple(r) for r in queries.op8_exact_dedup(spark, DATA).select(names).collect())
    assert got == want


def test_small_radix_steps_give_the_same_groups(spark):
    rows = documents(spark).select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r.text].append(r.doc_id)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(documents(spark), first=2).collect()}
    assert got == {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}


def test_texts_that_differ_late_or_in_length_only(spark):
    long = "x" * 5000
    docs = spark.createDataFrame([(1, long + "a"), (2, long + "b"), (3, long), (4, long + "a"), (5, long + "\0")], "doc_id long, text string")
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(docs).collect()}
    assert got == {1: 4, 2: 2, 3: 3, 4: 4, 5: 5}


def test_edge_rows(spark):
    got = exact_dedup.exact_groups(edge_rows(spark), carry=["text", "rest"]).collect()
    assert len(got) == 12 and all(r.rest == "x" for r in got)
    fox = [r for r in got if r.text and r.text.startswith("The quick")]
    assert [r.group_size for r in fox] == [3] * 3 and sum(r.kept for r in fox) == 1 and {r.keep_id for r in fox} == {2}
    empty = [r for r in got if not r.text]
    assert len(empty) == 3 and {r.keep_id for r in empty} == {4} and sum(r.kept for r in empty) == 1
    assert exact_dedup.exact_groups(edge_rows(spark, [])).collect() == []
