import re

from rolefeed.llm import decontaminate, queries
from tests.llm.helpers import CLASH, DATA, documents, edge_rows

ITEMS = [(1, "A train travels 60 miles in 2 hours from Boston. How many miles does it travel in 5 hours then?"),
         (2, "tiny one"), (3, "Five words are enough here"), (4, None), (None, ""),
         (5, "First Anna gave Bert 7 apples and then Anna took 3 of the apples away from Bert again")]


def test_query_against_plain_windows(spark):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    words = lambda t: re.findall(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+", t.lower())
    windows = {}
    for r in bench:
        w = words(r.text)
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i:i + 8]), set()).add(r.item_id)
    want = set()
    for r in documents(spark).collect():
        w = words(r.text)
        want |= {(r.doc_id, item) for i in range(len(w) - 7) for item in windows.get(tuple(w[i:i + 8]), ())}
    got = queries.op9_decontamination(spark, DATA).collect()
    assert want and {(r.doc_id, r.item_id) for r in got if r.literal} == want
    assert len(got) == len({(r.doc_id, r.item_id) for r in got}) and all(0 < r.coverage <= 1 for r in got)


def test_reparameterised_questions_need_consistent_slots(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = [(1, "So: A train travels 70 km in 3 hours from Leeds. How many km does it travel in 9 hours then? yes"),
            (2, "A TRAIN TRAVELS 60 MILES IN 2 HOURS FROM BOSTON"), (3, "five words are enough here now"),
            (4, "First Carl gave Dora 9 apples and then Carl took 4 of the apples away from Dora again"),
            (5, "First Carl gave Dora 9 apples and then Emil took 4 of the apples away from Fred again"),
            (6, "tiny one"), (7, "a train of words that has 5 hours and many miles"), (8, None)]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 3), (4, 5)}
    assert not got[1, 1].literal and got[1, 1].coverage == 1 and got[2, 1].literal and not got[4, 5].literal


def test_kinds_of_words():
    words = decontaminate.canonical(["It took Anna 3 min. In 5,5 km Bob slept", None, "min 3"])
    marked = [(words.tokens[p], t) for p, k, t in zip(words.place.tolist(), words.kind.tolist(), words.text_of.tolist()) if k]
    assert marked == [("Anna", 0), ("3", 0), ("min", 0), ("5,5", 0), ("km", 0), ("Bob", 0), ("3", 2)]


def test_edge_rows(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    out = decontaminate.clean(edge_rows(spark), items)
    assert set(CLASH) < set(out.columns)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([3, 4, 5, 6, 7, None, None, 8, 9], key=str)
    assert decontaminate.leaks(edge_rows(spark, []), items).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(edge_rows(spark), none).count() == 12
