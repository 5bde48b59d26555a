import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rolefeed.llm import simhash
from tests.llm.helpers import CLASH, documents, edge_rows


def plain_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i, a in fps.items():
            for j, b in fps.items():
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


@given(st.text(alphabet="aAbB \t\n\x0bé .", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_is_the_majority_of_the_shingle_hashes(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.sql("select 'the quick brown' t").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest(b"the quick brown", 42)


def test_whole_table_against_brute_force(spark):
    rows = documents(spark).collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    want = plain_components(fps)
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(spark)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].fingerprint == f"{fps[i]:016x}" and got[i].component_id == want[i] for i in fps)


@pytest.mark.parametrize("cell_rows", [simhash.CELL_ROWS, 40])
def test_links_connect_what_all_pairs_connect_also_when_cells_are_split(spark, cell_rows):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 30, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in r.choice(64, r.integers(0, 5), replace=False)) for b in base for _ in range(12)]
    fps = {i: f for i, f in enumerate(sorted(set(near)))}
    want = plain_components(fps)
    df = spark.createDataFrame([(i, f - 2**64 if f >> 63 else f) for i, f in fps.items()], "doc_id long, fp long")
    label = {i: i for i in fps}
    at = {f: i for i, f in fps.items()}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = simhash.links(df, cell_rows=cell_rows).collect()
    for x in links:
        a, b = at[x.a % 2**64], at[x.b % 2**64]
        i, j = sorted((root(a), root(b)))
        label[j] = i
    groups = lambda f: {tuple(sorted(k for k in fps if f(k) == g)) for g in {f(k) for k in fps}}
    assert groups(root) == groups(want.get)
    if cell_rows == simhash.CELL_ROWS:
        assert len(links) < 40 * len(fps)  # a forest per task, not all pairs


def test_edge_rows(spark):
    got = sorted(simhash.near_duplicates(edge_rows(spark)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.fingerprint))
    assert len(got) == 12
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == 1 and by[1].n_links == 2
    assert by[3].fingerprint == by[4].fingerprint == by[5].fingerprint == "0" * 16 and by[5].component_id == 3
    kept = simhash.one_of_each_group(edge_rows(spark))
    assert set(CLASH) < set(kept.columns)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 6, 7, 8, 9] and ids.count(None) == 2
    assert simhash.near_duplicates(edge_rows(spark, [])).collect() == []
