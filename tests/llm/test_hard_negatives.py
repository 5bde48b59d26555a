"""Operator 12 against all pairs."""
import math
import random

import numpy as np
import pytest

from rolefeed.llm import hard_negatives as hn
from rolefeed.llm import queries
from tests.llm.helpers import CLASH, DATA


def brute_force(rows, positives=5, negatives=10, share=(30, 90), every=100, scale=256):
    """rows: vec_id, label, components."""
    kept = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        q = [math.floor(scale * float(x)) for x in vec]
        if sum(x * x for x in q) < 1 << 62:
            kept[i] = min(kept.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in kept.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, other)), i, other_label == label) for i, (other_label, other) in kept.items() if i != a]
        for s, p, _ in sorted(t for t in scored if t[2])[:positives]:
            window = sorted(t[:2] for t in scored if not t[2] and share[0] * -s <= 100 * -t[0] <= share[1] * -s)
            out += [(a, p, k, n, -s, -t) for k, (t, n) in enumerate(window[:negatives], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in hn.mine(df, **options).collect())


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    want = brute_force(rows)
    assert len(want) > 50 and sorted(map(tuple, queries.QUERIES["op12_hard_negatives"](spark, DATA).collect())) == want


def clustered(n, dims, seed, grid=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = []
    for i in range(n):
        v = centres[rng.integers(5)] * 0.4 + rng.normal(size=dims) * 0.3
        rows.append((i, int(rng.integers(4)), [float(x) for x in (np.round(v) if grid else v)]))
    return rows


@pytest.mark.parametrize("dims,grid", [(40, False), (3, True)])
def test_rounds_and_blocks_change_nothing(spark, monkeypatch, dims, grid):
    """Many equal scores and classes (grid), several rounds, tiny chunks."""
    rows = clustered(600, dims, dims, grid)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = brute_force(rows, every=20, positives=3, negatives=7)
    assert len(want) > 100 and mined(df, every=20, positives=3, negatives=7) == want
    for name, value in {"SPARE": 0.1, "FASTER": 3, "GROUP": 2, "CELLS": 500, "VERIFY": 7, "FEW": 0.5}.items():
        monkeypatch.setattr(hn, name, value)
    assert mined(df, every=20, positives=3, negatives=7, block_rows=50) == want


def test_a_third_of_the_rows_are_one_vector(spark):
    hot = [0.25, -0.5, 0.125, 0.5]
    rows = [(i, i % 3 and 1, hot if i % 2 else [(i * k % 17 - 8) / 16 for k in (1, 3, 5, 7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert mined(df, every=5) == brute_force(rows, every=5)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (100, 1, [0.25, 0.5]), (200, 2, [0.5, 0.25, 0.125]), (300, 2, []), (4, 2, [0.3, 0.3]),
            (4, 3, [0.3, 0.1]), (5, 3, [0.0, 0.0]), (None, 1, [0.5, 0.5]), (7, None, [0.5, 0.5]), (8, 1, None), (9, 1, [None, 1.0]),
            (10, 2, [nan, 1.0]), (11, 2, [inf, 1.0]), (12, 2, [1e300, 1.0]), (13, 2, [0.5, -0.5]), (-100, 1, [-0.5, -0.5]), (14, 2, [0.4, 0.3])]
    schema = "vec_id long, label int, embedding array<double>" + "".join(f", `{c}` string" for c in (*CLASH, "vec", "qid", "block", "window"))
    df = spark.createDataFrame([(*r, *["x"] * (len(CLASH) + 4)) for r in rows], schema)
    want = brute_force(rows)
    assert want and mined(df) == want
    assert mined(df.limit(0)) == [] and mined(df.where("label is null")) == []


@pytest.mark.parametrize("size", [1.0, 3000.0, 2e6])
def test_scores_are_exact_at_every_size(spark, size):
    """Integer vectors whose scores need 24, 53 and 62 bits."""
    random.seed(5)
    rows = [(i, i % 3, [random.uniform(-size, size) for _ in range(20)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(df, every=10) == brute_force(rows, every=10)
