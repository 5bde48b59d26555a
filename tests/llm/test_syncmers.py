"""Operator 13 against a plain restatement that reads every text by itself."""
import hashlib

import xxhash
from pyspark.sql import functions as F

from rolefeed.llm import queries, syncmers
from tests.llm.helpers import CLASH, DATA, documents, edge_rows

K, S, RUNS = 31, 8, 24


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(text):
    return _signed(xxhash.xxh64_intdigest(text.encode(), 42))


def xx_longs(*values):
    seed = 42
    for v in values:
        seed = _xx_long(v, seed)
    return seed


def _xx_long(value, seed):
    return xxhash.xxh64_intdigest((value % (1 << 64)).to_bytes(8, "little"), seed)


def plain_anchors(text):
    h = [xx(text[i:i + S]) for i in range(len(text) - S + 1)]
    out = []
    for i in range(len(h) - RUNS + 1):
        least = min(h[i:i + RUNS])
        if least in (h[i], h[i + RUNS - 1]):
            out.append((i, xx_longs(*[h[i + c] for c in (0, 8, 16, 23)]) & 0xFFFFFFFF))
    return out or [(0, xx(text) & 0xFFFFFFFF)]


def plain_fingerprint(found):
    steps = [(p - (found[i - 1][0] if i else 0), h) for i, (p, h) in enumerate(found)]
    return "".join(f"{gap:02x}{h:08x}" for gap, h in steps)


def plain_links(found):
    if len(found) == 1:
        return {(0, found[0][1])}
    return {(h0, p1 - p0, h1) for (p0, h0), (p1, h1) in zip(found, found[1:])}


def like(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def brute_force(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), xx(r[1])))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed, other = map(plain_anchors, (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(own), plain_fingerprint(changed),
                    like(plain_links(own), plain_links(changed)), like(plain_links(own), plain_links(other))))
    return out


def same(got, want):
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_query_against_brute_force(spark):
    got = queries.QUERIES["op13_syncmers"](spark, DATA).collect()
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    same(got, brute_force(rows))
    assert all(abs(r.near_edited - 0.5) < 0.25 for r in got if r.n_chars > 4000) and sum(r.near_next > 0.5 for r in got) < 20


def test_edge_rows_and_buckets(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge_rows(spark).collect()]
    want = brute_force(rows)
    same(syncmers.against_next(edge_rows(spark)).collect(), want)
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 2)
    same(syncmers.against_next(edge_rows(spark).repartition(4)).collect(), want)
    assert syncmers.against_next(edge_rows(spark, [])).collect() == []
    one = [(5, "a single document " * 9, "en")]
    same(syncmers.against_next(edge_rows(spark, one)).collect(), brute_force([r[:2] for r in one]))
    clash = spark.createDataFrame([(1, "x", *"abcdefgh")], "doc_id long, text string, bucket string, guest string, at string, next string, found string, edited string, n string, own string")
    assert len(syncmers.against_next(clash).collect()) == 1 and len(CLASH) > 0


def test_characters_beyond_the_basic_plane_and_repeats(spark, monkeypatch):
    texts = ["🏳️‍🌈𝒜𝒷 ไทย 你好 " * 9, "aaaa" * 30, "ab" * 40, "x" * 30, "y" * 31, "z" * 54, "naïve café " * 20]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(syncmers.against_next(df).collect(), brute_force(rows))
    monkeypatch.setattr(syncmers, "PIECE", 37)
    same(syncmers.against_next(df).collect(), brute_force(rows))


def test_anchors_are_dense_and_know_no_context(spark):
    rows = [r for r in syncmers.fingerprints(documents(spark)).collect() if r.n_chars >= K + 2 * RUNS]
    for r in rows:
        places = [c >> 32 for c in r.anchors]
        ends = [-1, *places, r.n_chars - K + 1]
        assert max(b - a for a, b in zip(ends, ends[1:])) <= K - S + 1
    text = documents(spark).where(F.length("text") > 3000).first().text
    inner = {(p - 1000, h) for p, h in plain_anchors(text) if 1000 <= p <= 2000 - K}
    assert inner and inner == set(plain_anchors(text[1000:2000]))
