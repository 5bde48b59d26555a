"""Operator 11 against a plain restatement that tokenises every whole text."""
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rolefeed.llm import queries
from rolefeed.llm import token_alignment as ta
from tests.llm.helpers import DATA, documents, edge_rows, key

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.bytes = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}

    def groups(self, text):
        """Lists of A ids and of B ids, or None."""
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        parts_a = [bytes(self.bytes[c] for c in self.a.id_to_token(x)) for x in a]
        parts_b = [bytes([int(self.b.id_to_piece(x)[3:5], 16)]) if self.b.is_byte(x) else self.b.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            return None
        ends = lambda parts: [sum(map(len, parts[:i + 1])) for i in range(len(parts))] if len(parts) < 50 else list(_running(parts))
        ends_a, ends_b = ends(parts_a), ends(parts_b)
        out, i, j = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            out.append(([], []))
            while i < len(a) and ends_a[i] <= cut:
                out[-1][0].append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= cut:
                out[-1][1].append(b[j])
                j += 1
        return out


def _running(parts):
    at = 0
    for p in parts:
        at += len(p)
        yield at


def brute_force(rows, plain):
    aligned = [(r.doc_id, plain.groups(r.text)) for r in rows]
    held, links = Counter(), []
    for _, groups in aligned:
        found = [(x, y) for left, right in groups or () for x in left for y in right]
        links.append(found)
        held.update(set(found))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for (doc_id, groups), found in zip(aligned, links):
        if groups is None:
            yield doc_id, 0, 0, 0, 0, 0, 0, ""
            continue
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        yield (doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(found),
               sum(held[p] == most[p[0]] for p in found), sum(held[p] for p in found), hashlib.sha256(shown.encode()).hexdigest())


@pytest.fixture(scope="module")
def plain():
    return Plain()


def test_query_against_brute_force(spark, plain):
    got = queries.QUERIES["op11_token_alignment"](spark, DATA)
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(brute_force(documents(spark).collect(), plain))


ODD = [(101, "a  b\n c\td"), (102, " abc"), (103, "a▁b"), (104, "x\x00y 你好 world"), (105, "<|endoftext|> <s> <0x41> </s>"),
       (106, "ends in spaces  "), (107, "\n"), (108, " "), (109, "don't we'll wide space \x1c x"), (110, "é̂ 🏳️‍🌈 ไทย ภาษา " * 40)]


def test_edge_rows(spark, plain):
    rows = [*edge_rows(spark).select("doc_id", "text").collect(), *spark.createDataFrame(ODD, "doc_id long, text string").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(brute_force(rows, plain), key=key)
    assert sorted(map(tuple, ta.align(docs, A, B).documents.select(*COLUMNS).collect()), key=key) == want
    edge = ta.align(edge_rows(spark), A, B)
    assert sorted(map(tuple, edge.documents.select(*COLUMNS).collect()), key=key) == sorted(brute_force(edge_rows(spark).collect(), plain), key=key)
    empty = ta.align(edge_rows(spark, []), A, B)
    assert empty.documents.collect() == [] and empty.pairs.collect() == []


def test_pair_counts_weigh_copies_and_buckets_add_up(spark, monkeypatch, plain):
    monkeypatch.setattr(ta, "BUCKET_BYTES", 40)
    texts = ["the same text here"] * 70 + ["the other text", "here the text the text"] * 3 + ["unrelated wörds"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = ta.align(docs, A, B)
    held = Counter()
    for t in texts:
        held.update({(x, y) for left, right in plain.groups(t) for x in left for y in right})
    assert {(r.a, r.b): r.documents for r in found.pairs.collect()} == held
    assert sorted(map(tuple, found.documents.select(*COLUMNS).collect())) == sorted(brute_force(docs.collect(), plain))


@given(st.text(alphabet="aB é,.'\n\t ​1|<▁\x1c 你ไ", max_size=40))
@settings(max_examples=300, deadline=None)
def test_units_are_the_whole_text(plain, text):
    own = ta._aligner(A, B)
    want = plain.groups(text)
    units = own.aligned(own.units(text) + ["more"]) if text else None
    if want is None:
        assert not text or not units.fine.all()
    else:
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in want)
        assert units.fine.all() and b";".join(units.shown[:-1]).decode() == shown
        assert units.counts[:-1, 3].sum() == sum(len(x) * len(y) for x, y in want)


@pytest.mark.parametrize("step", [1, 3, 50])
def test_large_groups_and_steps(monkeypatch, plain, step):
    monkeypatch.setattr(ta, "STEP", step)
    own = ta._aligner(A, B)
    texts = ["ไทย ภาษา 你好世界 naïve", "antidisestablishmentarianism 1234567 wörds"]
    for text in texts:
        want, got = plain.groups(text), own.aligned(own.units(text))
        links = Counter((x << 32) | y for left, right in want for x in left for y in right)
        held = Counter()
        for p, n in zip(got.pairs.tolist(), got.times.tolist()):
            held[p] += n
        assert held == links and b";".join(got.shown).decode() == ";".join(
            ",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in want)
