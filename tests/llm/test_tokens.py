"""Token shards and packing: exact round trips through the plain library."""
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rolefeed.llm import packing, queries, token_files
from rolefeed.llm.common import new_folder
from rolefeed.llm.encoder import Encoder, encoder
from tests.llm.helpers import DATA, documents, edge_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.TOKENIZER)


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é,.'\n\t ​1|<", max_size=25)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_encoder_is_the_library(texts):
    own = encoder(queries.TOKENIZER)
    got = [x.tolist() for x in own.many(pa.array(texts, pa.string()))]
    assert got == [own.library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encoder_takes_texts_in_several_batches(monkeypatch, library):
    from rolefeed.llm import encoder as module

    texts = ["one two three", None, "seven eight. nine, ten", "<|endoftext|> x <|endoftext|>", "", "a  b", "x.\ny z.,\n"] * 5
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for name in ("BATCH_BYTES", "CALL_WORDS", "GATHER_TOKENS"):
        monkeypatch.setattr(module, name, 3)
        assert [x.tolist() for x in Encoder(queries.TOKENIZER).many(pa.array(texts))] == want


def expected(rows, library):
    rows = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    out, at = [], 0
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((r.doc_id, at, ids))
        at += len(ids)
    return out


def test_shards_hold_the_documents(spark, library):
    want = expected(documents(spark).collect(), library)
    got = {r.doc_id: r for r in queries.op2_token_files(spark, DATA).collect()}
    assert {i: (g.start, g.n_tokens, g.ids_crc32) for i, g in got.items()} == {i: (a, len(x), zlib.crc32(x.tobytes())) for i, a, x in want}


def test_sequences_are_fixed_size_and_give_back_all_ids(spark, library, tmp_path):
    folder = new_folder(spark, "test-shards")
    token_files.write(documents(spark), folder, queries.TOKENIZER, seq_len=64, shard_tokens=5000)
    rows = sorted(token_files.read_sequences(spark, folder).collect(), key=lambda r: (r.place, r.shard, r.row))
    assert len({(r.place, r.shard) for r in rows}) > 5 and all(len(r.input_ids) == len(r["mask"]) == 64 for r in rows)
    ids = [x for r in rows for x, m in zip(r.input_ids, r["mask"]) if m]
    assert ids == [int(x) for _, _, doc in expected(documents(spark).collect(), library) for x in doc]
    content = token_files._shards(spark, folder).first()["content"]
    table = pa.ipc.open_file(pa.BufferReader(bytes(content)))
    assert pa.types.is_fixed_size_list(table.schema.field("input_ids").type) and table.schema.field("input_ids").type.value_type == pa.uint16()


def test_shards_of_edge_rows(spark, library):
    folder = new_folder(spark, "test-shards")
    token_files.write(edge_rows(spark), folder, queries.TOKENIZER)
    got = token_files.read_documents(spark, folder).collect()
    assert len(got) == 12 and sorted(r.n_tokens for r in got if r.doc_id in (3, 4)) == [1, 1]
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    assert [r.doc_id for r in ordered] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    empty = new_folder(spark, "test-shards")
    token_files.write(edge_rows(spark, []), empty, queries.TOKENIZER)
    assert token_files.read_documents(spark, empty).collect() == []


def check_packed(rows, packed, library, capacity):
    want = {}
    for r in rows:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.setdefault(r.doc_id, []).append(ids)
    placed = packed.placed.collect()
    assert sum(r.length for r in placed) == sum(len(x) for xs in want.values() for x in xs)
    sequences = {}
    for r in sorted(placed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
        assert any(zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in want[r.doc_id])
    assert max(sequences.values()) <= capacity
    waste = [capacity - n for n in sequences.values() if n != capacity and n & (n - 1)]
    assert waste == []
    for r in packing.sequences(packed).collect():
        assert r.n_tokens == sequences[r.sequence_id] == len(r.ids) // 4


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing(spark, library, capacity):
    rows = documents(spark).collect()
    check_packed(rows, packing.pack(documents(spark), queries.TOKENIZER, capacity=capacity), library, capacity)


def test_packing_of_edge_rows(spark, library):
    check_packed(edge_rows(spark).collect(), packing.pack(edge_rows(spark), queries.TOKENIZER, capacity=128), library, 128)
    assert packing.pack(edge_rows(spark, []), queries.TOKENIZER).placed.collect() == []


def test_packing_when_most_lengths_are_equal(spark, library):
    docs = spark.createDataFrame([(i, "word " * 39 + "end") for i in range(200)], "doc_id long, text string")
    check_packed(docs.collect(), packing.pack(docs, queries.TOKENIZER, capacity=64), library, 64)


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=8), st.integers(0, 40))
@settings(max_examples=200, deadline=None)
def test_best_fill_is_the_best_subset_sum(counts, target):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= target}
    best, used = packing.best_fill(counts, target)
    assert best == max(sums) == sum(x * n for x, n in used.items()) and all(n <= counts[x] for x, n in used.items())


@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=10))
@settings(max_examples=200, deadline=None)
def test_plan_places_every_rank_once(histogram):
    rows = packing.plan(histogram, 32)
    for length, n in histogram.items():
        firsts = sorted(r[1] for r in rows if r[0] == length)
        assert firsts and firsts[0] == 0 and all(f < n for f in firsts)
