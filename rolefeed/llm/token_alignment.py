"""Alignment of the tokens of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full text and counted; a distinct text is tokenised
and aligned once, whatever its number of copies. Byte offsets where tokens of
both tokenizers end cut them into groups, and every two tokens of a group are
linked. How many documents hold a pair of ids linked is a sum over the distinct
texts weighted with their copies. The measures of a text are joined to the ids
of its documents at the end.

Both tokenizers start a new token at a single space between two characters that
are no white space, so groups never cross one: the parts between such spaces
(units) are aligned once each within a bucket of texts, and a text is the sum
of its units. Tokenizers whose files do not guarantee this get whole texts as
units.

A bucket (a few MB of texts of one task) is one row: its different pairs with
their weights, and for each text which of them it holds how often. Only the
different pairs of a bucket are shuffled to be counted, and the counts come
back to the bucket, so a pair that every document holds costs a row a bucket
and no task holds all documents of a pair or all copies of a text.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.common import stored

BUCKET_BYTES = 4 << 20  # text of a bucket
CALL_UNITS = 10_000  # units encoded in one call
STEP = 1 << 20  # tokens or links worked on at a time
READ_ROWS = 128  # texts taken out of an Arrow batch at a time
CUT = re.compile(r" (?<=\S )(?=\S)")  # a single space between characters that are no white space
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Token ids of both tokenizers and their groups, many units at a time."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            config = json.load(f)
        pre = config.get("pre_tokenizer") or {}
        byte_of = _byte_level()
        special = {t["id"] for t in config.get("added_tokens", [])}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = t.encode() if i in special else bytes(map(byte_of.__getitem__, t))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.by_unit = (config.get("normalizer") is None and pre.get("type") == "ByteLevel"
                        and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and not any("▁" in p.lstrip("▁") for p in pieces))

    def units(self, text: str) -> list[str]:
        return CUT.split(text) if self.by_unit else [text]

    def _a_tokens(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one after the other, and how many each has. Units
        with no white space at their ends go through the library as one text,
        which comes apart at their last bytes."""
        plain = np.array([self.by_unit and u == u.strip() != "" for u in units], bool)
        counts, parts = np.zeros(len(units), np.int64), []
        for at in range(0, len(units), CALL_UNITS):  # the library takes many times the size of a text
            part = slice(at, at + CALL_UNITS)
            n = _Joined(self, [u for u, p in zip(units[part], plain[part].tolist()) if p], sizes[part][plain[part]])
            if n.counts is None:
                plain[part] = False
            else:
                counts[part][plain[part]] = n.counts
            single = [" " + u for u, p in zip(units[part], plain[part].tolist()) if not p]
            lists = [e.ids for e in self.a.encode_batch_fast(single, add_special_tokens=False)] if single else []
            counts[part][~plain[part]] = [len(x) for x in lists]
            ids, of = np.empty(counts[part].sum(), np.int64), np.repeat(plain[part], counts[part])
            ids[of] = n.ids[:of.sum()]
            ids[~of] = np.fromiter(chain.from_iterable(lists), np.int64)
            parts.append(ids)
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), counts

    def aligned(self, units: list[str]) -> Units:
        """Each unit with a space before it. All units are aligned as one text:
        tokens of both end where a unit does."""
        data = [(" " + u).encode() for u in units]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        a, a_counts = self._a_tokens(units, sizes)
        b_counts, parts = np.zeros(len(units), np.int64), [np.zeros(0, np.int64)]
        for at in range(0, len(units), CALL_UNITS):
            lists = self.b.encode(units[at:at + CALL_UNITS], num_threads=1)
            b_counts[at:at + CALL_UNITS] = [len(x) for x in lists]
            parts.append(np.fromiter(chain.from_iterable(lists), np.int64))
        b = np.concatenate(parts)
        fine = (_same_bytes(data, sizes, a, a_counts, self.a_bytes, self.a_sizes)
                & _same_bytes(data, sizes, b, b_counts, self.b_bytes, self.b_sizes))
        a, b = a[np.repeat(fine, a_counts)], b[np.repeat(fine, b_counts)]
        a_end, b_end = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        groups = _Groups(a, np.searchsorted(cuts, a_end), b, np.searchsorted(cuts, b_end), len(cuts))

        of_unit = np.zeros(len(units) + 1, np.int64)  # groups before each unit
        of_unit[1:] = np.searchsorted(cuts, np.cumsum(np.where(fine, sizes, 0)), side="right")
        sums = lambda x: (lambda c: c[of_unit[1:]] - c[of_unit[:-1]])(np.concatenate(([0], np.cumsum(x))))
        counts = np.stack([np.where(fine, a_counts, 0), np.where(fine, b_counts, 0), np.diff(of_unit), sums(groups.n_a * groups.n_b)], axis=1)
        blob, ends = groups.shown()
        ends = np.concatenate(([0], ends))[of_unit].tolist()
        shown = [blob[lo:hi - 1] if lo < hi else b"" for lo, hi in zip(ends, ends[1:])]
        pairs, times, per_group = groups.links()
        return Units(fine, counts, shown, pairs, times, sums(per_group))


class _Joined:
    """Units encoded as one text: ids, and how many each unit has (None if the
    text does not come apart at the units' last bytes)."""

    def __init__(self, own: Aligner, units: list[str], sizes: np.ndarray):
        self.ids, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not units:
            return
        self.ids = np.array(own.a.encode_batch_fast([" " + " ".join(units)], add_special_tokens=False)[0].ids, dtype=np.int64)
        ends, wanted = np.cumsum(own.a_sizes[self.ids]), np.cumsum(sizes)
        at = np.searchsorted(ends, wanted)
        fits = len(ends) and at[-1] == len(ends) - 1 and np.array_equal(ends[at], wanted)
        self.counts = np.diff(at, prepend=-1) if fits else None


class Units(NamedTuple):
    fine: np.ndarray  # both tokenizers give the unit's bytes
    counts: np.ndarray  # MEASURES of each
    shown: list[bytes]  # a1,a2|b1;a3|b2,b3
    pairs: np.ndarray  # a << 32 | b, unit after unit
    times: np.ndarray
    n_pairs: np.ndarray  # entries of ``pairs`` of each unit


def _byte_level() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary: Latin-1
    characters that print stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _same_bytes(data: list[bytes], sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray, of: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Whether the tokens of each unit, put together, are its bytes."""
    whole = b"".join(map(of.__getitem__, ids.tolist()))
    ends = np.concatenate(([0], np.cumsum(lengths[ids])))[np.concatenate(([0], np.cumsum(counts)))]
    if np.array_equal(np.diff(ends), sizes) and whole == b"".join(data):
        return np.ones(len(data), bool)
    at = ends.tolist()
    return np.array([whole[lo:hi] == d for lo, hi, d in zip(at, at[1:], data)], bool)


class _Groups:
    """Tokens of both kinds and the number of the group of each, ascending."""

    def __init__(self, a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, n: int):
        self.a, self.b, self.a_group, self.b_group = a, b, a_group, b_group
        self.n_a, self.n_b = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
        self.a_start, self.b_start = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b

    def shown(self) -> tuple[bytes, np.ndarray]:
        """Decimal ids, A before B, with a separator after each; and where each group ends."""
        ids, after = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        ids[np.arange(len(self.a)) + self.b_start[self.a_group]] = self.a
        ids[np.arange(len(self.b)) + (self.a_start + self.n_a)[self.b_group]] = self.b
        ends = np.cumsum(self.n_a + self.n_b)
        after[ends - 1] = ord(";")
        after[ends - self.n_b - 1] = ord("|")
        parts, lengths = [], np.zeros(len(ids) + 1, np.int64)
        for at in range(0, len(ids), STEP):
            part = ids[at:at + STEP]
            n = np.ones(len(part), np.int64)
            for power in range(1, 8):
                n += part >= 10 ** power
            digits = np.zeros((len(part), 9), np.uint8)
            rest = part.copy()
            for column in range(7, -1, -1):
                digits[:, column] = rest % 10 + ord("0")
                rest //= 10
            digits[:, 8] = after[at:at + STEP]
            parts.append(digits[np.arange(9) >= (8 - n)[:, None]].tobytes())
            lengths[at + 1:at + 1 + len(part)] = n + 1
        return b"".join(parts), np.cumsum(lengths)[ends]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of ids, how often each stands for, and entries of each group:
        every link by itself, but the different ids of a very large group once."""
        many = self.n_a * self.n_b
        entries, parts = many.copy(), []
        ends = np.cumsum(many)
        at = 0
        while at < len(many):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, side="right")))
            if many[at] > STEP:
                left, m = np.unique(self.a[self.a_start[at]:self.a_start[at] + self.n_a[at]], return_counts=True)
                right, n = np.unique(self.b[self.b_start[at]:self.b_start[at] + self.n_b[at]], return_counts=True)
                parts.append(((left[:, None] << 32 | right).ravel(), np.outer(m, n).ravel()))
                entries[at] = len(left) * len(right)
            else:
                size, width = many[at:to], self.n_b[at:to]
                i = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                left = self.a[np.repeat(self.a_start[at:to], size) + i // np.repeat(width, size)]
                right = self.b[np.repeat(self.b_start[at:to], size) + i % np.repeat(width, size)]
                parts.append((left << 32 | right, np.ones(len(i), np.int64)))
            at = to
        pairs, times = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
        return pairs, times, entries


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process and pair of files."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


BUCKETS = ("bucket long, pairs array<long>, weights array<long>, keys array<binary>, "
           + ", ".join(f"{m} array<long>" for m in MEASURES)
           + ", groups_sha256 array<string>, held binary, place binary, times binary")


class _Bucket:
    """Texts of one bucket: their units numbered, then aligned all at once."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.unit_ids: dict[str, int] = {}
        self.texts: list[tuple[bytes, int, np.ndarray]] = []  # key, copies, units

    def add(self, key: bytes, copies: int, text: str, own: Aligner) -> None:
        ids = self.unit_ids
        units = np.array([ids.setdefault(u, len(ids)) for u in own.units(text)], dtype=np.int32)
        self.texts.append((key, copies, units))
        self.size += len(text)

    def row(self, own: Aligner) -> pa.RecordBatch:
        units = own.aligned(list(self.unit_ids))
        codes, inverse = np.unique(units.pairs, return_inverse=True)
        starts = np.cumsum(units.n_pairs) - units.n_pairs

        weights = np.zeros(len(codes), np.int64)
        measures, digests, held, place, often = [], [], [], [], []
        for _, copies, ids in self.texts:
            if not units.fine[ids].all():
                measures.append(np.zeros(4, np.int64))
                digests.append("")
                held.append(0)
                continue
            measures.append(units.counts[ids].sum(axis=0))
            digests.append(hashlib.sha256(b";".join([units.shown[i] for i in ids.tolist()])).hexdigest())
            kinds, n = np.unique(ids, return_counts=True)
            size = units.n_pairs[kinds]
            at = np.arange(size.sum()) + np.repeat(starts[kinds] - np.cumsum(size) + size, size)
            local, back = np.unique(inverse[at], return_inverse=True)
            weights[local] += copies
            held.append(len(local))
            place.append(local.astype("<u4"))
            often.append(np.bincount(back, units.times[at] * np.repeat(n, size), len(local)).astype("<u4"))
        table = np.array(measures, dtype=np.int64).reshape(-1, 4)
        joined = lambda parts: np.concatenate(parts).tobytes() if parts else b""
        columns = {
            "bucket": pa.array([self.number], pa.int64()), "pairs": pa.array([codes], pa.list_(pa.int64())),
            "weights": pa.array([weights], pa.list_(pa.int64())), "keys": pa.array([[t[0] for t in self.texts]], pa.list_(pa.binary())),
            **{m: pa.array([table[:, k]], pa.list_(pa.int64())) for k, m in enumerate(MEASURES)},
            "groups_sha256": pa.array([digests], pa.list_(pa.string())),
            "held": pa.array([np.array(held, "<u4").tobytes()], pa.binary()),
            "place": pa.array([joined(place)], pa.binary()), "times": pa.array([joined(often)], pa.binary())}
        return pa.record_batch(columns)


def aligned_buckets(texts: DataFrame, a_path: str, b_path: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``texts``: distinct ``text`` with ``key`` and ``copies``. One row a bucket, as BUCKETS says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _aligner(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        bucket = _Bucket(number)
        for batch in batches:
            for at in range(0, len(batch), READ_ROWS):
                part = batch.slice(at, READ_ROWS)
                for text, key, copies in zip(*[part.column(c).to_pylist() for c in ("text", "key", "copies")]):
                    bucket.add(key, copies, text, own)
                    if bucket.size >= bucket_bytes:
                        yield bucket.row(own)
                        pa.default_memory_pool().release_unused()
                        number += 1
                        bucket = _Bucket(number)
        if bucket.texts:
            yield bucket.row(own)

    return texts.select("text", "key", "copies").mapInArrow(run, BUCKETS)


class Alignment(NamedTuple):
    documents: DataFrame  # a row per document and its measures
    pairs: DataFrame  # a, b, documents, best: every pair of ids that is linked anywhere


def _measured(bucket: pa.Table, counts: pa.Table) -> pa.Table:
    """Measures of the texts of one bucket, with the corpus-wide counts of its pairs."""
    if not len(bucket):
        return pa.table({k: pa.array([], t) for k, t in _MEASURED})
    row = {c: bucket.column(c)[0] for c in bucket.column_names}
    place, times, held = (np.frombuffer(row[c].as_py(), "<u4").astype(np.int64) for c in ("place", "times", "held"))
    of = counts.column("at").to_numpy()
    documents, best = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
    documents[of], best[of] = counts.column("documents").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    ends = np.cumsum(held)
    total = lambda x: (lambda c: c[ends] - c[ends - held])(np.concatenate(([0], np.cumsum(x))))
    return pa.table({
        "key": row["keys"].values, **{m: row[m].values for m in MEASURES},
        "n_best": pa.array(total(best[place] * times)), "count_sum": pa.array(total(documents[place] * times)),
        "groups_sha256": row["groups_sha256"].values}, schema=pa.schema(_MEASURED))


_MEASURED = [("key", pa.binary()), *[(m, pa.int64()) for m in MEASURES], ("n_best", pa.int64()), ("count_sum", pa.int64()),
             ("groups_sha256", pa.string())]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """``documents``: ``doc_id, n_a, n_b`` (tokens of either tokenizer),
    ``n_groups, n_links``, ``n_best`` (links whose pair is held by as many
    documents as any pair of its A id), ``count_sum`` (documents of the pair,
    over all links), ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``). A file of
    the tokenizers library (A, given a space before the text) and a model of
    sentencepiece (B, which adds the space itself), on every worker.

    One row per row of ``docs``, repeated rows and null ids as they come. Texts
    that are null or empty, or that a tokenizer does not give back byte for
    byte, have no tokens: zeros and an empty digest. Very long texts are a
    bucket of their own. An empty table gives an empty result; other columns
    are not read. Rows are joined to their text by its SHA-256."""
    key = F.unhex(F.sha2(F.col("text"), 256))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    buckets = stored(aligned_buckets(texts.withColumn("key", key), a_path, b_path), "aligned-buckets")

    held = buckets.select(F.col("bucket").alias("of"), F.posexplode(F.arrays_zip("pairs", "weights")).alias("at", "p")).select(
        "of", "at", F.col("p.pairs").alias("pair"), F.col("p.weights").alias("weight"))
    counts = held.groupBy("pair").agg(F.sum("weight").alias("documents")).withColumn("a", F.shiftright("pair", 32))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    counts = counts.join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))
    back = held.select("of", "at", "pair").join(counts, "pair").select("of", "at", "documents", "best")
    payload = buckets.select("bucket", "keys", *MEASURES, "groups_sha256", "held", "place", "times")
    schema = "key binary, " + ", ".join(f"{m} long" for m in MEASURES) + ", n_best long, count_sum long, groups_sha256 string"
    measures = stored(payload.groupBy("bucket").cogroup(back.groupBy("of")).applyInArrow(_measured, schema), "text-measures")

    named = [*MEASURES, "n_best", "count_sum"]
    joined = docs.select("doc_id", key.alias("own")).join(measures, F.col("own") == F.col("key"), "left")
    documents = joined.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in named],
                              F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    pairs = counts.select(F.shiftright("pair", 32).cast("int").alias("a"),
                          F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "documents", "best")
    return Alignment(documents, pairs)
