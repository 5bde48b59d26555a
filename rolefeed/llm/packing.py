"""Sequence packing by minimum bin slack.

Each document is cut at every ``capacity`` tokens. Full pieces are sequences
of their own; of the remainders only the histogram of their lengths (below
``capacity`` values, whatever the input) goes to the driver. There, windows are
planned one kind after the other: the longest remaining length is taken, a
bitset subset-sum dynamic program over the remaining multiset finds the fill
closest to the capacity, the counts of the lengths used are backtracked, and
the kind is used as often as the counts allow. When the closest fill leaves
slack, no padding is accepted: such lengths are set aside and, as cutting is
free, they follow each other in one stream that is cut at every ``capacity``
tokens, its end at powers of two.

A piece finds its place by its length and its rank among the pieces of that
length: the task that encodes it numbers it, a prefix sum over the tasks'
counts makes the number global, and arithmetic on the plan gives sequence and
offset. No row moves to the driver and no group of pieces meets in one task.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rolefeed.llm.common import checkpointed, stored
from rolefeed.llm.encoder import encoder

CAPACITY = 1024


def natural_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded, with its end id, cut at every ``capacity`` tokens:
    ``doc_id, start, length, doc_tokens, ids_crc32, ids`` (binary, little-endian
    unsigned 32-bit), and ``task, k``: the piece's number among those of its
    length in the task that made it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        context = TaskContext.get()
        task, seen = context.partitionId() if context else 0, Counter()
        names = ("doc_id", "start", "length", "doc_tokens", "ids_crc32", "k", "ids")
        for batch in batches:
            rows, size = [], 0
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.many(batch.column("text"))):
                data = ids.tobytes() + end
                for at in range(0, len(data), 4 * capacity):
                    piece = data[at:at + 4 * capacity]
                    n = len(piece) // 4
                    rows.append((doc_id, at // 4, n, len(data) // 4, zlib.crc32(piece), seen[n], piece))
                    seen[n] += 1
                size += len(data)
                if size > 1 << 24:  # bounded batches, however long the texts
                    yield out(names, rows, task)
                    rows, size = [], 0
            if rows:
                yield out(names, rows, task)

    def out(names: tuple, rows: list, task: int) -> pa.RecordBatch:
        cols = dict(zip(names, zip(*rows)))
        return pa.record_batch(
            {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in cols.items()}
            | {"task": pa.array([task] * len(rows), pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, k long, ids binary, task long")


def best_fill(counts: dict[int, int], target: int) -> tuple[int, dict[int, int]]:
    """The largest sum up to ``target`` of a multiset with at most
    ``counts[length]`` of each length, and the counts of one such multiset."""
    full, sums, steps = (1 << (target + 1)) - 1, 1, []
    for length in sorted((x for x in counts if 0 < x <= target and counts[x]), reverse=True):
        left, bundle = min(counts[length], target // length), 1
        while left:
            many = min(bundle, left)
            steps.append((length, many, sums))
            sums |= (sums << (many * length)) & full
            left, bundle = left - many, bundle * 2
        if sums >> target & 1:
            break
    best = sums.bit_length() - 1
    used: dict[int, int] = {}
    at = best
    for length, many, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + many
            at -= many * length
    return best, used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Rows ``length, first, many, sequence, offset, tail``: pieces of
    ``length`` from rank ``first`` on stand ``many`` to a sequence from
    ``sequence`` on, the first of them at ``offset``. With ``tail`` 1 they
    stand in the stream that is cut, from position ``offset`` on."""
    left = {x: n for x, n in histogram.items() if n}
    rank = dict.fromkeys(left, 0)
    rows, sequence, tail = [], 0, {}
    if n := left.pop(capacity, 0):
        rows.append((capacity, 0, 1, 0, 0, 0))
        sequence = n
    while left:
        longest = max(left)
        left[longest] -= 1
        fill, used = best_fill(left, capacity - longest)
        left[longest] += 1
        if fill + longest < capacity:
            tail[longest] = left.pop(longest)
            continue
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // many for x, many in used.items())
        offset = 0
        for x in sorted(used, reverse=True):
            rows.append((x, rank[x], used[x], sequence, offset, 0))
            offset += x * used[x]
            rank[x] += times * used[x]
            left[x] -= times * used[x]
            if not left[x]:
                del left[x]
        sequence += times
    at = 0
    for x, n in tail.items():
        rows.append((x, rank[x], 1, sequence, at, 1))
        at += n * x
    return sorted(rows)


def tail_cuts(total: int, capacity: int) -> list[int]:
    """Ends of the sequences after the full ones at the stream's end: its last
    ``total % capacity`` tokens in powers of two, so that none needs padding."""
    at, rest, ends = total - total % capacity, total % capacity, []
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


class Packed(NamedTuple):
    placed: DataFrame  # a row per piece and where it stands
    pieces: DataFrame  # the encoded pieces, with their ids


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> Packed:
    """``placed`` has one row per piece: ``doc_id, start, length, doc_tokens,
    sequence_id, offset, ids_crc32`` (and what names it in ``pieces``). The
    pieces of a sequence follow each other without gaps from offset 0; every
    id of every document is in exactly one piece.

    A null or empty text is its end id alone. Repeated rows are packed as often
    as they are given, null ids stay null. An empty table gives an empty
    result. Other columns are not read."""
    pieces = stored(natural_pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "packing-pieces")
    counts = checkpointed(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, capacity)  # lengths of 1 to ``capacity`` only
    total = sum(histogram[x] * x - first * x for x, first, _, _, _, tail in rows if tail)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.drop("ids").join(bases, ["task", "length"]).withColumn("rank", F.col("base") + F.col("k"))

    table = np.array(rows, dtype=np.int64).reshape(-1, 6)
    wide = 1 << 48  # ranks stay below this
    starts, ends = table[:, 0] * wide + table[:, 1], np.array(tail_cuts(total, capacity), dtype=np.int64)
    whole = total - total % capacity

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, at = (batch.column(c).to_numpy() for c in ("length", "rank"))
            kind = table[np.searchsorted(starts, length * wide + at, side="right") - 1]
            nth, tail = at - kind[:, 1], kind[:, 5] == 1
            sequence, offset = kind[:, 3] + nth // kind[:, 2], kind[:, 4] + nth % kind[:, 2] * length
            first = np.where(tail, kind[:, 4] + nth * length, 0)  # in the stream
            row, skip, size = np.arange(len(length)), np.zeros_like(length), length.copy()
            out = [(row[~tail], skip[~tail], size[~tail], sequence[~tail], offset[~tail])]
            here, left, pos = row[tail], length[tail].copy(), first[tail].copy()
            begin = pos.copy()
            while len(here):  # a piece is at most ``capacity`` long: few cuts
                beyond = np.searchsorted(ends, pos, side="right")
                late = pos >= whole
                edge = np.where(late, ends[np.minimum(beyond, len(ends) - 1)] if len(ends) else 0, (pos // capacity + 1) * capacity)
                open_ = np.where(late, np.where(beyond > 0, ends[np.maximum(beyond - 1, 0)] if len(ends) else 0, whole), pos // capacity * capacity)
                take = np.minimum(left, edge - pos)
                number = np.where(late, whole // capacity + beyond, pos // capacity) + kind[here, 3]
                out.append((here, pos - begin, take, number, pos - open_))
                go = left > take
                here, pos, left, begin = here[go], (pos + take)[go], (left - take)[go], begin[go]
            row, skip, size, sequence, offset = (np.concatenate(x) for x in zip(*out))
            cut = batch.take(pa.array(row))
            yield pa.record_batch({
                **{c: cut.column(c) for c in ("task", "k", "doc_id", "doc_tokens", "ids_crc32")}, "natural": cut.column("length"),
                "skip": pa.array(skip), "length": pa.array(size), "sequence_id": pa.array(sequence), "offset": pa.array(offset),
                "start": pa.array(cut.column("start").to_numpy() + skip)})

    placed = stored(ranked.mapInArrow(
        place, "task long, k long, doc_id long, doc_tokens long, ids_crc32 long, natural long, skip long, length long, "
               "sequence_id long, offset long, start long"), "packing-placed")
    named = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    source = pieces.select("task", "k", F.col("length").alias("natural"), "ids")
    is_cut = F.col("length") < F.col("natural")
    # a table of its own: its size is known, so when it is small no ids are shuffled
    joined = stored(placed.where(is_cut), "packing-cut").join(source, ["task", "natural", "k"])
    cut = joined.withColumn("ids_crc32", F.expr("crc32(substring(ids, int(skip) * 4 + 1, int(length) * 4))"))
    named += ["ids_crc32", "task", "natural", "k", "skip"]
    return Packed(placed.where(~is_cut).select(named).unionByName(cut.select(named)), pieces)


def sequences(packed: Packed) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the ids of each sequence, its pieces by offset."""
    source = packed.pieces.select("task", "k", F.col("length").alias("natural"), F.col("ids").alias("all"))
    parts = packed.placed.join(source, ["task", "natural", "k"]).select(
        "sequence_id", "length", F.struct(
            "offset", F.expr("substring(all, int(skip) * 4 + 1, int(length) * 4)").alias("ids")).alias("part"))
    return parts.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(F.array_sort(F.collect_list("part")), F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
