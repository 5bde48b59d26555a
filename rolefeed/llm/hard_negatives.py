"""Hard-negative mining by threshold joins with an inverted index over dimensions.

Vectors are made integers, so every score is exact. Rows of equal label and
vector are one class that keeps its smallest ids, as many as a result may hold;
anchors of one class are one query. Classes are dealt to blocks, and every
block answers the queries, which stream past it: no block of rows and no list
of queries is ever in one place as a whole.

In a block the dimensions are ordered by their energy, in groups. A row is put
into the lists of the inverted index only as far as the norm of its remaining
dimensions could still reach the lowest threshold of any query; what that
suffix norm covers is left out. Scores are accumulated list by list, pairs go
as soon as their partial score and the product of the remaining norms stay
below the query's threshold, and those left are verified with all dimensions.

A query asks for the best rows of some windows of scores (all scores of its own
label for positives, a share of each positive's score for negatives). Its
thresholds begin where the moments of the whole table let a few more rows be
expected than a window takes; windows that do not fill get lower thresholds, in
rounds, until they are full or their lower end is reached. The guess decides
the cost only, never the result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefeed.llm.common import checkpointed, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10  # of an anchor, of an anchor and positive
SHARE = (30, 90)  # percent of the positive's score that a negative's may be
EVERY = 100  # anchors: ids divisible by it
BLOCK_ROWS = 1 << 18  # classes of a block, at most about
CELLS = 1 << 22  # scores accumulated at a time
GROUP = 16  # dimensions whose lists are read between two prunings
FEW = 0.02  # share of pairs left from which on they are verified one by one
VERIFY = 1 << 16  # pairs verified at a time
SPARE, FASTER = 4, 8  # rows expected for each that a window takes, and the factor from round to round
LEAST = -(1 << 62)


def integers(rows: DataFrame, scale: float, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``vec_id, label, vec`` (array of int): the rows that take part, one an id."""
    made = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("raw"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    made = made.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull()
                      & F.forall("raw", lambda x: F.coalesce(fine(x.cast("double")), F.lit(False))))
    made = made.withColumn("big", F.transform("raw", lambda x: F.floor(x.cast("double") * F.lit(float(scale)))))
    norm = F.aggregate("big", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    made = made.where(norm < float(1 << 62)).select("vec_id", F.struct("label", F.col("big").cast("array<int>").alias("vec")).alias("row"))
    return made.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.vec")


def _moments(classes: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector and second moments of all rows, from partial sums of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims * (dims + 1) + 1)
        for batch in batches:
            x = _matrix(batch.column("vec"), dims).astype(np.float64)
            w = batch.column("rows").to_numpy().astype(np.float64)
            total += np.concatenate(([w.sum()], w @ x, (x.T @ (x * w[:, None])).ravel()))
        yield pa.record_batch({"at": pa.array(np.arange(len(total))), "value": pa.array(total)})

    sums = classes.select("vec", "rows").mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.array([r["value"] for r in sums.orderBy("at").collect()])  # dims * (dims + 1) + 1 values, whatever the rows
    return flat[1:dims + 1] / flat[0], flat[dims + 1:].reshape(dims, dims) / flat[0]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class _Block:
    """Rows of one block, their dimensions by falling energy, and the index:
    ``lists[g]`` first rows are those in the lists of the dimensions of group g."""

    def __init__(self, vec: np.ndarray, label: np.ndarray, ids: list[np.ndarray], ratio: float, dtype: type):
        wide = vec.astype(np.float64)
        self.order = np.argsort(-(wide ** 2).sum(axis=0), kind="stable")
        wide = wide[:, self.order]
        self.groups = range(0, vec.shape[1], GROUP)
        suffix = _suffix_norms(wide)
        indexed = (suffix[:-1] >= ratio * (1 - 1e-9)).sum(axis=0)
        by = np.argsort(-indexed, kind="stable")
        self.x, self.suffix = vec[:, self.order][by].astype(dtype), suffix[:, by]
        self.label, self.ids = label[by], [ids[i] for i in by.tolist()]
        self.first = np.array([x[0] for x in self.ids], dtype=np.int64)
        self.lists = [int((indexed > g).sum()) for g in range(len(self.groups))]
        self.top = float(suffix[0].max(initial=0))

    def search(self, q: np.ndarray, label: np.ndarray, least: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of all pairs at ``least`` (per query) or more."""
        q = q[:, self.order]
        norms = _suffix_norms(q.astype(np.float64))
        q = q.astype(self.x.dtype)
        floor = (least - 2 - 1e-6 * norms[0] * self.top)[:, None]  # room for rounded norms
        acc = np.zeros((len(q), self.lists[0]), self.x.dtype)
        stop = len(self.groups)
        for g, at in enumerate(self.groups):
            n = self.lists[g]
            acc[:, :n] += q[:, at:at + GROUP] @ self.x[:n, at:at + GROUP].T
            if g + 1 < len(self.groups):
                left = np.count_nonzero(self._alive(acc, norms, floor, g + 1, 0, n))
                if left < FEW * acc.size:
                    stop = g + 1
                    break
        found = []
        for g in range(1, stop + 1):  # rows whose lists were read up to group g
            lo, hi = self.lists[g] if g < stop else 0, self.lists[g - 1]
            if lo == hi:
                continue
            alive = self._alive(acc, norms, floor, g, lo, hi)
            alive &= (label[:, None] == self.label[lo:hi]) == same
            qi, xi = np.nonzero(alive)
            xi += lo
            score = acc[qi, xi] if g == len(self.groups) else self._verified(q, qi, xi)
            score = score.astype(np.int64)
            fine = score >= least[qi]
            found.append((qi[fine], xi[fine], score[fine]))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int),) * 3

    def _alive(self, acc: np.ndarray, norms: np.ndarray, floor: np.ndarray, g: int, lo: int, hi: int) -> np.ndarray:
        kind = np.float32 if acc.dtype == np.float32 else np.float64
        rest = np.outer(norms[g], self.suffix[g, lo:hi]).astype(kind)
        rest += acc[:, lo:hi]
        return rest >= floor

    def _verified(self, q: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
        parts = [np.einsum("ij,ij->i", q[qi[at:at + VERIFY]], self.x[xi[at:at + VERIFY]]) for at in range(0, len(qi), VERIFY)]
        return np.concatenate(parts) if parts else np.zeros(0, q.dtype)


def _suffix_norms(x: np.ndarray) -> np.ndarray:
    """Norms of the dimensions from each group on, and zero at the end."""
    squares = np.add.reduceat(x ** 2, np.arange(0, x.shape[1], GROUP), axis=1)
    ends = np.zeros((squares.shape[1] + 1, len(x)))
    ends[:-1] = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1].T
    return np.sqrt(ends)


def _best(block: _Block, xi: np.ndarray, score: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the first ``take`` rows of classes in order."""
    ids = [block.ids[i] for i in xi[:take].tolist()]
    flat, scores = np.concatenate(ids), np.repeat(score[:take], [len(i) for i in ids])
    by = np.lexsort((flat, -scores))[:take]
    return scores[by], flat[by]


FOUND = "qid long, window long, score long, vec_id long"


def _threshold_join(classes: DataFrame, asked: DataFrame, blocks: int, dims: int, ratio: float, dtype: type,
                    take: int, same: bool) -> DataFrame:
    """The best ``take`` rows of each block in each window of each query of
    ``asked`` (``qid, label, vec, windows``: structs of window, t, top)."""

    def answers(block: _Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q, label = _matrix(batch.column("vec"), dims), batch.column("label").to_numpy()
        windows = batch.column("windows").to_pylist()
        qid = [ids[0] for ids in batch.column("ids").to_pylist()]
        least = np.array([min(w["t"] for w in ws) for ws in windows], dtype=np.int64)
        size = max(1, CELLS // max(1, block.lists[0]))
        for at in range(0, len(q), size):
            part = slice(at, at + size)
            qi, xi, score = block.search(q[part], label[part], least[part], same)
            by = np.lexsort((block.first[xi], -score, qi))
            qi, xi, score = qi[by], xi[by], score[by]
            ends = np.searchsorted(qi, np.arange(size + 1))
            out = []
            for i, ws in enumerate(windows[part]):
                s, x = score[ends[i]:ends[i + 1]], xi[ends[i]:ends[i + 1]]
                for w in ws:
                    lo, hi = np.searchsorted(-s, (-w["top"], -w["t"] + 1))
                    if lo < hi:
                        scores, ids = _best(block, x[lo:hi], s[lo:hi], take)
                        out.append((np.full(len(ids), qid[at + i]), np.full(len(ids), w["window"]), scores, ids))
            if out:
                yield pa.record_batch(dict(zip(("qid", "window", "score", "vec_id"), (pa.array(np.concatenate(c)) for c in zip(*out)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        number, block = None, None
        for batch in batches:
            numbers, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            new = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(batch)]):
                part = batch.slice(lo, hi - lo)
                if numbers[lo] != number:
                    number, held, block = numbers[lo], [], None
                if kinds[lo] == 0:
                    held.append(part)
                elif held:
                    rows = pa.Table.from_batches(held)
                    ids = rows.column("ids").combine_chunks()
                    lists = np.split(ids.flatten().to_numpy(), ids.offsets.to_numpy()[1:-1] - ids.offsets[0].as_py())
                    block = _Block(_matrix(rows.column("vec").combine_chunks(), dims), rows.column("label").to_numpy(), lists, ratio, dtype)
                    held = []
                    yield from answers(block, part)
                elif block is not None:
                    yield from answers(block, part)

    windows = "array<struct<window:long,t:long,top:long>>"
    rows = classes.select("block", F.lit(0).alias("kind"), "label", "vec", "ids", F.lit(None).cast(windows).alias("windows"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    queries = asked.select(every, F.lit(1).alias("kind"), "label", "vec", F.array("qid").alias("ids"), "windows")
    dealt = rows.unionByName(queries).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(run, FOUND)


def _thresholds(round_: int, take: int) -> Column:
    """Where SPARE * FASTER ** round times ``take`` rows are expected below the
    top of a window, if scores were normal; LEAST or the window's end beyond."""
    normal = NormalDist()

    @F.pandas_udf("long")
    def guess(mean: pd.Series, sd: pd.Series, pool: pd.Series, lo: pd.Series, end: pd.Series) -> pd.Series:
        out = []
        for m, s, n, low, top in zip(mean, sd, pool, lo, end):
            more = SPARE * FASTER ** round_ * take / n if n > 0 else 1.0
            p = more + (1 - normal.cdf((top - m) / s) if s > 0 else 1.0)
            out.append(low if p >= 1 else max(low, min(top, math.floor(m + s * normal.inv_cdf(max(1 - p, 1e-300))))))
        return pd.Series(out, dtype="int64")

    return guess("mean", "sd", "pool", "lo", "end")


def _filled(classes: DataFrame, queries: DataFrame, windows: DataFrame, blocks: int, dims: int, dtype: type,
            take: int, same: bool) -> DataFrame:
    """The best ``take`` rows (``qid, window, score, vec_id, rank``) of every
    window ``qid, window, lo, end`` (both ends included)."""
    pool = F.col("of_label") if same else F.col("of_all") - F.col("of_label")
    of = queries.select("qid", "mean", "sd", "norm", pool.alias("pool"))
    open_ = windows.select("qid", "window", "lo", "end", F.col("end").alias("top"), F.lit(0).cast("long").alias("have"))
    found, round_ = [], 0
    while True:
        state = open_.join(of, "qid").withColumn("t", F.least("top", _thresholds(round_, take)))
        state = checkpointed(state.select("qid", "window", "lo", "end", "top", "have", "t", "norm"))
        low = state.agg(F.min(F.col("t") / F.col("norm"))).first()[0]
        if low is None:
            break
        asked = state.groupBy("qid").agg(F.collect_list(F.struct("window", "t", "top")).alias("windows")).join(
            queries.select("qid", "label", "vec"), "qid")
        part = stored(_threshold_join(classes, asked, blocks, dims, low, dtype, take, same), "window-rows")
        found.append(part)
        got = part.groupBy("qid", "window").agg(F.count("*").alias("n"))
        open_ = (state.join(got, ["qid", "window"], "left").withColumn("have", F.col("have") + F.coalesce("n", F.lit(0)))
                 .where((F.col("have") < take) & (F.col("t") > F.col("lo")))
                 .select("qid", "window", "lo", "end", (F.col("t") - 1).alias("top"), "have"))
        round_ += 1
    if not found:
        return windows.sparkSession.createDataFrame([], FOUND + ", rank int")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("qid", "window").orderBy(F.desc("score"), "vec_id"))
    return stored(rows.withColumn("rank", rank).where(F.col("rank") <= take), "window-best")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = SHARE,
         every: int = EVERY, scale: float = SCALE, block_rows: int = BLOCK_ROWS, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (id divisible by ``every``) its first
    ``positives`` other rows of the same label, and for each of these the first
    ``negatives`` rows of other labels whose score is ``share`` percent of the
    positive's, both ends included. Scores are inner products of
    floor(scale * x); higher ones come first, ties by smaller id.

    Rows without an id, label or vector, with a null or non-finite component, or
    whose integer vector has a squared norm of 2^62 or more (no long might hold
    its scores) take no part. Rows that share an id are one row, that of least
    label and integer vector. Missing components of shorter vectors are zero. Positives with a negative
    score have no negatives. An empty table gives an empty result; other columns
    are not read."""
    spark = rows.sparkSession
    rows = stored(integers(rows, scale, id_col, label_col, vector_col), "integer-vectors")
    keep = max(positives + 1, negatives)
    norm = F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dims"), F.max(norm).alias("peak")).first()
    if not facts["n"]:
        return spark.createDataFrame([], RESULT)
    dims = max(1, facts["dims"])
    dtype = np.float32 if facts["peak"] < 1 << 24 else np.float64 if facts["peak"] < 1 << 53 else np.int64
    blocks = max(-(-facts["n"] // block_rows), 2 * spark.sparkContext.defaultParallelism)

    full = F.when(F.size("vec") == dims, F.col("vec")).otherwise(
        F.concat("vec", F.array_repeat(F.lit(0), F.lit(dims) - F.size("vec"))))
    rows = rows.withColumn("vec", full)
    same = Window.partitionBy("label", "vec")
    first = rows.withColumn("k", F.row_number().over(same.orderBy("vec_id"))).where(F.col("k") <= keep)
    sizes = rows.groupBy("label", "vec").agg(F.count("*").alias("rows"))
    block = F.pmod(F.xxhash64("label", "vec"), F.lit(blocks).cast("long"))
    classes = first.groupBy("label", "vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes.join(sizes, ["label", "vec"]).withColumn("block", block), "vector-classes")
    mean, second = _moments(classes, dims)

    @F.pandas_udf("mean double, sd double")
    def moments(vec: pd.Series) -> pd.DataFrame:
        q = np.stack(vec.to_list()).astype(np.float64)
        m = q @ mean
        return pd.DataFrame({"mean": m, "sd": np.sqrt(np.maximum(((q @ second) * q).sum(axis=1) - m ** 2, 0))})

    of_label = classes.groupBy("label").agg(F.sum("rows").alias("of_label"))
    anchors = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = anchors.select("label", "vec").distinct().join(of_label, "label").select(
        F.monotonically_increasing_id().alias("qid"), "label", "vec", "of_label", F.lit(facts["n"]).cast("long").alias("of_all"),
        F.greatest(F.sqrt(norm.cast("double")), F.lit(1e-9)).alias("norm"), moments("vec").alias("m"))
    queries = stored(queries.select("*", "m.*").drop("m"), "anchor-vectors")

    whole = queries.select("qid", F.lit(0).cast("long").alias("window"), F.lit(LEAST).cast("long").alias("lo"), F.lit(-LEAST).cast("long").alias("end"))
    # one more, as the anchor itself is left out below
    best = _filled(classes, queries, whole, blocks, dims, dtype, positives + 1, True).select(
        "qid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = share
    score = F.col("positive_score")
    windows = best.where(score >= 0).select(
        "qid", score.alias("window"), F.expr(f"({low} * cast(positive_score as decimal(20)) + 99) div 100").alias("lo"),
        F.expr(f"{high} * cast(positive_score as decimal(20)) div 100").alias("end")).distinct().where("lo <= end")
    worse = _filled(classes, queries, windows, blocks, dims, dtype, negatives, False).select(
        "qid", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))

    own = anchors.select(F.col("vec_id").alias("anchor_id"), "label", "vec").join(
        queries.select("qid", "label", "vec"), ["label", "vec"]).select("anchor_id", "qid")
    order = Window.partitionBy("anchor_id", "qid").orderBy(F.desc("positive_score"), "positive_id")
    pairs = own.join(best, "qid").where("positive_id <> anchor_id").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    return pairs.join(worse, ["qid", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
