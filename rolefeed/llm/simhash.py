"""SimHash near-duplicate detection by a binary trie self-join.

Fingerprints are the leaves of a binary trie. Pairs of trie nodes of equal
depth are traversed together; the differing bits so far are carried along and
a pair is left as soon as they exceed what its depth allows. Two tries are
walked, one with the halves of the fingerprint swapped: of ``max_bits``
differing bits, one half holds ``max_bits // 2`` at most, so in each trie the
first 32 levels need only that smaller budget, and every pair is reached in
one of the tries at least.

Spark deals the node pairs of one depth (cells) to tasks. A cell with more
fingerprints than a task should hold is taken apart four levels deeper, again
as a DataFrame step, and so on to the leaves. A task walks all its cells with
arrays and returns, instead of all links, a spanning forest of them: the
connected components stay the same and a group of n fingerprints costs n - 1
rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.common import checkpointed, components, fresh, stored

SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
TOP = 16  # depth of the first cells
STEP = 4  # levels by which a large cell is taken apart
CELL_ROWS = 20_000  # fingerprints that a cell may hold before that
BLOCK = 1 << 20  # node pairs walked at a time


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, as an unsigned integer.

    Words are runs of bytes other than white space (0x20, 0x09-0x0D), A-Z in
    lower case. Fewer words than ``shingle``: the whole sequence is the one
    shingle; no word (or null): zero. A bit is set when it is set in more than
    half of the shingles' XXH64, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):  # bounded memory for very long texts
        block = h[at:at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: one row per document; ``fp`` holds the 64 bits in a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, fp long")


def _budget(depth: int, max_bits: int) -> int:
    return max_bits // 2 if depth <= 32 else max_bits


def _masks(bits: int, most: int) -> list[int]:
    return [m for m in range(1 << bits) if bin(m).count("1") <= most]


def _children(rows: DataFrame, depth: int, step: int, max_bits: int) -> DataFrame:
    """The cells ``step`` levels below: each row goes to every pair of child
    nodes that it is in and whose differing bits the budget allows.

    ``p``, ``q``: the two nodes (p <= q, right-aligned prefixes); ``side``: 0
    if the fingerprint lies under p, 1 under q."""
    most = _budget(depth + step, max_bits)
    mask = F.array(*[F.lit(m).cast("long") for m in _masks(step, most)])
    own = F.shiftrightunsigned("fp", 64 - depth - step)
    child = F.col("own").bitwiseAND(F.lit((1 << step) - 1))
    out = (rows.withColumn("own", own).withColumn("m", F.explode(mask))
           .withColumn("other", F.when(F.col("side") == 0, F.col("q")).otherwise(F.col("p")))
           .withColumn("other", F.shiftleft("other", step).bitwiseOR(child.bitwiseXOR(F.col("m"))))
           .where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= most))
    same = F.col("p") == F.col("q")
    low = F.when(same, F.col("own") <= F.col("other")).otherwise(F.col("side") == 0)
    return out.select(
        "trie", "fp",
        F.when(low, F.col("own")).otherwise(F.col("other")).alias("p"),
        F.when(low, F.col("other")).otherwise(F.col("own")).alias("q"),
        F.when(low, 0).otherwise(1).alias("side"))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class _Forest:
    """Union of the pairs seen so far, with the smaller index as the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def _walk(fp: np.ndarray, cells: np.ndarray, depth: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of indices into ``fp`` (unsigned, sorted within each node) at
    ``max_bits`` differing bits or fewer. cells: rows a0, a1, b0, b1, the index
    ranges under the two nodes, equal for a node with itself. Blocks are taken
    from a stack, so memory stays bounded by BLOCK pairs a level."""
    stack = [(cells, depth)]
    while stack:
        pairs, d = stack.pop()
        if len(pairs) > BLOCK:
            stack += [(pairs[:BLOCK], d), (pairs[BLOCK:], d)]
            continue
        a0, a1, b0, b1 = pairs.T
        work = (a1 - a0) * (b1 - b0)
        small = (work <= 32) | (d >= 64)
        if small.any():
            order = np.flatnonzero(small)
            ends = np.cumsum(work[order])
            at = 0
            while at < len(order):  # all leaf pairs below these nodes, a block at a time
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
                k = order[at:to]
                w, width = work[k], (b1 - b0)[k]
                i = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                x = np.repeat(a0[k], w) + i // np.repeat(width, w)
                y = np.repeat(b0[k], w) + i % np.repeat(width, w)
                near = (_popcount(fp[x] ^ fp[y]) <= max_bits) & (x != y)
                yield x[near], y[near]
                at = to
        pairs = pairs[~small]
        if not len(pairs):
            continue
        a0, a1, b0, b1 = pairs.T
        am, bm = _middle(fp, a0, a1, d), _middle(fp, b0, b1, d)
        own = (a0 == b0) & (a1 == b1)
        below = np.concatenate([
            np.stack([a0, am, b0, bm], 1), np.stack([am, a1, bm, b1], 1), np.stack([a0, am, bm, b1], 1),
            np.stack([am, a1, b0, bm], 1)[~own]])
        below = below[(below[:, 1] > below[:, 0]) & (below[:, 3] > below[:, 2])]
        bits = _popcount((fp[below[:, 0]] ^ fp[below[:, 2]]) >> np.uint64(63 - d))
        stack.append((below[bits <= _budget(d + 1, max_bits)], d + 1))


def _middle(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int) -> np.ndarray:
    """First index of each range whose bit ``d`` (from the top) is set."""
    lo, hi, bit = lo.copy(), hi.copy(), np.uint64(1) << np.uint64(63 - d)
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        up = open_ & ((fp[np.minimum(mid, len(fp) - 1)] & bit) == 0)
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
    return lo


def _forest_of(pdf: pd.DataFrame, depth: int, max_bits: int) -> pd.DataFrame:
    """Spanning forest of the links in whole cells; rows sorted by cell, side, fp."""
    fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
    cell = pdf[["trie", "p", "q"]].to_numpy(np.int64)
    side = pdf["side"].to_numpy()
    new = np.ones(len(pdf), bool)
    new[1:] = (cell[1:] != cell[:-1]).any(axis=1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(pdf))
    ones = np.add.reduceat(side, begin)
    mid = end - ones
    own = cell[begin, 1] == cell[begin, 2]
    a0, a1 = begin, np.where(own, end, mid)
    b0, b1 = np.where(own, begin, mid), end
    cells = np.stack([a0, a1, b0, b1], 1)
    cells = cells[(cells[:, 1] > cells[:, 0]) & (cells[:, 3] > cells[:, 2])]
    kinds, index = np.unique(fp, return_inverse=True)
    forest = _Forest(len(kinds))
    for x, y in _walk(fp, cells, depth, max_bits):
        forest.add(index[x], index[y])
    linked = np.flatnonzero(forest.root != np.arange(len(kinds)))
    return pd.DataFrame({"a": kinds[linked].view(np.int64), "b": kinds[forest.root[linked]].view(np.int64)})


def _unrotated(a: str) -> F.Column:
    """Rows of the second trie hold the fingerprint with its halves swapped."""
    return F.when(F.col("trie") == 1, F.shiftleft(a, 32).bitwiseOR(F.shiftrightunsigned(a, 32))).otherwise(F.col(a))


def _join_cells(rows: DataFrame, depth: int, max_bits: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for pdf in batches:
            held.append(pdf)
            n += len(pdf)
            if n < 200_000:
                continue
            all_ = pd.concat(held, ignore_index=True)
            last = all_[["trie", "p", "q"]].iloc[-1]
            rest = ((all_["trie"] == last["trie"]) & (all_["p"] == last["p"]) & (all_["q"] == last["q"])).to_numpy()
            yield from by_trie(all_[~rest])
            held, n = [all_[rest]], int(rest.sum())
        if held:
            yield from by_trie(pd.concat(held, ignore_index=True))

    def by_trie(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for trie, part in pdf.groupby("trie"):
            yield _forest_of(part, depth, max_bits).assign(trie=int(trie))

    sorted_ = (rows.repartition("trie", "p", "q").sortWithinPartitions("trie", "p", "q", "side", F.expr("fp >= 0 desc"), "fp"))
    links = sorted_.select("trie", "p", "q", "side", "fp").mapInPandas(run, "trie int, a long, b long")
    return links.select(_unrotated("a").alias("a"), _unrotated("b").alias("b"))


def links(fps: DataFrame, max_bits: int = 3, cell_rows: int = CELL_ROWS) -> DataFrame:
    """A spanning forest of all links between the distinct values of ``fp``:
    ``a, b`` connect the same values as all pairs at ``max_bits`` differing
    bits or fewer do. The walk starts at depth 16 and a cell with more than
    ``cell_rows`` rows is split further, so no task holds a large group."""
    distinct = fps.select("fp").distinct()
    swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    tries = distinct.select(F.explode(F.array(
        F.struct(F.lit(0).alias("trie"), F.col("fp")), F.struct(F.lit(1).alias("trie"), swapped.alias("fp")))).alias("s")).select("s.*")
    zero = F.lit(0).cast("long")
    rows = _children(tries.select("trie", "fp", zero.alias("p"), zero.alias("q"), F.lit(0).alias("side")), 0, TOP, max_bits)
    depth, found = TOP, []
    while True:
        sizes = rows.groupBy("trie", "p", "q").agg(F.count("*").alias("n"), F.sum("side").alias("ones"))
        # a cell with fingerprints under one of its two nodes only holds no pair
        alive = sizes.where("p = q and n > 1 or p <> q and ones > 0 and ones < n")
        heavy = checkpointed(alive.where(F.col("n") > cell_rows).select("trie", "p", "q"))
        if depth >= 64 or not heavy.take(1):
            found.append(_join_cells(rows, depth, max_bits))
            break
        found.append(_join_cells(rows.join(heavy, ["trie", "p", "q"], "left_anti"), depth, max_bits))
        rows = stored(_children(rows.join(heavy, ["trie", "p", "q"], "left_semi"), depth, STEP, max_bits), "simhash-cells")
        depth += STEP
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 lower-case hex
    digits), ``component_id`` (smallest id reachable over links of at most
    ``max_bits`` differing bits) and ``n_links`` (documents of the component,
    less one).

    Texts with no word, empty and null ones have fingerprint zero and link like
    any other. Repeated rows are returned as often as they are given. A null id
    is kept and is never a ``component_id`` unless the component has no other.
    An empty table gives an empty result; other columns, whatever their names,
    are not read.
    """
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    comps = components(links(fps, max_bits, cell_rows), "a", "b")
    member = classes.join(comps, classes["fp"] == comps["node"], "left").select(
        "fp", "least", "n", F.coalesce("component", "fp").alias("component"))
    whole = member.groupBy("component").agg(F.min("least").alias("component_id"), F.sum("n").alias("size"))
    of_fp = checkpointed(member.join(whole, "component").select("fp", "component_id", "size"))
    return fps.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("size") - 1).alias("n_links"))


def one_of_each_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with the document of smallest id of each component only, all
    columns kept. Of repeated rows with that id one stays; rows with a null id
    stay, as nothing tells them apart from each other."""
    stay_col = fresh(docs, "_stay")
    groups = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    stay = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(stay_col)).distinct()
    kept = docs.join(stay, F.col(id_col) == F.col(stay_col), "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
