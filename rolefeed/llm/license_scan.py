"""Licence scan: winnowed fingerprints and banded sequence alignment.

The templates' word ``K``-grams are winnowed (the smallest hash of every
``W`` neighbours is kept) into an inverted index: fingerprint -> template and
position. Texts are winnowed alike, so any run of ``K + W - 1`` words that a
text shares with a template has a fingerprint in the index. Hits on close
diagonals are one candidate, and a banded alignment of the template with that
place of the text reports the matched words, their coverage and the span.

The index holds the templates of a list in the code (a few thousand entries),
never anything of the corpus; texts are scanned where they are, without a
shuffle.
"""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.license_texts import TEMPLATES

K, W, COVERAGE = 3, 3, 0.8
WORD = re.compile(r"[a-z0-9]+", re.ASCII)


def _lower(text: str) -> str:
    """A-Z in lower case only, so that every character keeps its place."""
    return text.translate(_TO_LOWER)


_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def _grams(ids: np.ndarray) -> np.ndarray:
    h = np.zeros(max(0, len(ids) - K + 1), np.uint64)
    for j in range(K):
        h = (h ^ ids[j:j + len(h)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _winnow(h: np.ndarray) -> np.ndarray:
    """Positions of the smallest hash (the last of equal ones) of every W neighbours."""
    if len(h) <= W:
        return np.array([len(h) - 1 - int(h[::-1].argmin())] if len(h) else [], np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(h[::-1], W)
    at = len(h) - 1 - (np.arange(len(windows)) + windows.argmin(axis=1))
    return np.unique(at)


class Index:
    def __init__(self, templates: Sequence[tuple[str, str, str]] = TEMPLATES):
        self.templates = templates
        self.ids: dict[str, int] = {}  # words of the templates, from 1; any other word is 0
        self.words = []
        for _, _, text in templates:
            self.words.append(np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in WORD.findall(_lower(text))], np.int64))
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.words):
            h = _grams(words)
            # a template shorter than the winnowing guarantee keeps all its grams
            for at in (_winnow(h) if len(words) >= 2 * (K + W - 1) else range(len(h))):
                self.places[int(h[at])].append((t, int(at)))
        self.hashes = np.array(sorted(self.places), np.uint64)

    def scan(self, text: str | None, coverage: float = COVERAGE) -> list[tuple]:
        """Matches of one text: template, matched words, coverage, first and
        last character (end exclusive, code points), by place. Of matches that
        overlap the one of more matched words is kept, then the earlier one."""
        low = _lower(text or "")
        found = WORD.findall(low)
        if len(found) < K:
            return []
        get = self.ids.get
        ids = np.array([get(w, 0) for w in found], np.int64)
        known = ids > 0
        full = known[:len(ids) - 2] & known[1:-1] & known[2:]
        if not full.any():
            return []
        h = _grams(ids)
        at = np.flatnonzero(full)
        at = at[np.isin(h[at], self.hashes)]
        if not len(at):
            return []
        chosen = set(_winnow(h).tolist())
        diagonals: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i in at.tolist():
            for t, j in self.places[int(h[i])]:
                if i in chosen or len(self.words[t]) < 2 * (K + W - 1):
                    diagonals[t].append((i - j, i))
        matches = []
        for t, hits in diagonals.items():
            n = len(self.words[t])
            band = max(2, n // 5)
            for lo, hi in sorted(_bands([d for d, _ in sorted(set(hits))], band, 2 * n)):
                matched, a, b = align(ids, self.words[t], lo - band, hi + band)
                if matched >= coverage * n:
                    matches.append((matched, a, b, t))
        if not matches:
            return []
        spans = [m.span() for m in WORD.finditer(low)]
        kept: list[tuple] = []
        for matched, a, b, t in sorted(matches, key=lambda m: (-m[0], m[1], m[3])):
            if all(b < x[2] or a > x[3] for x in kept):
                kept.append((t, matched, a, b))
        kept = sorted(kept, key=lambda x: x[2])
        return [(t, matched, matched / len(self.words[t]), spans[a][0], spans[b][1]) for t, matched, a, b in kept]


def _bands(diagonals: list[int], band: int, most: int) -> set[tuple[int, int]]:
    """Ranges of diagonals to align in. Those that follow each other within
    ``band`` are one copy with words put in or left out, if they span at most
    ``most``; cut into ranges of ``band``, they are several copies in a row. So
    no copy hides another, and no range grows with the text."""
    out, chain, piece = set(), [], []
    for d in [*diagonals, None]:
        if d is None or chain and d - chain[1] > band:
            if chain and chain[1] - chain[0] <= most:
                out.add(tuple(chain))
            chain = []
        if d is None or not chain or d - piece[0] > band:
            if piece:
                out.add(tuple(piece))
            piece = [d, d]
        if d is not None:
            chain = [chain[0], d] if chain else [d, d]
            piece[1] = d
    return out


def align(text: np.ndarray, template: np.ndarray, lo: int, hi: int) -> tuple[int, int, int]:
    """Longest common subsequence of the template with the text, within the band
    of diagonals ``lo`` to ``hi`` (text position less template position):
    matched words, first and last matched word of the text. Of equal ones that
    of the shortest span."""
    width = hi - lo + 1
    # score = matched words; start = where the alignment's first match stands
    score, start, end = np.zeros(width + 1, np.int64), np.full(width + 1, -1), np.full(width + 1, -1)
    for j, word in enumerate(template.tolist()):
        new, s, e = score.copy(), start.copy(), end.copy()
        for k in range(width):
            i = lo + k + j
            # from (i, j-1): one diagonal further right before; from (i-1, j): the diagonal to the left
            best = (score[k + 1], start[k + 1], end[k + 1]) if k + 1 <= width else (0, -1, -1)
            if k and (new[k - 1], s[k - 1]) > (best[0], best[1]):
                best = (new[k - 1], s[k - 1], e[k - 1])
            if 0 <= i < len(text) and text[i] == word:
                hit = (score[k] + 1, start[k] if score[k] else i, i)
                if (hit[0], hit[1]) >= (best[0], best[1]):
                    best = hit
            new[k], s[k], e[k] = best
        score, start, end = new, s, e
    at = int(score[:width].argmax())
    return int(score[at]), int(start[at]), int(end[at])


def scan(docs: DataFrame, coverage: float = COVERAGE, templates: Sequence[tuple[str, str, str]] = TEMPLATES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence text found: ``doc_id, license`` (SPDX identifier),
    ``template, matched`` (words), ``coverage`` (of the template's words),
    ``start, end`` (code points of the whole text, end exclusive).

    Null, empty and short texts give none. Repeated rows are scanned as often
    as they are given, null ids stay null; other columns are not read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(templates)
        for pdf in batches:
            rows = [(doc, *templates[t][:2], matched, cov, a, b)
                    for doc, text in zip(pdf["doc_id"], pdf["text"]) for t, matched, cov, a, b in index.scan(text, coverage)]
            if rows:
                out = pd.DataFrame(rows, columns=["doc_id", "license", "template", "matched", "coverage", "start", "end"])
                yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, license string, template string, matched long, coverage double, start long, end long")
