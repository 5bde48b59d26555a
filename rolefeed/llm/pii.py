"""Personal data: exact base spans and a semi-Markov conditional random field.

Base spans (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and
checks. The model adds spans that the patterns miss (phones without a country
code, ``iban``, ``ssn``): text around digits and @ signs is cut into tokens,
every run of at most ``MAX_TOKENS`` tokens is a candidate segment with features
of the whole span (shape, check digits, cue words before it), and a
bounded-entity dynamic program chooses boundaries and types together. Weights
are the maximum of the conditional likelihood of labelled snippets
(``pii_samples``). Detection is one pass over whole texts, without a shuffle.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.pii_samples import CUES, iban_ok, luhn, snippets

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
FIT_SNIPPETS, EPOCHS, WIDTH = 300, 12, 1 << 12
MAX_TOKENS, MAX_CHARS = 17, 48

#: The base patterns, each begun only where a match can begin.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
NEXT = re.compile(r"[^\s]+")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")
LETTERS = re.compile(r"[A-Z]{1,4} (?=[^\s]*[0-9@])")  # a group of a printed IBAN, before another one
LAST_WORDS = re.compile(r"[A-Za-z]+")
CUE_OF = {w: k for k, words in CUES.items() for w in words}
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, in time linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` by start, then kind as listed."""
    out = [(a, b, "email") for a, b in _emails(text)]
    if MARK.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((*m.span(), "card"))
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of space-separated words that hold a digit or an @ sign, or
    stand between two such words and are one to four capital letters."""
    done = 0
    m = MARK.search(text)
    while m:
        start = max(text.rfind(c, done, m.start()) for c in " \n\t\r") + 1
        start = max(start, done)
        word = NEXT.match(text, start) or m
        end = word.end()
        while end + 1 < len(text) and text[end] == " ":
            letters = LETTERS.match(text, end + 1)
            word = NEXT.match(text, letters.end() if letters else end + 1)
            if not word or not MARK.search(word[0]):
                break
            end = word.end()
        end = max(end, m.end())
        yield start, end
        done = end
        m = MARK.search(text, done)


def _slot(name: str) -> int:
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % WIDTH


def _shape(tokens: list[tuple[int, int, str]], i: int, j: int) -> str:
    out, last = [], tokens[i][0]
    for a, b, t in tokens[i:j]:
        if a > last:
            out.append("_")
        out.append(f"d{min(len(t), 8)}" if t[0].isdigit() else f"a{min(len(t), 3)}" if t.isalnum() else t)
        last = b
    return "".join(out)


def span_features(text: str, tokens: list[tuple[int, int, str]], i: int, j: int, cues: tuple[str, ...]) -> list[int]:
    a, b = tokens[i][0], tokens[j - 1][1]
    span = text[a:b]
    digits = _digits(span)
    letters = any(c.isalpha() for c in span)
    shape = _shape(tokens, i, j)
    names = ["bias", f"digits:{min(len(digits), 20)}", f"shape:{shape}" if j - i <= 9 else "shape:long", f"first:{tokens[i][2][0] if not tokens[i][2][0].isalnum() else 'x'}",
             f"letters:{letters}", *(f"cue:{c}" for c in cues)]
    if a and text[a - 1].isalnum() or b < len(text) and text[b].isalnum():
        names.append("inside")
    if a and text[a - 1] in ".-+@/:" or b + 1 < len(text) and text[b] in ".-@/:" and text[b + 1].isalnum():
        names.append("joined")
    if not letters and 12 <= len(digits) <= 19 and CARD.fullmatch(span):
        names.append(f"luhn:{luhn(digits)}")
    if PHONE.fullmatch(span):
        names.append("plus")
    if IP.fullmatch(span):
        names.append(f"ip:{all(len(p) < 4 and int(p) < 256 for p in span.split('.'))}")
    if "@" in span:
        names.append(f"email:{bool(EMAIL.fullmatch(span))}")
    flat = span.replace(" ", "")
    if letters and IBAN.fullmatch(flat):
        names.append(f"iban:{iban_ok(flat)}:{len(flat) <= 34}")
    return [_slot(n) for n in names]


def tokens_of(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    return [(*m.span(), m[0]) for m in TOKEN.finditer(text, start, end)]


def cues_before(text: str, start: int) -> tuple[str, ...]:
    words = LAST_WORDS.findall(text[max(0, start - 24):start])[-2:]
    return tuple(CUE_OF[w.lower()] for w in words if w.lower() in CUE_OF) or ("none",)


def candidates(text: str, tokens: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, list[int]]]:
    """Segments that may be an entity: bounded, with a digit, whole at both ends."""
    for i, (a, _, first) in enumerate(tokens):
        if not (first[0].isalnum() or first in "+("):
            continue
        cues, held = cues_before(text, a), False
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            _, b, last = tokens[j - 1]
            if b - a > MAX_CHARS:
                break
            held = held or last[0].isdigit() or last == "@"
            if held and last.isalnum() and b - a >= 6:
                yield i, j, span_features(text, tokens, i, j, cues)


class Model:
    """``weights``: kinds x features; ``step``: from and to a label, 0 for text outside entities."""

    def __init__(self, weights: np.ndarray, step: np.ndarray):
        self.weights, self.step = weights, step

    def decode(self, text: str, start: int, end: int) -> list[tuple[int, int, str]]:
        """The best segmentation of a region."""
        tokens = tokens_of(text, start, end)
        n, k = len(tokens), len(KINDS) + 1
        ending: dict[int, list] = {}
        for i, j, at in candidates(text, tokens):
            score = self.weights[:, at].sum(axis=1)
            if score.max() > -4:
                ending.setdefault(j, []).append((i, score))
        if not ending:
            return []
        best = np.full((n + 1, k), -np.inf)
        best[0, 0] = 0
        back: list[list] = [[None] * k for _ in range(n + 1)]
        for j in range(1, n + 1):
            outside = best[j - 1] + self.step[:, 0]
            p = int(outside.argmax())
            best[j, 0], back[j][0] = outside[p], (j - 1, p)
            for i, score in ending.get(j, ()):
                go = best[i][:, None] + self.step[:, 1:]
                p = go.argmax(axis=0)
                total = go[p, np.arange(k - 1)] + score
                for y in np.flatnonzero(total > best[j, 1:]).tolist():
                    best[j, y + 1], back[j][y + 1] = total[y], (i, int(p[y]))
        out, j, y = [], n, int(best[n].argmax())
        while j:
            i, p = back[j][y]
            if y:
                out.append((tokens[i][0], tokens[j - 1][1], KINDS[y - 1]))
            j, y = i, p
        return out[::-1]


def _logsum(x: np.ndarray) -> float:
    top = x.max()
    return top if top == -np.inf else top + np.log(np.exp(x - top).sum())


@lru_cache(maxsize=2)
def trained(samples: int = FIT_SNIPPETS, epochs: int = EPOCHS, penalty: float = 1e-4) -> Model:
    """Maximum likelihood by stochastic gradient steps (Adagrad) over labelled snippets."""
    data = []
    for parts in snippets(samples):
        text, gold = "", {}
        for kind, part in parts:
            if kind:
                gold[len(text), len(text) + len(part)] = KINDS.index(kind) + 1
            text += part
        for start, end in regions(text):
            tokens = tokens_of(text, start, end)
            spans = list(candidates(text, tokens))
            truth = {(i, j): gold[tokens[i][0], tokens[j - 1][1]] for i, j, _ in spans if (tokens[i][0], tokens[j - 1][1]) in gold}
            if spans:
                data.append((len(tokens), spans, truth))
    k = len(KINDS) + 1
    weights, step = np.zeros((k - 1, WIDTH)), np.zeros((k, k))
    weights[:, _slot("bias")] = -2
    g_weights, g_step = np.full_like(weights, 1e-2), np.full_like(step, 1e-2)
    for _ in range(epochs):
        for n, spans, truth in data:
            scores = [weights[:, at].sum(axis=1) for _, _, at in spans]
            into: list[list] = [[] for _ in range(n + 1)]
            out_of: list[list] = [[] for _ in range(n + 1)]
            for (i, j, _), s in zip(spans, scores):
                into[j].append((i, s))
                out_of[i].append((j, s))
            alpha, beta = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
            alpha[0, 0] = 0
            for j in range(1, n + 1):
                alpha[j, 0] = _logsum(alpha[j - 1] + step[:, 0])
                if into[j]:
                    go = np.stack([np.logaddexp.reduce(alpha[i][:, None] + step[:, 1:], axis=0) + s for i, s in into[j]])
                    alpha[j, 1:] = np.logaddexp.reduce(go, axis=0)
            beta[n] = 0
            for i in range(n - 1, -1, -1):
                go = [step[:, 0] + beta[i + 1, 0]]
                go += [np.logaddexp.reduce(step[:, 1:] + s + beta[j, 1:], axis=1) for j, s in out_of[i]]
                beta[i] = np.logaddexp.reduce(np.stack(go), axis=0)
            z = beta[0, 0]
            d_step = np.zeros_like(step)
            for j in range(1, n + 1):
                d_step[:, 0] -= np.exp(alpha[j - 1] + step[:, 0] + beta[j, 0] - z)
            for (i, j, at), s in zip(spans, scores):
                p = np.exp(alpha[i][:, None] + step[:, 1:] + s + beta[j, 1:] - z)
                d_step[:, 1:] -= p
                d = -p.sum(axis=0)
                if (y := truth.get((i, j))):
                    d[y - 1] += 1
                for f in at:
                    g_weights[:, f] += d * d
                    weights[:, f] += 0.3 * (d - penalty * weights[:, f]) / np.sqrt(g_weights[:, f])
            at, last = 0, 0
            ends = {i: (j, y) for (i, j), y in truth.items()}
            while at < n:
                to, y = ends.get(at, (at + 1, 0))
                d_step[last, y] += 1
                at, last = to, y
            g_step += d_step ** 2
            step += 0.3 * (d_step - penalty * step) / np.sqrt(g_step)
    return Model(weights, step)


def all_spans(text: str | None, model: Model) -> tuple[list, list]:
    """Base spans, and all spans: the model adds those that overlap no base span."""
    text = text or ""
    base = base_spans(text)
    more = []
    for start, end in regions(text):
        for a, b, kind in model.decode(text, start, end):
            if all(b <= x or a >= y for x, y, _ in base):
                more.append((a, b, kind))
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _named(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find(docs: DataFrame, fit_snippets: int = FIT_SNIPPETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the numbers of base spans
    ``n_email, n_ip, n_card, n_phone``, ``base`` and ``spans``: the base spans
    and all spans as ``kind:start:end`` (code points, end exclusive) by start,
    then kind, comma-joined.

    A null text is an empty one, without spans. Spans of different kinds may
    overlap among the base ones. Repeated rows give repeated answers; an empty
    table gives none; other columns are not read."""
    model = trained(fit_snippets)
    parts = (model.weights, model.step)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*parts)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                base, spans = all_spans(text, own)
                kinds = [s[2] for s in base]
                rows.append((doc, *map(kinds.count, BASE), _named(base), _named(spans)))
            yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in BASE), "base", "spans"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
