"""Main-text extraction: a linear-chain conditional random field over the leaf
blocks of a page.

A page is read into its leaf blocks, the runs of text between the tags of
block elements, each with the tags, classes and ids above it. Every block gets
features of its ancestors and of its text; the chain's two labels are main
text and anything else. The weights are the maximum of the conditional
likelihood of labelled pages (``html_pages``), found with the forward-backward
recursion; pages are decoded by Viterbi. Extraction is one pass over whole
pages, without a shuffle.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.html_pages import labelled_pages

FIT_PAGES, ROUNDS, WIDTH = 600, 80, 1 << 13

#: Elements that begin a block, that hold no text of the page, and that never close.
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noframes ol option p pre section summary table tbody
td tfoot th thead tr ul
""".split())
SILENT = frozenset("script style template noscript textarea select button svg math iframe object head title canvas audio video".split())
RAW = frozenset("script style textarea title iframe noscript".split())  # their content has no tags
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "html"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>|<[!?/][^>]*+>""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
LETTER_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("text", "tags", "names", "links")

    def __init__(self, text: str, tags: tuple[str, ...], names: tuple[str, ...], links: int):
        self.text, self.tags, self.names, self.links = text, tags, names, links


def blocks(html: str | None) -> list[Block]:
    """Leaf blocks in page order, character references decoded, white space
    collapsed. Comments, scripts and other silent elements are no text; tags
    that are missing or not closed end where the next block makes them end, a
    head where text or a tag begins that cannot stand in one."""
    html = html or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked, silent, paragraphs, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", unescape("".join(held))).strip()
        if text:
            out.append(Block(text, tuple(t for t, _ in stack if t in BLOCKS), tuple(n for _, ns in stack for n in ns), linked))
        held.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal silent, paragraphs
        while len(stack) > to:
            tag = stack.pop()[0]
            silent -= tag in SILENT
            paragraphs -= tag == "p"

    def text_at(piece: str) -> None:
        nonlocal linked
        if stack and stack[-1][0] == "head" and piece.strip():
            close(len(stack) - 1)
        if piece and not silent:
            held.append(piece)
            if any(t == "a" for t, _ in stack[-4:]):
                linked += len(piece)

    while at < len(html):
        m = TAG.search(html, at)
        if m is None:
            text_at(html[at:])
            break
        text_at(html[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name in BLOCKS:
                flush()
            if depth is not None and (name in BLOCKS or not any(t in BLOCKS for t, _ in stack[depth + 1:])):
                close(depth)
            elif name in ("br", "p"):
                text_at(" ")
            continue
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        if name in VOID:
            if name == "hr":
                flush()
            text_at(" ")
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P and paragraphs:  # a paragraph ends, and what is open inside it
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"))
            if name in SAME:
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in SAME[name] or stack[i][0] in ("ul", "ol", "table", "dl")), None)
                if depth is not None and stack[depth][0] in SAME[name]:
                    close(depth)
        names = ()
        if m[3]:
            names = tuple(w for _, a, b, c in ATTRIBUTE.findall(m[3]) for w in PARTS.findall(LETTER_CASE.sub(" ", a or b or c).lower()))
        if m[3].endswith("/") and name not in BLOCKS:
            continue
        stack.append((name, names))
        silent += name in SILENT
        paragraphs += name == "p"
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            if end is None:
                at = len(html) if name in ("script", "style") else at
            else:
                at = end.end()
                close(len(stack) - 1)
    flush()
    return out


def _size(n: int) -> int:
    return min(7, n.bit_length())


def features(block: Block) -> list[str]:
    text, tags = block.text, block.tags
    words = text.count(" ") + 1
    own = tags[-1] if tags else "none"
    around = [f"in:{t}" for t in set(tags)] + [f"name:{n}" for n in set(block.names)]
    share = block.links * 4 // max(1, len(text))
    return ["bias", f"own:{own}", f"parent:{tags[-2] if len(tags) > 1 else 'none'}", *around, f"words:{_size(words)}", f"own:{own}:words:{_size(words)}",
            f"links:{min(4, share)}", f"end:{text[-1] if text[-1] in '.!?:|' else 'a'}", f"copyright:{'©' in text}"]


def _slot(name: str) -> int:
    h = 2166136261
    for b in name.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return (h ^ h >> 15) % WIDTH


_slots: dict[str, int] = {}


def _vector(block: Block) -> np.ndarray:
    out = []
    for name in features(block):
        at = _slots.get(name)
        if at is None:
            at = _slot(name)
            if len(_slots) < 50_000:
                _slots[name] = at
        out.append(at)
    return np.array(out)


class Model:
    """``emit``: weight of each feature for main text; ``step``: of label pairs; ``first``: of the first label."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, first: np.ndarray):
        self.emit, self.step, self.first = emit, step, first

    def decode(self, page: list[Block]) -> list[bool]:
        """The most probable labels, by Viterbi."""
        if not page:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        scores = [float(self.emit[_vector(b)].sum()) for b in page]
        no, yes = self.first.tolist()
        yes += scores[0]
        back = []
        for s in scores[1:]:
            a, b = no + s00 >= yes + s10, yes + s11 >= no + s01
            back.append((not a, b))
            no, yes = max(no + s00, yes + s10), max(no + s01, yes + s11) + s
        label = yes > no
        labels = [label]
        for from_no, from_yes in reversed(back):
            label = from_yes if label else from_no
            labels.append(label)
        return labels[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@lru_cache(maxsize=2)
def trained(pages: int = FIT_PAGES, rounds: int = ROUNDS, penalty: float = 1e-3) -> Model:
    """Maximum likelihood by full-batch gradient steps (Adam) over ``pages``
    labelled pages, all of them padded to one length and run side by side."""
    marked = [blocks(p) for p in labelled_pages(pages)]
    mark = re.compile(r"^\[\[([01]):(.*?)\]\]", re.S)
    xs, ys = [], []
    for page in marked:
        vectors, labels = [], []
        for b in page:
            m = mark.match(b.text)
            label = int(m[1])
            b.text = b.text.replace("]]", "")[4:] or " "
            vectors.append(_vector(b))
            labels.append(label)
        xs.append(vectors)
        ys.append(labels)
    n, longest = len(xs), max(map(len, ys))
    held = np.zeros((n, longest), bool)
    y = np.zeros((n, longest), np.int64)
    rows, cols, slots = [], [], []
    for i, (vectors, labels) in enumerate(zip(xs, ys)):
        held[i, :len(labels)] = True
        y[i, :len(labels)] = labels
        for t, v in enumerate(vectors):
            rows += [i] * len(v)
            cols += [t] * len(v)
            slots += v.tolist()
    rows, cols, slots = map(np.array, (rows, cols, slots))
    emit, step, first = np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(2)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (emit, step, first)]
    total = held.sum()
    for k in range(1, rounds + 1):
        score = np.zeros((n, longest, 2))
        np.add.at(score[:, :, 1], (rows, cols), emit[slots])
        alpha, beta = np.zeros_like(score), np.zeros_like(score)
        alpha[:, 0] = first + score[:, 0]
        for t in range(1, longest):
            go = _logsum(alpha[:, t - 1, :, None] + step, 1) + score[:, t]
            alpha[:, t] = np.where(held[:, t, None], go, alpha[:, t - 1])
        z = _logsum(alpha[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            go = _logsum(step + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(held[:, t + 1, None], go, 0)
        p = np.exp(alpha + beta - z[:, None, None]) * held[:, :, None]
        both = np.exp(alpha[:, :-1, :, None] + step + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * held[:, 1:, None, None]
        off = (y - p[:, :, 1]) * held
        g_emit = np.bincount(slots, off[rows, cols], WIDTH) / total - penalty * emit
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][held[:, 1:]], y[:, 1:][held[:, 1:]]), 1)
        g_step = (seen - both.sum((0, 1))) / total - penalty * step
        g_first = (np.bincount(y[:, 0], minlength=2) - p[:, 0].sum(0)) / total - penalty * first
        for value, grad, (m, v) in zip((emit, step, first), (g_emit, g_step, g_first), moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad ** 2 - v)
            value += 0.3 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-6)
    return Model(emit, step, first)


def main_text(html: str | None, model: Model) -> str:
    page = blocks(html)
    return "\n".join(b.text for b, main in zip(page, model.decode(page)) if main)


def extract(pages: DataFrame, fit_pages: int = FIT_PAGES, html_col: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the main text of each in the column ``to`` (replaced if
    there is one): the blocks labelled main text in page order, joined by line
    feeds. A null, empty or text-free page has an empty text. Repeated rows and
    other columns are kept as they are."""
    model = trained(fit_pages)
    parts = (model.emit, model.step, model.first)

    @F.pandas_udf("string")
    def of(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*parts)
        for series in html:
            yield pd.Series([main_text(h, own) for h in series], dtype=object)

    return pages.withColumn(to, of(F.col(html_col)))
