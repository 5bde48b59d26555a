"""Benchmark decontamination by template canonicalisation.

Texts become word sequences in which numbers, names and units are typed
placeholders. Windows of ``window`` such words of every document are
hash-joined with those of the benchmark items, the canonical words are
compared, and the names behind the placeholders must map one to one between
item and document over a whole alignment: a question with other names is found,
a chance sequence of them is not. Numbers and units may be any, as each can be
replaced by itself. Windows of plain
lower-case words are joined beside them, so a copy in another letter case is
found as well.

Documents are read once. A Bloom filter of the benchmark's windows, of a fixed
2 MB whatever the benchmark's size, decides which windows leave the scan; it
has no false negatives, and what it lets through is decided by the join.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.common import fresh, stored

WINDOW, LITERALS, MIN_WORDS, ALIGNED = 8, 4, 5, 3
BLOOM_BITS = 24  # log2 of the filter's bits: 2 MB
TOKENS = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+|[.!?:;\n]+")
#: Words that are a unit when they follow a number.
UNITS = frozenset("""
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters kilometre kilometres
kilometer kilometers mg g kg t gram grams kilogram kilograms tonne tonnes ton tons oz lb lbs ounce ounces pound pounds
ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week
weeks month months year years percent cent cents dollar dollars euro euros usd eur gbp mph kmh degrees degree
""".split())
LITERAL, CAPITAL, NUMBER, UNIT = range(4)
MARKS = {CAPITAL: "<name>", NUMBER: "<number>", UNIT: "<unit>"}
_END = -1  # sentence end


def _code(token: str) -> int:
    """Hash of the lower-case word, its two lowest bits the kind."""
    first = token[0]
    if first in ".!?:;\n":
        return _END
    low = token.lower()
    kind = NUMBER if first.isdigit() else UNIT if low in UNITS else CAPITAL if first.isupper() else LITERAL
    return (xxhash.xxh64_intdigest(low) >> 1) & ~3 | kind


MANY = _code("many") & ~3


class _Codes(dict):
    """Codes of the words seen, worked out when first asked for."""

    def __missing__(self, token: str) -> int:
        code = _code(token)
        if len(token) < 40:
            self[token] = code
        return code


_codes = _Codes()


class Words(NamedTuple):
    tokens: list[str]  # with sentence ends
    place: np.ndarray  # of each word in ``tokens``
    code: np.ndarray  # hash of the word in lower case
    kind: np.ndarray
    named: np.ndarray  # ``kind`` with the names that begin sentences
    text_of: np.ndarray  # the text it is in


def canonical(texts: list[str | None]) -> Words:
    """The words of several texts. A word is a name if its first letter is a
    capital and it does not begin a sentence, a unit if it is one and follows a
    number or "many". In ``named`` a capital word that begins a sentence is a
    name as well if the text has it as a name elsewhere and never in lower case."""
    if len(_codes) > 300_000:
        _codes.clear()
    tokens: list[str] = []
    ends = []
    for text in texts:
        tokens += TOKENS.findall(text or "")
        tokens.append(".")
        ends.append(len(tokens))
    code = np.fromiter(map(_codes.__getitem__, tokens), np.int64, len(tokens))
    word = code != _END
    begins = np.ones(len(code), bool)
    begins[1:] = ~word[:-1]
    after_number = np.zeros(len(code), bool)
    after_number[1:] = word[:-1] & ((code[:-1] & 3 == NUMBER) | (code[:-1] & ~3 == MANY))
    kind = code & 3
    lower = kind == LITERAL
    initial = (kind == CAPITAL) & begins
    kind[initial | (kind == UNIT) & ~after_number] = LITERAL
    place = np.flatnonzero(word)
    code, kind, text_of = (code & ~3)[place], kind[place], np.searchsorted(np.array(ends), place, side="right")
    in_text = code.astype(np.uint64) ^ text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # the word in its text
    initial = np.flatnonzero(initial[place])
    initial = initial[np.isin(in_text[initial], in_text[kind == CAPITAL])]
    initial = initial[~np.isin(in_text[initial], in_text[lower[place]])]
    named = kind.copy()
    named[initial] = CAPITAL
    return Words(tokens, place, code, kind, named, text_of)


def _rolling(codes: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    x = codes.astype(np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[j:j + len(h)]
        h ^= h >> np.uint64(29)
    return h


def _windows(words: Words, n: int, literals: int) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """kind of window, hashes, which windows count, kinds of their words.
    Windows with a name that begins a sentence are given in both ways."""
    code, kind, text_of = words.code, words.kind, words.text_of
    if len(code) < n:
        return
    one_text = text_of[n - 1:] == text_of[:len(code) - n + 1]
    yield "literal", _rolling(code, n), one_text, np.zeros_like(kind)
    within = lambda marks: (held := np.concatenate(([0], np.cumsum(marks))))[n:] - held[:-n]
    for kind, counts in ((words.kind, one_text), (words.named, one_text & (within(words.named != words.kind) > 0))):
        if kind.any() and counts.any():
            slots = within(kind != LITERAL)
            marked = np.where(kind == LITERAL, code, kind)  # kinds are no word's hash
            yield "template", _rolling(marked, n), counts & (slots > 0) & (n - slots >= min(literals, n)), kind


def _row(i: int, n: int, words: Words, kind: np.ndarray) -> tuple[str, list[str]]:
    part, kinds = [words.tokens[k] for k in words.place[i:i + n].tolist()], kind[i:i + n].tolist()
    return (" ".join(MARKS[k] if k else w.lower() for w, k in zip(part, kinds)),
            [MARKS[k] + w.lower() for w, k in zip(part, kinds) if k])


def _bloom(hashes: np.ndarray) -> list[np.ndarray]:
    """Three positions in the filter for each hash."""
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    return [(hashes >> np.uint64(by)) & mask for by in (0, 20, 40)]


ROW = "kind string, n int, hash long, pos long, words string, slots array<string>"


def item_windows(items: DataFrame, window: int = WINDOW, literals: int = LITERALS, min_words: int = MIN_WORDS,
                 id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All windows of the items, with ``item_words``. An item with fewer words
    than a window is one window of its own length; one under ``min_words``
    has none, as such words stand in many texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item, text in zip(pdf["item_id"], pdf["text"]):
                words = canonical([text])
                total = len(words.place)
                n = min(window, total)
                if n < min_words:
                    continue
                for name, h, counts, kind in _windows(words, n, literals):
                    out += [(item, total, name, n, int(h[i].view(np.int64)), i, *_row(i, n, words, kind)) for i in np.flatnonzero(counts)]
            yield pd.DataFrame(out, columns=["item_id", "item_words", "kind", "n", "hash", "pos", "words", "slots"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"item_id long, item_words long, {ROW}")


def _filter_of(windows: DataFrame) -> np.ndarray:
    """The Bloom filter: 2^18 rows of 64 bits at most come to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.unique(np.concatenate(_bloom(pdf["hash"].to_numpy(np.int64).view(np.uint64))))
            yield pd.DataFrame({"place": (at >> np.uint64(6)).astype(np.int64),
                                "bit": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)})

    rows = windows.select("hash").mapInPandas(run, "place long, bit long").groupBy("place").agg(F.bit_or("bit").alias("bits"))
    bits = np.zeros(1 << (BLOOM_BITS - 6), np.int64)
    got = rows.toPandas()
    bits[got["place"].to_numpy()] = got["bits"].to_numpy()
    return bits.view(np.uint64)


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, literals: int = LITERALS, min_words: int = MIN_WORDS,
          aligned: int = ALIGNED, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that share a window: ``doc_id, item_id,
    n_windows`` (different windows of the item found), ``words_covered,
    item_words, coverage`` and ``literal`` (a window of equal words is among
    them; else the item was found with other numbers, names or units). A
    template window needs ``literals`` words that are no placeholder, and an
    alignment ``aligned`` such windows, or all that the item has.

    Null, empty and short texts have no window. Rows of equal id count as one
    document, also those of null id. An empty table on either side gives an
    empty result; other columns are not read."""
    known = stored(item_windows(items, window, literals, min_words, item_col, item_text), "benchmark-windows")
    sizes = sorted(r["n"] for r in known.select("n").distinct().collect())  # at most ``window`` values
    spark = docs.sparkSession
    filter_ = spark.sparkContext.broadcast(_filter_of(known).tobytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.frombuffer(filter_.value, np.uint64)
        for pdf in batches:
            for part in parts_of(pdf):
                words = canonical(part["text"].tolist())
                docs_, text_of = part["doc_id"].tolist(), words.text_of
                begin = np.searchsorted(text_of, np.arange(len(docs_)))
                out = []
                for n in sizes:
                    for name, h, counts, kind in _windows(words, n, literals):
                        hit = np.flatnonzero(counts & passes(bits, h))
                        out += [(docs_[text_of[i]], name, n, int(h[i].view(np.int64)), i - begin[text_of[i]], *_row(i, n, words, kind))
                                for i in hit.tolist()]
                if out:
                    rows = pd.DataFrame(out, columns=["doc_id", "kind", "n", "hash", "pos", "words", "slots"])
                    yield rows.astype({"doc_id": "Int64"})

    def parts_of(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Documents of about a million characters together, or a longer one."""
        share = pdf["text"].str.len().fillna(0).cumsum() // 1_000_000
        for _, part in pdf.groupby(share.to_numpy()):
            yield part

    def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for at in _bloom(h):
            at = at[ok]
            ok[ok] = (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
        return ok

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(run, f"doc_id long, {ROW}")
    same = found.join(known.select("item_id", "item_words", "kind", "n", "hash", "words", F.col("pos").alias("item_pos"),
                                   F.col("slots").alias("item_slots")), ["kind", "n", "hash", "words"])
    same = stored(same.select("doc_id", "item_id", "item_words", "kind", "n", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"),
                              F.arrays_zip(F.col("item_slots").alias("of_item"), F.col("slots").alias("of_doc")).alias("pairs")), "shared-windows")
    # one alignment holds at most as many windows as the item has words
    pairs = F.filter(F.array_distinct(F.flatten(F.collect_list("pairs"))), lambda x: x["of_item"].startswith(MARKS[CAPITAL]))
    all_of_item = known.where("kind = 'template'").groupBy("item_id").agg(F.count_distinct("pos").alias("of_item"))
    runs = (same.where("kind = 'template'").groupBy("doc_id", "item_id", "item_words", "n", "shift")
            .agg(pairs.alias("pairs"), F.collect_set("item_pos").alias("at")).join(all_of_item, "item_id"))
    one_to_one = ((F.size(F.array_distinct(F.col("pairs.of_item"))) == F.size("pairs"))
                  & (F.size(F.array_distinct(F.col("pairs.of_doc"))) == F.size("pairs")))
    by_template = (runs.where(one_to_one & (F.size("at") >= F.least(F.lit(aligned), F.col("of_item"))))
                   .select("doc_id", "item_id", "item_words", "n", F.explode("at").alias("item_pos"), F.lit(False).alias("literal")))
    by_word = same.where("kind = 'literal'").select("doc_id", "item_id", "item_words", "n", "item_pos", F.lit(True).alias("literal"))
    hits = by_word.unionByName(by_template).groupBy("doc_id", "item_id", "item_words", "n", "item_pos").agg(F.max("literal").alias("literal"))
    return (hits.groupBy("doc_id", "item_id", "item_words").agg(
                F.count("*").alias("n_windows"), F.max("literal").alias("literal"),
                F.size(F.array_distinct(F.flatten(F.collect_list(
                    F.sequence(F.col("item_pos"), F.col("item_pos") + F.col("n") - 1))))).cast("long").alias("words_covered"))
            .withColumn("coverage", F.col("words_covered") / F.col("item_words"))
            .select("doc_id", "item_id", "n_windows", "words_covered", "item_words", "coverage", "literal"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that share a window with any item, all columns
    kept. A row of null id goes only with a null id among the finds."""
    mark = fresh(docs, "_found")
    found = leaks(docs, items, id_col=id_col, **options).select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col(mark)), "left_anti")
