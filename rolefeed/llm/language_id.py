"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams (one to
three letters, words padded with a blank), in order of frequency. A document's
own most frequent n-grams are compared with each profile by out-of-place
distance: the difference of the two ranks, or the profile size for an n-gram
that the profile lacks. The language of least distance is predicted.

Profiles are learnt on a bounded sample of the labelled documents (``fit_docs``
of each language, chosen by a hash of the id) and hold ``profile`` n-grams a
language, so they are small whatever the corpus; prediction is one pass over
whole texts without a shuffle.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefeed.llm.common import fresh

PROFILE, FIT_DOCS, FOLDS, HELD_OUT = 300, 2000, 3, 1
UNKNOWN = "und"
BITS, BLANK = 21, 32  # bits of a code point; what stands around words
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)], bool)
    return _letters


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams of a text's words in lower case; a blank
    stands before and after each word, n-grams reach over no other blank."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    c = np.concatenate(([BLANK], np.where(_is_letter()[raw], raw, BLANK), [BLANK]))
    letter = c != BLANK
    c = c[np.insert(letter[1:] | letter[:-1], 0, True)]  # one blank between two words
    letter = c != BLANK
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = c[:-1] | c[1:] << BITS
    three = two[:-1] | c[2:] << 2 * BITS
    return np.unique(np.concatenate((c[letter], two[letter[1:] | letter[:-1]], three[letter[1:-1]])), return_counts=True)


def _top(codes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The n most frequent codes in order; of equal counts the smaller code first."""
    return codes[np.lexsort((codes, -counts))[:n]]


def fold(id_col: str = "doc_id") -> Column:
    """The remainder that decides whether a document may be learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def learn(docs: DataFrame, profile: int = PROFILE, fit_docs: int = FIT_DOCS, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict[str, list[int]]:
    """Profiles of all languages among the labelled documents that are not held
    out: about ``fit_docs`` documents of each, those of smallest id hash, read
    whole. Rows without id, text or language teach nothing."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where((fold("id") != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one number per language: the documents are filtered where they are read
    shares = {r["lang"]: min(1.0, fit_docs / r["count"]) for r in rows.groupBy("lang").count().collect()}
    if not shares:
        return {}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    place = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(place < share).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                codes, counts = zip(*[ngrams(t) for t in part["text"]])
                kinds, at = np.unique(np.concatenate(codes), return_inverse=True)
                yield pd.DataFrame({"lang": lang, "code": kinds, "n": np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)})

    totals = sample.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= profile)
    found: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").collect():  # ``profile`` rows of each language
        found.setdefault(r["lang"], []).append(r["code"])
    return found


class Profiles:
    """Ranks of every known n-gram in every profile."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([c for x in profiles.values() for c in x], np.int64))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), size, np.int64)
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.codes, np.array(profiles[lang], np.int64))] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 less the mean distance over the largest. A text
        without a letter is unknown, at score 0; ties go to the first language."""
        own = _top(*ngrams(text), self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        ranks = self.ranks[:, at]
        place = np.abs(ranks - np.arange(len(own)))
        place[ranks == self.size] = self.size
        distance = place.mean(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / self.size)


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are
    replaced. Only the text is looked at. A null text or one without a letter,
    and any text when no language was learnt, is ``und`` at score 0. Repeated
    rows and ties in other columns make no difference."""
    model = Profiles(profiles, size)

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])

    guess = fresh(docs, "_guess")
    out = docs.withColumn(guess, of(F.col(text_col))).drop("lang_pred", "score")
    return out.withColumn("lang_pred", F.col(guess)["lang"]).withColumn("score", F.col(guess)["score"]).drop(guess)
