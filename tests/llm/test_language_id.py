import zlib

import numpy as np
from pyspark.sql import functions as F

from rolefeed.llm import language_id, queries
from tests.llm.helpers import CLASH, DATA, documents, edge_rows


def plain_ngrams(text):
    out = {}
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            padded = f" {word} "
            for n, grams in ((1, list(word)), (2, [padded[i:i + 2] for i in range(len(padded) - 1)]), (3, [padded[i:i + 3] for i in range(len(padded) - 2)])):
                for g in grams:
                    out[g] = out.get(g, 0) + 1
        word = ""
    return out


def decoded(code):
    return "".join(chr(code >> 21 * i & (1 << 21) - 1) for i in range(3) if code >> 21 * i & (1 << 21) - 1)


def test_ngrams_against_plain_python():
    for text in ["Hello, world", "a", "é è 1 x", "", "...", None, "İstanbul ß", "ab  cd\n\nef"]:
        codes, counts = language_id.ngrams(text)
        assert dict(zip(map(decoded, codes.tolist()), counts.tolist())) == plain_ngrams(text)


def test_out_of_place_distance_against_plain_python():
    profiles = {}
    for lang, text in (("aa", "the cat sat on the mat with the hat"), ("bb", "der hund sass auf dem und der bund")):
        codes, counts = language_id.ngrams(text)
        profiles[lang] = language_id._top(codes, counts, 20).tolist()
    model = language_id.Profiles(profiles, 20)
    text = "the dog sat with der cat"
    own = language_id._top(*language_id.ngrams(text), 20).tolist()
    distance = {x: sum(abs(p.index(c) - i) if c in p else 20 for i, c in enumerate(own)) for x, p in profiles.items()}
    lang, score = model.predict(text)
    assert lang == min(distance, key=distance.get) and np.isclose(score, 1 - min(distance.values()) / len(own) / 20)


def test_held_out_accuracy_and_contract(spark):
    got = queries.op3_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 200 and np.mean([r.lang == r.lang_pred for r in held]) > 0.98


def test_labels_of_held_out_rows_are_never_used(spark):
    docs = documents(spark)
    spoilt = docs.withColumn("lang", F.when(language_id.fold() == language_id.HELD_OUT, "xx").otherwise(F.col("lang")))
    assert language_id.learn(docs) == language_id.learn(spoilt)
    assert len(language_id.learn(docs, fit_docs=5)) == 4


def test_edge_rows(spark):
    profiles = language_id.learn(documents(spark))
    out = language_id.predict(edge_rows(spark), profiles)
    assert set(CLASH) < set(out.columns) and out.columns.count("score") == 1
    got = out.collect()
    assert len(got) == 12
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert language_id.predict(edge_rows(spark, []), profiles).collect() == []
    assert language_id.learn(edge_rows(spark, [])) == {}
    assert {r.lang_pred for r in language_id.predict(edge_rows(spark), {}).collect()} == {"und"}
