"""Rows that every operator must get through: nulls, empty and very long texts,
ties, repeated rows, and extra columns whose names the operators use themselves."""
from __future__ import annotations

import os

DATA = "/root/testdata/sf0.001"
CLASH = ("_stay", "_id", "_drop", "_found", "_guess", "fp", "node", "component", "rank", "task", "ids", "line", "line_no", "words",
         "lang_pred", "score", "keep_id", "size", "head", "rest", "part", "row", "kept", "sim", "key", "id")
LONG = "lorem ipsum dolor sit amet consetetur " * 4000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. Then it sleeps in the sun.", "en"),
    (2, "The quick brown fox jumps over the lazy dog. Then it sleeps in the sun.", "en"),
    (2, "The quick brown fox jumps over the lazy dog. Then it sleeps in the sun.", "en"),
    (3, None, None), (4, "", "en"), (5, "   \n\n ", None), (6, LONG, "la"), (7, "!!! 12 ---", "en"),
    (None, "a row without an id", "en"), (None, None, None), (8, "é" * 3000, "fr"), (9, "short", None)]


def edge_rows(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string" + "".join(f", `{c}` string" for c in CLASH)
    return spark.createDataFrame([(*r, *["x"] * len(CLASH)) for r in rows], schema)


def documents(spark):
    return spark.read.parquet(os.path.join(DATA, "documents.parquet"))


def key(row):
    return tuple((v is None, v) for v in row)
