import __spark_entry__
import corpus_pipeline
from rolefeed.llm import language_id, queries
from tests.llm.helpers import CLASH, DATA, documents, edge_rows
from tests.llm.test_simhash import plain_components, plain_fingerprint

COLUMNS = list(corpus_pipeline.COLUMNS)


def table(spark, rows=None):
    from pyspark.sql import functions as F

    df = edge_rows(spark) if rows is None else edge_rows(spark, rows)
    return df.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names if x.startswith("op")}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "packing"]
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_one_after_the_other(spark):
    docs = documents(spark)
    first = corpus_pipeline.identify_language(spark, docs, DATA)
    assert first.columns == COLUMNS
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in first.collect()} == letters
    lines = corpus_pipeline.dedup_lines(spark, first, DATA)
    assert lines.columns == COLUMNS and lines.count() == len(letters)
    fps = {r.doc_id: plain_fingerprint(r.text) for r in lines.collect()}
    near = corpus_pipeline.near_duplicates(spark, lines, DATA)
    assert near.columns == COLUMNS and {r.doc_id for r in near.collect()} == set(plain_components(fps).values())
    clean = corpus_pipeline.decontaminate_benchmark(spark, near, DATA)
    assert clean.columns == COLUMNS and {r.doc_id for r in clean.collect()} <= {r.doc_id for r in near.collect()}
    packed = corpus_pipeline.pack(spark, clean, DATA).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean.collect()}
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, corpus_pipeline.run(spark, DATA).collect())) == sorted(map(key, packed))


def test_edge_rows_through_every_stage(spark):
    for rows in (None, []):
        docs = table(spark, rows)
        assert set(CLASH) < set(docs.columns)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, DATA)
            assert name == "packing" or out.columns == COLUMNS
            if rows == []:
                assert out.count() == 0
            else:
                out.count()


def test_language_stage_keeps_documents_of_any_learnt_language(spark):
    kept = corpus_pipeline.identify_language(spark, table(spark), DATA)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 2, 6, None, 8, 9], key=str)
    assert language_id.UNKNOWN == "und"
