"""Linked lines against edit similarity alone: no candidate rule is restated here."""
import itertools
import random

from pyspark.sql import functions as F

from rolefeed.llm import line_dedup
from tests.llm.test_line_dedup import edit, rows  # noqa: F401

HAN = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
THAI = [chr(c) for c in range(0x0E01, 0x0E2F)]


def similar(a, b):
    return edit(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)


def plain_groups(lines):
    """Smallest number of a line in each line's group, over all pairs."""
    label = list(range(len(lines)))
    for i, j in itertools.combinations(range(len(lines)), 2):
        if label[i] != label[j] and similar(lines[i], lines[j]):
            lo, hi = sorted((label[i], label[j]))
            label = [lo if x == hi else x for x in label]
    return label


def groups(spark, lines):
    got = line_dedup.line_groups(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), sampled=True).collect()
    return [x for _, x in sorted((r.doc_id, r.first_doc) for r in got)]


def word(r, n=0):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n or r.randint(2, 9)))


def test_one_word_edits_of_every_length(spark):
    r, lines = random.Random(1), []
    for n in (3, 4, 5, 6, 8, 10, 14, 20, 30, 45):
        for _ in range(4):
            line = [word(r) for _ in range(n)]
            at = r.randrange(n)
            other = [line[:at] + [word(r, len(line[at]))] + line[at + 1:], line[:at] + line[at + 1:], line[:at] + [word(r, 3)] + line[at:]]
            lines += [" ".join(x) for x in (line, *other)]
    want = plain_groups(lines)
    assert groups(spark, lines) == want
    assert sum(x != i for i, x in enumerate(want)) > 90


def test_scripts_without_spaces_and_single_words(spark):
    r, lines, made = random.Random(2), [], 0
    for letters, n in itertools.product((HAN, THAI), (15, 30, 60, 120)):
        for _ in range(8):
            line = [r.choice(letters) for _ in range(n)]
            other = list(line)
            other[r.randrange(n)] = r.choice(letters)
            lines += ["".join(line), "".join(other)]
    lines += ["internationalisation", "internationalization", "Telecommunications", "telecommunication"]
    want, got = plain_groups(lines), groups(spark, lines)
    found = sum(x != i for i, x in enumerate(got))
    assert all(x in (i, want[i]) for i, x in enumerate(got))
    assert found >= 0.9 * sum(x != i for i, x in enumerate(want))


def test_linked_lines_by_edit_similarity_alone(spark, rows):  # noqa: F811
    """The bound that stood before short words lost their vote."""
    got = line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string"), sampled=True).collect()
    assert sum((r.doc_id, r.line_no) != (r.first_doc, r.first_line) for r in got) > 60


def test_query_and_pipeline_are_sampled(spark, tmp_path):
    import __spark_entry__
    import corpus_pipeline

    lines = ["one short line of nine words stands right here", "one short line of nine words strays right here"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = __spark_entry__.queries()["op5_line_dedup"](spark, str(tmp_path)).where("kept").collect()
    assert [r.doc_id for r in kept] == [0]
    assert sorted(r.text for r in corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).collect()) == ["", lines[0]]
