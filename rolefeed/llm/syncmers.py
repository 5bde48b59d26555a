"""Document fingerprints by closed syncmers, DataFrame operations only.

A run of K characters is an anchor if the least hash of its runs of S
characters stands at one of its edges. Whether it is one depends on its own
characters alone, so equal passages have equal anchors wherever they stand, and
anchors are never further apart than K - S characters. Two texts match where
neighbouring anchors and the distance between them are the same (links); their
likeness is the Dice coefficient of the sets of their links.

As anchors know no context, those of a text put together from two parts are
those of the parts, shifted, and those of the few characters around the joint:
an edited text is not read again. For the same reason a very long text is read
in pieces that overlap, and no array of characters is longer than PIECE.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolefeed.functions.text import let
from rolefeed.llm.common import computed

K, S = 31, 8
RUNS = K - S + 1  # runs of S characters in an anchor
PIECE = 1 << 15
BUCKET_ROWS, BUCKETS = 250, 10_000  # documents of a bucket of neighbours; buckets at most
LEAST = -(1 << 63)
LOW = (1 << 32) - 1


def _least_of(h: Column, width: int) -> Column:
    """Least of ``width`` values from each place on (fewer at the end), by
    leasts of a few values and leasts of a few of these."""
    few = math.isqrt(width - 1) + 1
    far = [*range(0, width - few, few), width - few]
    part = F.transform(h, lambda x, i: F.least(x, *[F.get(h, i + k) for k in range(1, few)]))
    return let(part, lambda m: F.transform(m, lambda x, i: F.least(x, *[F.get(m, i + k) for k in far[1:]])))


def _hash(*values: Column) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit(LOW))


def _anchors_of_piece(text: Column, at: Column) -> Column:
    """Anchors of a piece of text that begins at ``at``."""
    runs = F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))." % S), F.lit(1))
    cover = [*range(0, K - S, S), K - S]  # runs that cover all K characters

    def chosen(h: Column, least: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(h) - RUNS), lambda i: (
            F.get(least, i) == F.get(h, i)) | (F.get(least, i) == F.get(h, i + (RUNS - 1))))
        return F.transform(places, lambda i: F.shiftleft((at + i).cast("long"), 32).bitwiseOR(
            _hash(*[F.get(h, i + c) for c in cover])))

    none = F.array().cast("array<long>")
    return let(F.transform(runs, lambda r: F.xxhash64(r)), lambda h: F.when(
        F.size(h) >= RUNS, let(_least_of(h, RUNS), lambda m: chosen(h, m))).otherwise(none))


def anchors(text: Column) -> Column:
    """Anchors of a text in order: array of longs, the place of the first
    character in the upper half, 32 bits of the hash of the K characters in the
    lower. A text with fewer than K characters has none."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - K, F.lit(0)), F.lit(PIECE))
    return F.flatten(F.transform(starts, lambda at: _anchors_of_piece(
        F.substring(text, at + 1, F.lit(PIECE + K - 1)), at)))


def _or_whole(found: Column, text: Column) -> Column:
    """A text without an anchor is one itself."""
    return F.when(F.size(found) > 0, found).otherwise(F.array(_hash(text)))


def _steps(found: Column) -> Column:
    """For each anchor its hash and, above it, its distance from the one before."""
    place = lambda c: F.shiftleft(F.shiftright(c, 32), 32)
    return F.transform(found, lambda c, i: c - F.when(i > 0, place(F.get(found, i - 1))).otherwise(F.lit(0).cast("long")))


def links(found: Column) -> Column:
    """What is matched: every two neighbouring anchors and their distance; a
    single anchor stands for itself."""
    of = lambda steps: F.when(F.size(steps) == 1, steps).otherwise(F.transform(
        F.slice(steps, 2, F.size(steps)), lambda c, i: F.xxhash64(c, F.get(steps, i).bitwiseAND(F.lit(LOW)))))
    return F.array_distinct(let(_steps(found), of))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two sets of links."""
    return 2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def fingerprint(found: Column) -> Column:
    """Ten hex digits an anchor: two of its distance from the one before (from
    the beginning for the first), eight of its hash."""
    return F.lower(F.array_join(F.transform(_steps(found), lambda c: F.lpad(F.hex(c), 10, "0")), ""))


def put_together(left: Column, left_anchors: Column, left_chars: Column, right: Column, right_anchors: Column, right_chars: Column) -> Column:
    """Anchors of the first ``left_chars`` characters of one text followed by
    the first ``right_chars`` of another, from those of the two texts."""
    kept = lambda found, chars: F.filter(found, lambda c: F.shiftright(c, 32) + K <= chars)
    rim = F.least(left_chars, F.lit(K - 1))
    joint = F.concat(F.substring(left, left_chars - rim + 1, rim), F.substring(right, F.lit(1), F.least(right_chars, F.lit(K - 1))))
    shift = F.shiftleft(left_chars.cast("long"), 32)
    return F.concat(kept(left_anchors, left_chars), _anchors_of_piece(joint, left_chars - rim),
                    F.transform(kept(right_anchors, right_chars), lambda c: c + shift))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, anchors, fingerprint`` of every row of ``docs``.

    A null text is an empty one. Texts with no anchor (those with fewer than K
    characters, and few longer ones) are one themselves, so equal texts have
    equal fingerprints and others, but for equal hashes, do not match. Repeated
    rows and null ids are returned as they come. An empty table gives an empty
    result; other columns are not read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = computed(rows, anchors=_or_whole(anchors(F.col("text")), F.col("text")))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "anchors", fingerprint(F.col("anchors")).alias("fingerprint"))


def _dealt(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) dealt to ``bucket`` by descending id (``at``),
    each bucket's first document to the bucket before as a ``guest`` as well."""
    docs = docs.withColumn("at", F.coalesce("doc_id", F.lit(LEAST).cast("long")))
    many = min(BUCKETS, max(1, -(-docs.count() // BUCKET_ROWS)))
    shares = ", ".join(f"{j / many}D" for j in range(1, many))
    cuts = f"approx_percentile(at, array({shares}), {max(10_000, 10 * many)})" if shares else "CAST(array() AS array<bigint>)"
    heads = docs.agg(F.expr(f"array_sort(array_distinct(array_append({cuts}, max(at))))")).first()[0]  # BUCKETS ids at most
    if heads == [None]:
        heads = []
    powers = F.array(*[F.lit(1 << b) for b in reversed(range(many.bit_length()))])
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))

    def places(heads: Column) -> Column:
        below = F.aggregate(powers, F.lit(0), lambda i, step: F.when(
            (i + step <= F.size(heads)) & (F.get(heads, i + (step - 1)) < F.col("at")), i + step).otherwise(i))
        # numbered upwards: by descending id the bucket before is the one above
        return let(below, lambda b: F.when(F.get(heads, b) == F.col("at"), F.array(
            place(b, 0), place((b + 1) % F.size(heads), 1))).otherwise(F.array(place(b, 0))))

    of = let(F.lit(heads).cast("array<long>"), places)
    return docs.select("*", F.inline(of)).repartition("bucket")


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document beside its edited text and the next document: ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The next document is that of the next smaller id, after the
    last the first; the edited text has its last floor(n_chars / 2) characters
    replaced by the first as many (or all) of the next document. ``near_*`` are
    the likeness of the fingerprint to that of the edited text and of the next
    document, 0 to 1.

    Rows of equal id follow each other by a hash of their text, null ids come
    after all others; else rows and texts count as ``fingerprints`` says. A
    single document is its own next one.

    Ids are dealt to buckets of neighbours at quantiles of the ids. These are
    ids of the table, and the document that heads a bucket goes to the bucket
    before it as well, to be the one after its last: one shuffle of the texts,
    and no order over all rows. A bucket is sorted and read by a window that
    spills, so its size is not a matter of memory."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _dealt(docs).withColumn("found", anchors(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("at"), F.xxhash64("text"), "text")
    rows = rows.withColumn("next", F.lead(F.struct("text", "found")).over(order)).where("guest = 0")
    rows = computed(rows.select("doc_id", "text", "found", F.col("next.text").alias("next"), F.col("next.found").alias("next_found")),
                    n=F.length("text"), lent=F.least(F.floor(F.length("text") / 2).cast("int"), F.length("next")))
    keep = F.col("n") - F.floor(F.col("n") / 2).cast("int")
    rows = computed(rows, keep=keep, edited=F.concat(F.substring("text", F.lit(1), keep), F.substring("next", F.lit(1), F.col("lent"))))
    rows = computed(
        rows, own=_or_whole(F.col("found"), F.col("text")), after=_or_whole(F.col("next_found"), F.col("next")),
        changed=_or_whole(put_together(*[F.col(c) for c in ("text", "found", "keep", "next", "next_found", "lent")]), F.col("edited")))
    rows = computed(rows, own_links=links(F.col("own")))
    return rows.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own_links"), links(F.col("changed"))).alias("near_edited"),
        likeness(F.col("own_links"), links(F.col("after"))).alias("near_next"))
