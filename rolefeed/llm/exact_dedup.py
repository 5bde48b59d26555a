"""Exact deduplication by distributed MSD radix partitioning.

A document is read as its byte length followed by its bytes. Round by round,
each group is split by the next bytes of its members (16 first, then eight
times as many as the round before) until a group is a single document or its
members have ended. Keys are the bytes themselves, so equality is exact and
needs no digest.

Every round is a partial aggregate per (group, next bytes), so the copies of a
text meet on the map side before any shuffle, and a join of the undecided rows
with the groups that are left; a group with a third of all rows is a join
partition that adaptive execution splits. Documents decided in a round come
out of its aggregate alone and their texts go no further.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefeed.llm.common import stored

FIRST = 16  # bytes of the first round
GROWTH = 8


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                 first: int = FIRST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id`` (largest id among the
    equal texts), ``group_size, kept`` and the columns named in ``carry``.

    A null text is an empty one; all empty texts are equal. Exactly one row of
    a group is kept: that of the largest id, and of repeated rows with that id
    one. Null ids lose against any other. An empty table gives an empty result;
    columns not named are not read, whatever their names.
    """
    carry = carry or []
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.struct(F.lit(0).alias("_"), *carry).alias("carried"),
        F.octet_length(data).alias("n"), data.alias("rest"))
    rows = rows.withColumn("part", F.lit(0).cast("long")).withColumn("row", F.lit(0).cast("long"))
    key, width, done, out = ["part", "n", "head"], first, 0, []
    while True:
        rows = rows.withColumn("head", F.expr(f"substring(rest, 1, {width})"))
        groups = stored(
            rows.groupBy(*key).agg(
                F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("top"),
                F.any_value("carried").alias("carried"))
            .withColumn("next", F.monotonically_increasing_id()), "radix-groups")
        # before the first table is written rows have no number of their own,
        # so a group of several rows ends in a later round
        more = F.col("size") > 1 if done == 0 else (F.col("size") > 1) & (F.col("n") > done + width)
        single = groups.where(F.col("size") == 1).select(
            F.col("top.doc_id").alias("doc_id"), F.col("top.doc_id").alias("keep_id"),
            F.col("size").alias("group_size"), F.lit(True).alias("kept"), "carried")
        out.append(single)
        if done:
            ended = groups.where((F.col("size") > 1) & ~more).select(*key, "size", "top")
            out.append(rows.join(ended, key).select(
                "doc_id", F.col("top.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                F.struct("doc_id", "row").eqNullSafe(F.col("top")).alias("kept"), "carried"))
        left = groups.where(more).select(*key, "next")
        if not left.take(1):
            break
        number = F.monotonically_increasing_id() if done == 0 else F.col("row")
        rows = stored(
            rows.join(left, key).select(
                "doc_id", "carried", "n", F.expr(f"substring(rest, {width + 1})").alias("rest"),
                F.col("next").alias("part"), number.alias("row")), "radix-rows")
        done += width
        width *= GROWTH
    result = out[0]
    for more_rows in out[1:]:
        result = result.unionByName(more_rows)
    return result.select("doc_id", "keep_id", "group_size", "kept", *[F.col("carried")[c].alias(c) for c in carry])
