"""Helpers that the training-data operators share: tables in the shared
folder, rows with a stable number, and connected components."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolefeed.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns through a one-row generator: a later filter stays above it,
    so it is not copied beneath with the expressions evaluated once more."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for this run, in the folder all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result has no lineage, so a lost executor costs no recomputation, and
    later reads prune columns."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for narrow tables that are read as a whole."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    return (edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(least.select("hi", F.col("m").alias("lo"))).distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the links ``a``-``b`` (two long columns).

    Returns ``node, component`` for every node that has a link to another one;
    ``component`` is the smallest node reachable. Alternating large-star and
    small-star steps, each a partial aggregate and a join: a hub with very many
    links is pre-aggregated on the map side and its join partition is one that
    adaptive execution splits. The number of rounds is logarithmic in the
    longest chain. Null nodes and self links are no links.
    """
    e = checkpointed(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    state = _state(e)
    while state[0]:
        e = checkpointed(_small_star(_large_star(e)))
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
