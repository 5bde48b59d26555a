"""Keyed Parquet tables (S1-S6) with plain Spark reads and writes.

A :class:`KeyedTable` keeps its rows in files by a hash bucket of the key. A
write puts the buckets it touches into a folder of its own version and then
appends one small file that names the folders of every bucket in that version.
That file appears as a whole or not at all, and no stored file is changed: a
reader stays on the version it opened, a write that fails leaves no trace that
is read, and a bucket left without a row is just not named any more.
:func:`merge`, :func:`patch` and :func:`delete` are the same steps on DataFrames.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

BUCKET = "_bucket"
POINTERS = f"version bigint, {BUCKET} int, folder string"


class KeyedTable:
    """Table at ``path`` with one row per ``keys``; ``schema`` as DDL. Choose
    ``buckets`` so that a bucket is some hundred MB. ``bucket_by``: the keys that
    decide the bucket (default all), so that rows which are read together lie
    together. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 64, bucket_by: Sequence[str] | None = None):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.schema, self.bucket_by = schema, list(bucket_by or keys)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int"))

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that ``rows`` fall into: at most ``buckets`` numbers."""
        return [r[0] for r in self._bucketed(rows.select(*self.bucket_by)).select(BUCKET).distinct().collect()]

    def _folders(self) -> tuple[int, dict[int, list[str]]]:
        """The newest version and the folders of its buckets."""
        pointers = self.spark.read.schema(POINTERS).parquet(f"{self.path}/versions")
        newest = pointers.agg(F.max("version").alias("v")).first()["v"]
        named: dict[int, list[str]] = {}
        for r in pointers.where((F.col("version") == newest) & (F.col(BUCKET) >= 0)).collect():
            named.setdefault(r[BUCKET], []).append(r["folder"])
        return newest, named

    def _commit(self, version: int, named: Mapping[int, Sequence[str]]) -> None:
        rows = [(version, -1, "")] + [(version, b, f) for b, folders in named.items() for f in folders]
        self.spark.createDataFrame(rows, POINTERS).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def _write(self, df: DataFrame, touched: Sequence[int] | None = None) -> None:
        """A new version: ``df`` are all rows of the buckets ``touched`` (or, if
        None, rows added to whatever is there)."""
        version, named = self._folders() if self.exists() else (-1, {})
        folder = f"{self.path}/rows/v{version + 1:08d}"
        columns = self.spark.createDataFrame([], self.schema).columns
        # all tasks write, not one a bucket: a bucket is dealt into files by key
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // (len(touched or ()) or self.buckets))
        out = self._bucketed(df.select(*columns)).repartition(BUCKET, F.pmod(F.hash(*self.keys), F.lit(parts)))
        out.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        written = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(folder)
        new = {r[0]: [f"{folder}/{BUCKET}={r[0]}"] for r in written.select(BUCKET).distinct().collect()}
        kept = {b: f for b, f in named.items() if b not in (touched or ())}
        self._commit(version + 1, {b: [*kept.get(b, []), *new.get(b, [])] for b in {**kept, **new}})

    def exists(self) -> bool:
        try:
            self.spark.read.schema(POINTERS).parquet(f"{self.path}/versions")
        except AnalysisException:
            return False
        return True

    def create(self, rows: DataFrame | None = None) -> KeyedTable:
        if self.exists():
            raise ValueError(f"there is a table at {self.path}")
        self._write(rows if rows is not None else self.spark.createDataFrame([], self.schema))
        return self

    def _of(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """All rows of the newest version (pushdown and pruning apply)."""
        return self._of([f for folders in self._folders()[1].values() for f in folders])

    def select(self, columns: Sequence[str], where: Column | str | None = None, order: Sequence[str] = ()) -> DataFrame:
        """Named columns under a predicate, ordered. No row cap."""
        df = self.read() if where is None else self.read().where(where)
        df = df.select(*columns)
        return df.orderBy(*order) if order else df

    def _near(self, touched: Sequence[int]) -> DataFrame:
        named = self._folders()[1]
        return self._of([f for b in touched for f in named.get(b, [])])

    def near(self, rows: DataFrame) -> DataFrame:
        """The stored rows of the buckets that ``rows`` (their ``bucket_by``) fall
        into; the files of other buckets are not opened."""
        return self._near(self._touched(rows))

    def append(self, rows: DataFrame) -> None:
        """S3: plain insert of new keys; no stored file is read or rewritten."""
        self._write(rows)

    def upsert(self, rows: DataFrame, **options) -> None:
        """S4 (see :func:`merge`) on the touched buckets only."""
        rows = cut_lineage(rows)
        touched = self._touched(rows)
        self._write(merge(self._near(touched), rows, self.keys, **options), touched)

    def patch(self, match: Column, values: Mapping[str, Column]) -> None:
        """Only buckets with a matching row are rewritten."""
        touched = self._touched(self.read().where(F.coalesce(match, F.lit(False))).select(*self.keys))
        self._write(patch(self._near(touched), match, values), touched)

    def delete(self, ids: DataFrame) -> None:
        """Stored rows whose key is in ``ids``, in their buckets only. With
        ``bucket_by`` fewer than the keys, ``ids`` hold all keys as well."""
        ids = cut_lineage(ids.select(*self.keys))
        touched = self._touched(ids)
        self._write(delete(self._near(touched), ids, self.keys), touched)


def merge(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    insert_defaults: Mapping[str, Column] | None = None,
    monotone: Sequence[str] = (),
) -> DataFrame:
    """Insert-or-update on ``keys``; on conflict only the columns present in
    ``rows`` change, and a NULL in ``rows`` does overwrite. Columns absent from
    ``rows`` keep the target value; new keys get ``insert_defaults`` (else NULL).
    ``monotone`` columns take ``greatest(old, new)`` so a late batch cannot move
    them backwards (T6).

    A full outer join on the keys: both sides shuffle on the key once, rows of
    a hot key stay one row each (keys are unique on both sides).
    """
    keys = list(keys)
    insert_defaults = dict(insert_defaults or {})
    payload = [c for c in rows.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in target.columns if c not in keys], F.lit(True).alias("_t"))
    s = rows.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in payload], F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    in_src = F.col("_s").isNotNull()
    in_tgt = F.col("_t").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in payload:
            new = F.col(f"_s_{c}")
            if c in monotone:
                new = F.when(in_tgt, F.greatest(F.col(f"_t_{c}"), new)).otherwise(new)
            out.append(F.when(in_src, new).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in insert_defaults:
            out.append(F.when(in_tgt, F.col(f"_t_{c}")).otherwise(insert_defaults[c]).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    extra = [c for c in payload if c not in target.columns]
    out += [F.col(f"_s_{c}").alias(c) for c in extra]
    return j.select(*out)


def patch(df: DataFrame, match: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where ``match`` holds."""
    m = F.coalesce(match, F.lit(False))
    return df.select(*[F.when(m, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def delete(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key is in ``ids`` (left anti join, no id chunks)."""
    return df.join(ids.select(*keys), list(keys), "left_anti")
