"""A bucket of a keyed table is written by many tasks."""
import glob
import tempfile

from pyspark.sql import functions as F

from rolefeed.sources.tables import KeyedTable


def test_all_tasks_write_a_bucket(spark):
    path = tempfile.mkdtemp(prefix="rolefeed-write-") + "/t"
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        t = KeyedTable(spark, path, "k bigint, v string", ["k"], 2)
        t.create(spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v")))
    finally:
        spark.conf.set(key, old)
    assert len(glob.glob(f"{path}/rows/v00000000/_bucket=0/*.parquet")) > 1
    t.upsert(spark.createDataFrame([(7, "y"), (5000, "z")], "k bigint, v string"))
    assert t.read().count() == 1001 and t.read().where("v <> 'x'").count() == 2
