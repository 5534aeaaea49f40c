"""What a layered run leaves on disk, and how much of a bucket one task writes."""

from pathlib import Path

from pyspark.sql import functions as F

from silverlode.session import scratch_path
from silverlode.sources.tables import BUCKET, Layer


def shuffle_files(spark) -> set[str]:
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (held.apply(i).getName() for i in range(held.size())) if n.startswith("shuffle_")}


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    layer = Layer(spark, str(tmp_path), buckets=1)
    rows = spark.range(200_000, numPartitions=8).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).withColumn(BUCKET, F.lit(0))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        _, figures = layer.stage(rows, "t", "B1", {"n": F.count(F.lit(1))})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list(Path(layer._staging("t", "B1")).glob("*.parquet"))
    assert figures == {"n": 200_000} and len(files) > 3
    assert all(".zstd." in f.name for f in files)
    assert layer.staged("t", "B1").agg(F.count_distinct("id")).first()[0] == 200_000


def test_shuffles_of_an_ended_query_are_removed(spark):
    known = shuffle_files(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(7).withColumnRenamed("id", "k").hint("merge"), "k")
    path = scratch_path(spark, "counted")
    counted.write.parquet(path)
    assert shuffle_files(spark) <= known
    # a frame that is used again works its shuffles out again
    assert sorted(counted.collect()) == sorted(counted.collect()) == sorted(spark.read.parquet(path).collect())
