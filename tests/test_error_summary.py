from pyspark.sql import functions as F

from silverlode.operators import quality


def test_messages_that_occur_once_are_sorted_by_several_tasks(spark):
    message = F.concat(F.lit("bad - Value: "), F.least(F.col("id"), F.lit(19_990)).cast("string"))
    errors = spark.range(20_000, numPartitions=4).select(F.lit("c").alias("validate_column"), F.lit("k").alias("validation_type"), message.alias("validation_error_msg"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        summary = quality.error_summary(errors)
        parts = summary.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        first = summary.first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts) == 19_991 and max(parts) < 0.6 * sum(parts)
    assert (first.validation_error_msg, first.error_count) == ("bad - Value: 19990", 10)
