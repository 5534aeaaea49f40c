"""Comparison of two tables by content: order-free checksums per bucket of the key, then rows of the buckets that differ.

A bucket's checksum is its number of rows, the sum of their 64-bit row hashes, and the sum of a second, independent
hash of each.  Sums do not depend on the order of rows, combine before the shuffle, and can be added up over batches; they count
repeats, which an exclusive-or would cancel.  Counts alone miss a changed row, and two rows whose values were exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums of 64-bit hashes need more than 64 bits.
_WIDE = "decimal(38,0)"


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row; NULL, empty text and the column a value stands in all count."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return [F.xxhash64(F.lit(1), *texts), F.xxhash64(F.lit(2), *reversed(texts))]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def checksums(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, row_count, sum_1, sum_2)."""
    first, second = row_hashes(columns)
    return rows.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(first.cast(_WIDE)).cast(_WIDE).alias("sum_1"), F.sum(second.cast(_WIDE)).cast(_WIDE).alias("sum_2")
    )


def compare_checksums(source: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, source_count, target_count, status): MATCH, COUNT_MISMATCH or CONTENT_MISMATCH per bucket."""
    left = source.withColumnsRenamed({"row_count": "source_count", "sum_1": "_a1", "sum_2": "_a2"})
    right = target.withColumnsRenamed({"row_count": "target_count", "sum_1": "_b1", "sum_2": "_b2"})
    met = left.join(right, "bucket", "full").fillna(0, ["source_count", "target_count"])
    same = F.col("_a1").eqNullSafe(F.col("_b1")) & F.col("_a2").eqNullSafe(F.col("_b2"))
    status = F.when(F.col("source_count") != F.col("target_count"), "COUNT_MISMATCH").when(same, "MATCH").otherwise("CONTENT_MISMATCH")
    return met.select("bucket", "source_count", "target_count", status.alias("status"))


def differing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 256) -> DataFrame:
    """(keys, side, status, n): rows that one side has more often than the other.  Only buckets that differ are compared row by row.

    ``status`` is CHANGED where the other side has the key with other values, else MISSING_IN_TARGET or MISSING_IN_SOURCE.
    """
    found = compare_checksums(checksums(source, keys, columns, buckets), checksums(target, keys, columns, buckets))
    wrong = found.where(F.col("status") != "MATCH").select("bucket")
    first, second = row_hashes(columns)

    def side(rows: DataFrame, one: int) -> DataFrame:
        narrow = rows.select(*keys, bucket_of(keys, buckets).alias("bucket"), first.alias("_h1"), second.alias("_h2"))
        return narrow.join(wrong, "bucket", "left_semi").withColumn("_side", F.lit(one)).drop("bucket")

    counted = side(source, 1).unionByName(side(target, -1)).groupBy(*keys, "_h1", "_h2").agg(F.sum("_side").alias("_more")).where(F.col("_more") != 0)
    counted = counted.withColumn("side", F.when(F.col("_more") > 0, "SOURCE").otherwise("TARGET")).withColumn("n", F.abs("_more"))
    per_key = counted.groupBy(*keys).agg(F.count_distinct("side").alias("_sides"))
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    met = counted.join(per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys}), condition)
    missing = F.when(F.col("side") == "SOURCE", "MISSING_IN_TARGET").otherwise("MISSING_IN_SOURCE")
    return met.select(*keys, "side", F.when(F.col("_sides") == 2, "CHANGED").otherwise(missing).alias("status"), "n")
