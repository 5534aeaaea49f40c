"""Rows reach Python tasks in batches of bounded size, however long their texts are."""

import pyarrow as pa
from pyspark.sql import functions as F

from silverlode.llm.queries import read


def test_long_texts_come_in_small_batches(spark, tmp_path):
    rows = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 400).alias("text"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    found = read(spark, str(tmp_path), "documents").coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 6000
    assert max(r.size for r in found) < 6 << 20
