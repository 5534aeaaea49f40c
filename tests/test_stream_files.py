from pyspark.sql import functions as F

from silverlode.streaming import stateful
from workbook import streams


def test_rows_of_a_stream_are_worked_out_once(spark, monkeypatch):
    seen, closing = [], stateful.closing
    monkeypatch.setattr(stateful, "closing", lambda rows, *rest: seen.append(rows) or closing(rows, *rest))
    at = (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("at")
    folder = streams.files_of(spark.range(100).select("id", at), "at", "id")
    [rows] = seen
    assert rows.inputFiles() and all(folder in name for name in rows.inputFiles())
    written = spark.read.parquet(folder)
    assert written.count() == 101
    assert written.where("id = -1").first().at > written.where("id = 99").first().at
