"""Registered queries over the driver tables, and the pipeline stage by stage."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import duck, rows_of
from silverlode.llm import decontam, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    found = duck(FOLDER).execute(queries.ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in found.description], found.fetchall())


@pytest.mark.parametrize("name", ["op2_simhash", "op4_language", "op5_licenses", "op7_quality", "op8_pii"])
def test_one_row_per_document(spark, name):
    ids = [r.doc_id for r in queries.QUERIES[name](spark, FOLDER).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect())


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < docs.count() <= before
    assert decontam.leaks(docs, bench).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_stages_with_odd_rows(spark):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b c", None, "s", 5), (3, "word " * 20000, "en", "s", 100000)]
    odd = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, FOLDER).count() >= 1, name
        assert stage(spark, odd.limit(0), FOLDER).count() == 0, name


def test_run_gives_pieces(spark):
    assert corpus_pipeline.run(spark, FOLDER).agg(F.max("length")).first()[0] <= 4096


def test_further_columns_pass_through_whatever_their_names(spark):
    """Extra columns that bear an operator's own names keep their values in every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mark = F.concat(F.lit("x"), F.col("doc_id").cast("string"))
    names = ["Score", "lines_before", "_kept", "_bad", "_leak", "held_out"]
    wide = docs.withColumns(dict.fromkeys(names, mark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, wide, FOLDER)
        assert found.columns == wide.columns
        plain = stage(spark, docs, FOLDER)
        assert found.count() == plain.count() > 0
        assert found.where(" OR ".join(f"{n} IS DISTINCT FROM concat('x', doc_id)" for n in names)).isEmpty()
