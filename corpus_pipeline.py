"""A corpus pipeline: what documents go through before training, one operator of ``silverlode.llm`` a stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the same columns; the last returns the
pieces of packed sequences.  Further columns of the documents pass through, whatever their names.  ``run`` writes each stage's rows as Parquet below the shared folder and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import decontam, linededup, packing, quality, simhash
from silverlode.llm.queries import read, tokenizer_path
from silverlode.session import materialize


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Column names (in lower case) that the operators use for themselves.
TAKEN = {"score", "lines_before", "lines_dropped", "_page_host", "_host", "_bad", "_kept", "_leak"}


def keeps_columns(stage: Stage) -> Stage:
    """A stage that returns the columns it was given; those with names in TAKEN are renamed meanwhile."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_own{k}_{c}" for k, c in enumerate(docs.columns) if c.lower() in TAKEN}
        found = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        kept = found.select(*[aside.get(c, c) for c in docs.columns])
        return kept.withColumnsRenamed({new: old for old, new in aside.items()})

    return run


@keeps_columns
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality classifier accepts."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.scores(docs, model).where(F.col("score") >= quality.THRESHOLD)


@keeps_columns
def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that too many texts of their source share; ``n_chars`` follows."""
    found = linededup.without_boilerplate(docs, F.col("source"))
    changed = F.when(F.col("lines_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed)


@keeps_columns
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


@keeps_columns
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, copied or paraphrased."""
    return decontam.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 4096 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("lines", drop_boilerplate),
    ("near_duplicates", keep_one_of_each),
    ("benchmark", drop_benchmark),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints, the search or the packing; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
