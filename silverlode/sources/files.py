"""Batch readers: delimited text, JSON and parquet, always with a given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.config import ConfigError, FileFormat, Source


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _null_tokens(df: DataFrame, tokens: tuple[str, ...], names: list[str]) -> DataFrame:
    if not tokens:
        return df
    return df.withColumns({n: F.when(~F.col(n).isin(*tokens), F.col(n)) for n in names})


def read_delimited(
    spark: SparkSession, path: str, names: list[str], fmt: FileFormat, pattern: str | None = None, strict: bool = False
) -> DataFrame:
    """All columns as text, assigned by position: header names need not match.

    ``strict`` fails the read on a malformed line; otherwise short lines are
    padded with NULL and surplus fields are dropped.
    """
    reader = (
        spark.read.schema(text_schema(names))
        .option("sep", fmt.delimiter)
        .option("quote", fmt.quote)
        .option("escape", fmt.quote)
        .option("header", fmt.header)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST" if strict and not fmt.ragged else "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", fmt.trim)
        .option("ignoreTrailingWhiteSpace", fmt.trim)
        .option("nullValue", fmt.null_tokens[0] if fmt.null_tokens else "")
        .option("emptyValue", "")
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return _null_tokens(reader.csv(path), fmt.null_tokens[1:], names)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, fmt: FileFormat, pattern: str | None = None, whole_file: bool = False
) -> DataFrame:
    """JSON objects, or arrays of them, one per line; text null tokens become NULL.

    ``whole_file`` reads one object or array spread over the lines of a file; such a
    file cannot be split, so large inputs should come as lines.
    """
    reader = spark.read.schema(schema).option("multiLine", whole_file)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)]
    return _null_tokens(reader.json(path), fmt.null_tokens, texts)


def read_parquet(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def read_source(spark: SparkSession, source: Source, root: str, file: str | None = None, strict: bool = False) -> DataFrame:
    """The rows of a configured batch source: one file, or all that match its pattern."""
    if source.ingestion != "BATCH":
        raise ConfigError(f"source {source.name} is read as a stream")
    path = file or f"{root}/{source.landing}"
    pattern = None if file else source.pattern
    if source.format.kind == "CSV":
        return read_delimited(spark, path, source.names, source.format, pattern, strict)
    if source.format.kind == "JSON":
        return read_json(spark, path, text_schema(source.names), source.format, pattern)
    return read_parquet(spark, path, pattern).select(*[F.col(n).cast("string") for n in source.names])


def with_file_name(df: DataFrame) -> DataFrame:
    """Add the file each row came from."""
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The files below ``root`` that match ``pattern``: path, size and time, without their content."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    )
    return found.select("path", "length", F.col("modificationTime").alias("modified_at"))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, names: list[str], fmt: FileFormat | None = None) -> None:
    """Convert delimited files to snappy parquet, split by split."""
    rows = read_delimited(spark, csv_path, names, fmt or FileFormat())
    rows.write.mode("overwrite").option("compression", "snappy").parquet(parquet_path)
