"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.session import materialize, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Python workers see slices of an Arrow batch of about this many text bytes, so that long texts don't add up.
SLICE_BYTES = 8 << 20


def ascii_lower(text: Column) -> Column:
    """Only A-Z become lower case; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, n: int) -> Column:
    """CRC-32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most SLICE_BYTES of ``text``; one row is never divided."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def per_slice(text: str, work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """A function for ``mapInArrow`` that applies ``work`` to each slice of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield work(batch)

    return run


def texts_of(batch: pa.RecordBatch, text: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(text)).to_pylist()


def record_batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    """A record batch of ``schema``; entries may be Arrow arrays, numpy arrays or lists."""
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_()}
    arrays = []
    for field, column in zip(schema, columns, strict=True):
        arrays.append(column if isinstance(column, pa.Array) else pa.array(column, type=kinds.get(field.dataType)))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def partition_sums(rows: DataFrame, size: int, add: Callable[[pa.RecordBatch, np.ndarray], None], text: str, label: str) -> np.ndarray:
    """The sum over all rows of what ``add(batch, sums)`` adds to an array of ``size`` numbers.

    Each task sums its rows; a few tasks per core are enough, so the sums on the way take about (cores * size) numbers.
    They are then added up on the executors in levels of about the square root of their number.
    """
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        for batch in slices(batches, text):
            add(batch, sums)
        yield _sums_row(sums)

    parts = rows.coalesce(tasks).mapInArrow(run, "sums binary")
    written = None
    while True:
        parts, before = materialize(parts, label), written
        if before is not None:
            release(before)
        written, count = parts, parts.count()
        if count <= 1:
            found = parts.first()
            release(parts)
            return np.zeros(size) if found is None else np.frombuffer(found.sums, np.float32).astype(float)
        groups = int(count**0.5) if count > 16 else 1
        parts = parts.repartition(groups).mapInArrow(_added, "sums binary")


def _sums_row(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([sums.astype("<f4").tobytes()], pa.binary())], names=["sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = None
    for batch in batches:
        for value in batch.column(0):
            row = np.frombuffer(value.as_buffer(), np.float32)
            sums = row.astype(float) if sums is None else sums + row
    if sums is not None:
        yield _sums_row(sums)
