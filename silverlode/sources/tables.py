"""Layer tables as partitioned parquet, with repeatable writes.

There is no table format here: plain directories and dynamic partition overwrite.  A table has one writer: batches of a
source run one after another (a scheduler's job, as is who runs).  What can end half-way is a publish.  So a batch first
writes its result whole to a staging folder and then copies the staged partitions over the table's; whoever comes next, the
same batch again or another one, finds a result that is staged and not published yet, and publishes it before anything
else is computed.  Where several writers share a table use ``operators.merge.merge_into_catalog`` on a catalog with
row-level operations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "key_bucket"


_READY, _PUBLISHED = "_READY", "_PUBLISHED"
#: Row hashes and raw copies are most of a table: half the size of the default codec's.
_CODEC = "zstd"
#: A result is staged and published by as many groups of buckets as hold so many bytes of files each, by eight at most:
#: what is shuffled, or written beside what it replaces, is a group's rows, not all.
GROUP_BYTES, _GROUPS = 64 << 20, 8


class Layer:
    """Tables below one root folder: ``<root>/<table>``, staging below ``<root>/_staging/<table>/<batch>``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ---- names in the file system ------------------------------------------------------

    def _files(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        files, hadoop_path = self._files(path)
        return files.exists(hadoop_path)

    def _names(self, folder: str) -> list[str]:
        files, hadoop_path = self._files(folder)
        return [s.getPath().getName() for s in files.listStatus(hadoop_path)] if files.exists(hadoop_path) else []

    def _delete(self, path: str) -> None:
        files, hadoop_path = self._files(path)
        files.delete(hadoop_path, True)

    def tables(self) -> list[str]:
        return sorted(n for n in self._names(self.root) if not n.startswith("_"))

    def exists(self, table: str) -> bool:
        return self._exists(self.path(table))

    # ---- reads and writes --------------------------------------------------------------

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table, or an empty frame of ``schema`` before its first write."""
        if not self.exists(table):
            if schema is None:
                raise FileNotFoundError(self.path(table))
            # a frame that the optimizer knows to be empty: joins with it move nothing
            return self.spark.createDataFrame([], schema).where(F.lit(False))
        return (self.spark.read.schema(schema) if schema is not None else self.spark.read).parquet(self.path(table))

    def append(self, df: DataFrame, table: str, partition: Sequence[str] = ()) -> None:
        df.write.mode("append").option("compression", _CODEC).partitionBy(*partition).parquet(self.path(table))

    def replace_partitions(self, df: DataFrame, table: str, partition: Sequence[str]) -> None:
        """Overwrite only the partitions that ``df`` holds: a repeated write changes nothing."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", _CODEC)
        writer.partitionBy(*partition).parquet(self.path(table))

    def bucket_of(self, keys: Sequence[str]) -> Column:
        """Partition of a key; pick ``buckets`` so that one holds about a gigabyte."""
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def touched(self, batch: DataFrame, keys: Sequence[str]) -> list[int]:
        """Buckets a batch falls into: never more than ``buckets`` small numbers."""
        return [r[0] for r in batch.select(self.bucket_of(keys)).distinct().collect()]

    def size(self, path: str) -> int:
        """Bytes of the files below a folder."""
        files, hadoop_path = self._files(path)
        return files.getContentSummary(hadoop_path).getLength() if files.exists(hadoop_path) else 0

    def groups(self, buckets: Sequence[int], size: int) -> list[list[int]]:
        """Buckets dealt out over the groups in which ``size`` bytes are written."""
        buckets = sorted(buckets)
        n = max(1, min(len(buckets), _GROUPS, math.ceil(size / GROUP_BYTES)))
        return [buckets[i::n] for i in range(n)]

    # ---- staging -----------------------------------------------------------------------

    def _staging(self, table: str, batch_id: str) -> str:
        return f"{self.root}/_staging/{table}/{batch_id}"

    def _mark(self, table: str, batch_id: str, name: str) -> None:
        files, path = self._files(f"{self._staging(table, batch_id)}/{name}")
        files.create(path, True).close()

    def _marked(self, table: str, batch_id: str, name: str) -> bool:
        return self._exists(f"{self._staging(table, batch_id)}/{name}")

    def staged_size(self, table: str, batch_id: str) -> int:
        return self.size(self._staging(table, batch_id))

    def staged(self, table: str, batch_id: str) -> DataFrame:
        return self.spark.read.parquet(self._staging(table, batch_id))

    def mark_ready(self, table: str, batch_id: str) -> None:
        """All that belongs to the batch's result is written; from now on it is published, not computed again."""
        self._mark(table, batch_id, _READY)

    def mark_published(self, table: str, batch_id: str) -> None:
        self._mark(table, batch_id, _PUBLISHED)

    def is_published(self, table: str, batch_id: str) -> bool:
        return self._marked(table, batch_id, _PUBLISHED)

    def unpublished(self, table: str) -> list[str]:
        """Batches whose result for a table is ready, and not known to be published."""
        batches = sorted(self._names(f"{self.root}/_staging/{table}"))
        return [b for b in batches if self._marked(table, b, _READY) and not self.is_published(table, b)]

    def stage(
        self, df: DataFrame, table: str, batch_id: str, figures: Mapping[str, Column] | None = None, mode: str = "overwrite"
    ) -> tuple[DataFrame, dict]:
        """Write a batch's result whole; ``figures`` are aggregates of it, observed by the write itself."""
        measures = [column.alias(name) for name, column in (figures or {}).items()]
        if BUCKET in df.columns:
            # Rows of a bucket lie together, so that publishing makes few files; a large bucket is dealt out over several tasks.
            df = df.hint("rebalance", BUCKET)
        seen, path = Observation(), self._staging(table, batch_id)
        (df.observe(seen, *measures) if measures else df).write.mode(mode).option("compression", _CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get if measures else {}

    def stage_groups(
        self, rows_of: Callable[[list[int]], DataFrame], groups: Sequence[list[int]], table: str, batch_id: str,
        figures: Mapping[str, Column],
    ) -> dict:
        """``stage`` what ``rows_of`` makes of each group of buckets, one after the other; ``figures`` are counts, added up."""
        found = dict.fromkeys(figures, 0)
        for number, buckets in enumerate(groups):
            seen = self.stage(rows_of(buckets), table, batch_id, figures, "append" if number else "overwrite")[1]
            found = {name: found[name] + seen[name] for name in found}
        return found

    def staged_groups(self, table: str, batch_id: str) -> list[list[int]]:
        """The buckets of a staged result in the groups in which it is published."""
        buckets = [r[0] for r in self.staged(table, batch_id).select(BUCKET).distinct().collect()]
        return self.groups(buckets, self.staged_size(table, batch_id))

    def forget(self, table: str, batch_id: str) -> None:
        """Remove what a batch staged; only after the batch was logged as finished."""
        self._delete(self._staging(table, batch_id))
