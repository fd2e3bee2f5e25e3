"""Keyed Parquet tables whose merges rewrite only what a batch touches.

Rows lie in ``<path>/_bucket=<n>``, n being a hash of their key.  A merge reads the buckets
that hold the batch's keys and puts their new content in place with Spark's dynamic partition
overwrite; other buckets are neither read nor written.  Spark replaces partitions one
after another, so new content is first written whole beside the table: whoever opens the
table after a crash puts a finished copy in place once more.  Rows of new keys can be added
without reading or writing what is there: their files are written beside the table and moved
into its buckets, one after another.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"

#: Spark's setting for files of different partitions that a task writes side by side; with
#: it, rows aren't sorted by partition before they are written.  Beyond, Spark sorts.
WRITERS, MOST_WRITERS = "spark.sql.maxConcurrentOutputFileWriters", 16
#: Spark's setting to delete shuffle files at the end of an execution.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class BucketTable:
    """A table of ``schema`` in ``buckets`` parts by ``keys``, which tell apart the rows that a merge replaces.

    The number of buckets is fixed with the first write; choose it so that a bucket
    has some hundred megabytes once the table is full.  Rows of a bucket are ordered by
    ``sort``, if given, so that filters on it skip most pages of a file; without it, tasks
    pass rows on and hold none.  A file gets ``file_rows`` rows at most, if given: for wide
    rows that compress well, as a task's share of a scan goes by compressed bytes and files.
    ``options`` are given to the Parquet writer.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str | Column], buckets: int = 64, sort: Sequence[str] = (),
        file_rows: int = 0, options: Mapping[str, str] = MappingProxyType({}),
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets, self.sort, self.file_rows, self.options = list(keys), buckets, list(sort), file_rows, dict(options)
        self.recover()

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    @property
    def _pending(self) -> str:
        return f"{self.path}-pending"

    @property
    def _added(self) -> str:
        return f"{self.path}-added"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or just some of its buckets; empty before the first write."""
        fs, p = self._fs(self.path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        return rows.select(*self.schema.names)

    def merge(self, batch: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merge ``batch`` in and return the buckets that were rewritten.

        ``merged`` gives the new content of some buckets from what they hold and the
        batch; it must keep every key in its bucket, which a merge on the keys does, and
        must give the same when a batch is merged twice, as a batch is after a crash.
        """
        self.recover()
        touched = [r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect()]  # ``buckets`` at most
        if touched:
            new = merged(self.read(touched), batch).select(*self.schema.names)
            # A bucket's rows go to as many tasks as their size asks for, so tasks don't grow with it.
            self._stage(new.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET))
            self.recover()
        return sorted(touched)

    def add(self, rows: DataFrame) -> None:
        """Add rows of keys that the table doesn't have yet; no bucket is read or rewritten.

        Tasks write the rows as they come, so whoever calls this deals and orders them; a task
        should have few buckets.  Each call adds files; its shuffles are deleted when it ends.
        """
        self.recover()
        before = self.spark.conf.get(RELEASE, "false")
        try:
            self.spark.conf.set(RELEASE, "true")
            self._write(rows.select(*self.schema.names).withColumn(BUCKET, self.bucket()), "static", self._added, ordered=True)
        finally:
            self.spark.conf.set(RELEASE, before)
        self.recover()

    def _stage(self, rows: DataFrame) -> None:
        """Write the new content of buckets beside the table; ``_SUCCESS`` tells that it is whole."""
        self._write(rows, "static", self._pending)

    def _write(self, rows: DataFrame, overwrite: str, path: str, ordered: bool = False) -> None:
        """``ordered`` rows are in order already, or need none."""
        with self._unsorted(ordered or not self.sort):
            (rows if ordered else self._sorted(rows)).write.mode("overwrite").options(
                partitionOverwriteMode=overwrite, maxRecordsPerFile=self.file_rows, **self.options
            ).partitionBy(BUCKET).parquet(path)

    @contextmanager
    def _unsorted(self, unsorted: bool) -> Iterator[None]:
        """Writes in here don't sort rows by bucket, which would hold a task's rows uncompressed."""
        before = self.spark.conf.get(WRITERS)
        try:
            if unsorted:
                self.spark.conf.set(WRITERS, str(min(self.buckets, MOST_WRITERS)))
            yield
        finally:
            self.spark.conf.set(WRITERS, before)

    def _sorted(self, rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions(BUCKET, *self.sort) if self.sort else rows

    def recover(self) -> None:
        """Put a finished copy of a merge or what a finished addition has left in place; unfinished
        ones are dropped."""
        self._move_added()
        fs, pending = self._fs(self._pending)
        if not fs.exists(pending):
            return
        if fs.exists(self._fs(f"{self._pending}/_SUCCESS")[1]):
            stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
            rows = self.spark.read.schema(stored).parquet(self._pending)
            # They lie by bucket already, so they are copied without a shuffle.
            self._write(rows, "dynamic", self.path)
        fs.delete(pending, True)

    def _move_added(self) -> None:
        fs, added = self._fs(self._added)
        if not fs.exists(added):
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        if fs.exists(path(added, "_SUCCESS")):
            for folder in fs.listStatus(added):
                if not folder.isDirectory():
                    continue
                bucket = path(self.path, folder.getPath().getName())
                fs.mkdirs(bucket)
                for file in fs.listStatus(folder.getPath()):
                    # Names are unique to the write.  A store that copies may have stopped before it deleted.
                    moved = path(bucket, file.getPath().getName())
                    if fs.exists(moved):
                        fs.delete(moved, False)
                    if not fs.rename(file.getPath(), moved):
                        raise OSError(f"{file.getPath()} could not be moved to {moved}")
        fs.delete(added, True)
