"""Parquet tables with whole-version replacement.

A keyed table lives in ``<root>/<name>/v=<number>``; a merge writes the next
number and never touches what it reads.  Readers take the highest version whose
job committed (``_SUCCESS``), so a lost writer leaves the table as it was.
Append-only tables keep one directory, partitioned by their run column.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.sources.schemas import APPEND_ONLY, SCHEMAS


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a local
    master uses a temporary folder, as in tests; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="hirelake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def spread(scan: DataFrame, partitions: int) -> DataFrame:
    """A table dealt over so many partitions, for CPU-heavy work on few file splits.

    It shuffles the table, so the caller says whether and how far.
    """
    return scan.repartition(partitions)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, for several later jobs.

    The copy is a reliable checkpoint: it survives lost executors.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, name: str) -> list[tuple[int, str]]:
        """Committed versions as (number, folder), oldest first."""
        fs, p = self._fs(self.path(name))
        if not fs.exists(p):
            return []
        out = []
        for status in fs.listStatus(p):
            folder = status.getPath()
            number = folder.getName().removeprefix("v=")
            marker = self.spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
            if number.isdigit() and fs.exists(marker):
                out.append((int(number), folder.toString()))
        return sorted(out)

    def version(self, name: str) -> int | None:
        """Highest committed version of a keyed table."""
        return max((v for v, _ in self._versions(name)), default=None)

    def applied(self, name: str) -> dict[str, int]:
        """Last batch merged into the table, by stream."""
        versions = self._versions(name)
        return self._record(versions[-1][1]) if versions else {}

    def _record(self, folder: str) -> dict[str, int]:
        """The batches that a version holds: (stream, batch) rows beside its data."""
        fs, p = self._fs(f"{folder}/_streams")
        if not fs.exists(p):
            return {}
        rows = self.spark.read.schema("stream string, batch long").parquet(f"{folder}/_streams")
        return {r.stream: r.batch for r in rows.collect()}

    def read(self, name: str, as_of_version: int | None = None) -> DataFrame:
        """The table under its declared schema; empty before the first write."""
        schema = SCHEMAS[name]
        if name in APPEND_ONLY:
            fs, p = self._fs(self.path(name))
            if not fs.exists(p):
                return self.spark.createDataFrame([], schema)
            return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)
        folders = dict(self._versions(name))
        if not folders and as_of_version is None:
            return self.spark.createDataFrame([], schema)
        number = max(folders) if as_of_version is None else as_of_version
        return self.spark.read.schema(schema).parquet(folders[number])

    def replace(
        self, name: str, df: DataFrame, batch: tuple[str, int] | None = None, base: int | None = None
    ) -> DataFrame:
        """Write the next version and return it as stored.

        ``batch`` is a stream and its batch that is merged in; the record of all streams'
        batches is committed with the version.  ``base`` is the version that ``df`` was
        made from, the newest by default.  If another writer has taken the next number,
        this raises and leaves its version alone.
        """
        versions = dict(self._versions(name))
        current = base if base is not None else max(versions, default=None)
        version = 0 if current is None else current + 1
        folder = f"{self.path(name)}/v={version}"
        fs, p = self._fs(folder)
        taken = FileExistsError(f"{name} has a version {version} already: merge again with what it holds now")
        if version in versions:
            raise taken
        # Each writer has a folder of its own until it commits by a rename.
        claim = self._fs(f"{self.path(name)}/_claim-{version}-{uuid.uuid4().hex}")[1]
        streams = self._record(versions[current]) if current is not None else {}
        if batch is not None:
            streams[batch[0]] = batch[1]
        own = claim.toString()
        _conform(df, name).write.parquet(own)
        if streams:
            self.spark.createDataFrame(sorted(streams.items()), "stream string, batch long").coalesce(1).write.parquet(f"{own}/_streams")
        nested = self._fs(f"{folder}/{claim.getName()}")[1]
        if fs.exists(p) or not fs.rename(claim, p) or fs.exists(nested):
            # Another writer was first; a rename to an existing folder may go inside it.
            fs.delete(nested if fs.exists(nested) else claim, True)
            raise taken
        return self.read(name, version)

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Drop all but the last ``keep`` versions; the newest has the record of streams."""
        old = self._versions(name)[: -max(keep, 1)]
        for _, folder in old:
            fs, p = self._fs(folder)
            fs.delete(p, True)
        return len(old)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to an append-only table."""
        if name not in APPEND_ONLY:
            raise ValueError(f"{name} is keyed; use replace()")
        parts = APPEND_ONLY[name]
        _conform(df, name).write.mode("append").partitionBy(*parts).parquet(self.path(name))

    def create_all(self) -> None:
        """Write an empty first version of every keyed table that has none."""
        for name, schema in SCHEMAS.items():
            if name not in APPEND_ONLY and self.version(name) is None:
                self.replace(name, self.spark.createDataFrame([], schema))

    def reset(self) -> None:
        """Empty every table: keyed ones get an empty version, logs are emptied."""
        for name, schema in SCHEMAS.items():
            empty = self.spark.createDataFrame([], schema)
            if name in APPEND_ONLY:
                empty.write.mode("overwrite").parquet(self.path(name))
            else:
                self.replace(name, empty)


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Columns in declared order and type; absent ones become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[name].fields
        ]
    )


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """Seed URLs from a text file, one per line."""
    return spark.read.text(path).selectExpr("trim(value) AS url").where("url <> ''")


def jdbc_options(
    url: str, table: str, key: str, low: int, high: int, partitions: int, **extra: str
) -> dict[str, str]:
    """Options of a partitioned database read: each task fetches one key range."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "pushDownPredicate": "true",
        **extra,
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 500, **extra: str) -> None:
    """Append to a database table in batches."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch), **extra
    ).save()
