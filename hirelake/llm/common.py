"""Small helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Bytes with A-Z lower-cased.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The ASCII white space [\x20\x09-\x0D]; ``bytes.split()`` splits on just these.
SPACES = " \t\n\x0b\x0c\r"

#: Spark's setting to delete shuffle files at the end of an execution.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's setting for the bytes up to which it broadcasts a side of a join by itself, through the driver.
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
#: What joins of tables that grow with the input broadcast at most, as the driver holds one for each join
#: until it happens to collect its garbage.
SMALL = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; every executor sees it.

    Where it is unset, a temporary folder serves on a local master; on a cluster
    that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: computed once, and
    whole after an executor is lost."""
    return Stages(df.sparkSession).add(df, what)


class Stages:
    """Tables written on the way to a result; ``clear`` deletes those no longer read.

    With ``broadcast``, joins on the way broadcast so many bytes at most by Spark's own choice.
    """

    def __init__(self, spark: SparkSession, broadcast: int | None = None):
        self.spark, self.broadcast = spark, broadcast
        self.paths: list[str] = []

    def add(self, df: DataFrame, what: str, release: bool = False) -> DataFrame:
        """``df`` as a table; ``release`` deletes its shuffles once it is written, which
        suits a ``df`` that is evaluated for this table only."""
        path = f"{shared_folder(self.spark)}/{what}-{uuid.uuid4().hex}"
        before, joins = self.spark.conf.get(RELEASE, "false"), self.spark.conf.get(BROADCAST)
        try:
            self.spark.conf.set(RELEASE, "true" if release else before)
            if self.broadcast is not None:
                now = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
                self.spark.conf.set(BROADCAST, str(min(now, self.broadcast)))
            df.write.parquet(path)
        finally:
            self.spark.conf.set(RELEASE, before)
            self.spark.conf.set(BROADCAST, joins)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, keep: int = 0) -> None:
        """Delete all but the last ``keep``."""
        gone = self.paths[: len(self.paths) - keep]
        for path in gone:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.paths = self.paths[len(gone) :]


def portions(items: Iterator, weight, limit: int) -> Iterator[list]:
    """Lists of consecutive items; a list is closed once it weighs ``limit``."""
    held, total = [], 0
    for x in items:
        held.append(x)
        total += weight(x)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held
