"""Exports as JSON documents, written by the executors and committed by the driver.

``df.write.format("json_export").mode("overwrite").save(path)`` leaves one file per task,
each a JSON array of its rows, and ``_manifest.json`` with the files, their rows and the
total.  Tasks write into a folder of the run beside the export.  Once all have ended, the
driver moves the files of the attempts that count (one per task, whatever the rows) and
writes the manifest last: an export without one isn't whole.  A run that fails leaves
nothing, and what was there before stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "_manifest.json"


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _plain(value):
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return value.hex()
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


class JsonWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str], overwrite: bool):
        self.path, self.names, self.overwrite = path.rstrip("/"), names, overwrite
        self.run = uuid.uuid4().hex
        self.pending = f"{self.path}-pending-{self.run}"

    def write(self, iterator: Iterator[Row]) -> Written:
        """A task's rows as one array; an empty task writes no file."""
        from pyspark import TaskContext

        files, folder = _opened(self.pending)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.json"
        out, rows = None, 0
        try:
            for row in iterator:
                if out is None:
                    # The driver made the folder: a task that outlives the run's end finds none.
                    out = files.open_output_stream(f"{folder}/{name}")
                given = {k: _plain(v) for k, v in zip(self.names, row, strict=True) if v is not None}
                out.write((("[\n" if rows == 0 else ",\n") + json.dumps(given, ensure_ascii=False)).encode())
                rows += 1
            if out is not None:
                out.write(b"\n]\n")
        finally:
            if out is not None:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, target = _opened(self.path)
        _, pending = _opened(self.pending)
        files.create_dir(target, recursive=True)
        before = files.get_file_info(fs.FileSelector(target))
        if self.overwrite:
            # The manifest goes first, so that a crash here doesn't leave one for missing files.
            for info in sorted(before, key=lambda x: x.base_name != MANIFEST):
                if info.type == fs.FileType.File:
                    files.delete_file(info.path)
        done = sorted((m for m in messages if m is not None and m.file), key=lambda m: m.file)
        kept = [] if self.overwrite else _manifest(files, target)["files"]
        for m in done:
            files.move(f"{pending}/{m.file}", f"{target}/{m.file}")
        listed = kept + [{"file": m.file, "rows": m.rows} for m in done]
        with files.open_output_stream(f"{target}/{MANIFEST}") as out:
            out.write(json.dumps({"files": listed, "rows": sum(x["rows"] for x in listed)}).encode())
        self._drop()

    def abort(self, messages: list[Written | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        from pyarrow import fs

        files, pending = _opened(self.pending)
        for attempt in range(10):
            if files.get_file_info(pending).type != fs.FileType.Directory:
                return
            try:
                files.delete_dir(pending)
            except OSError:  # a task that is being killed may add a file meanwhile
                if attempt == 9:
                    raise


def _manifest(files, target: str) -> dict:
    from pyarrow import fs

    path = f"{target}/{MANIFEST}"
    if files.get_file_info(path).type != fs.FileType.File:
        return {"files": [], "rows": 0}
    with files.open_input_stream(path) as f:
        return json.loads(f.read())


class JsonExport(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_export"

    def writer(self, schema: StructType, overwrite: bool) -> JsonWriter:
        made = JsonWriter(self.options["path"], schema.names, overwrite)
        files, pending = _opened(made.pending)
        files.create_dir(pending, recursive=True)
        return made


def export_documents(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Write ``df`` with the executors as JSON arrays; null fields are left out."""
    df.sparkSession.dataSource.register(JsonExport)
    df.write.format(JsonExport.name()).mode("overwrite" if overwrite else "append").save(path)


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An export read again; one without a manifest, so not whole, is an error."""
    files, target = _opened(path.rstrip("/"))
    listed = _manifest(files, target)["files"]
    if not listed:
        from pyarrow import fs

        if files.get_file_info(f"{target}/{MANIFEST}").type != fs.FileType.File:
            raise FileNotFoundError(f"{path} has no whole export")
        return spark.createDataFrame([], schema)
    # A file is an array; each is parsed by one task.
    return spark.read.schema(schema).option("multiLine", True).json([f"{path.rstrip('/')}/{x['file']}" for x in listed])
