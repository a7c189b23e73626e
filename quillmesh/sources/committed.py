"""JSON lines published all or nothing: tasks write ranges of an ordered result, and a manifest names them only once all are there.

A Python data source. Each task writes the lines of its range to a file of its own, named by range and attempt, so
an attempt that is lost or repeated leaves a file that nobody names. The commit writes the manifest aside and
moves it into place; a failed job leaves the earlier one, and with it the earlier result. The folder must be one that the driver
and all executors see.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

CURRENT = "current.json"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Range(WriterCommitMessage):
    number: int
    file: str
    lines: int


class LinesWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.run = path.rstrip("/"), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        at, name, lines = TaskContext.get(), "", 0
        name = f"{self.run}/{at.partitionId():06d}-{at.taskAttemptId()}.json"
        where, root = _opened(self.path)
        where.create_dir(f"{root}/{self.run}", recursive=True)
        with where.open_output_stream(f"{root}/{name}") as out:
            for batch in iterator:
                for value in batch.column(0).to_pylist():
                    out.write(value.encode() + b"\n")
                    lines += 1
        return Range(at.partitionId(), name, lines)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        where, root = _opened(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.number)
        with where.open_output_stream(f"{root}/{self.run}.manifest") as out:
            out.write(json.dumps([[m.file, m.lines] for m in parts]).encode())
        where.move(f"{root}/{self.run}.manifest", f"{root}/{CURRENT}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        where, root = _opened(self.path)
        if where.get_file_info(f"{root}/{self.run}").type == fs.FileType.Directory:
            where.delete_dir(f"{root}/{self.run}")


class Lines(DataSource):
    """One string column; options: path."""

    @classmethod
    def name(cls) -> str:
        return "committed_lines"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options["path"])


def write(rows: DataFrame, path: str, *order: str) -> None:
    """The rows as JSON lines in the order of the columns, published as a whole in place of what was there."""
    rows.sparkSession.dataSource.register(Lines)
    rows.orderBy(*order).select(F.to_json(F.struct(*rows.columns)).alias("value")).write.format("committed_lines").option("path", path).mode("append").save()


def manifest(path: str) -> list[tuple[str, int]]:
    """(file, lines) of the published result, in order; nothing where nothing was published."""
    where, root = _opened(path.rstrip("/"))
    if where.get_file_info(f"{root}/{CURRENT}").type != fs.FileType.File:
        return []
    with where.open_input_stream(f"{root}/{CURRENT}") as f:
        return [(f"{path.rstrip('/')}/{name}", n) for name, n in json.loads(f.read())]


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    files = [name for name, n in manifest(path) if n]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
