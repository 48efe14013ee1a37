"""Python data sources: files of any size by byte ranges, and lines that appear only when the whole write has succeeded.

register(spark) makes both known as formats:

    spark.read.format("byte_ranges").option("block", 1 << 20).load(path)     file, start, data (a row a block)
    df.select("value").write.format("published_lines").mode("append").save(path)

Paths are those of pyarrow.fs: local ones, and stores that it knows by their scheme.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes of a task, and of a row.
RANGE, BLOCK = 64 << 20, 1 << 18


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int


class ByteRanges(DataSource):
    """(file, start, data) of the files at or below a path, in blocks of `block` bytes; a task reads up to `range` bytes of a file,
    rounded to whole blocks. Empty files have no rows."""

    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "file string, start long, data binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RangeReader(self.options["path"], int(self.options.get("range", RANGE)), int(self.options.get("block", BLOCK)))


class _RangeReader(DataSourceReader):
    def __init__(self, path: str, size: int, block: int) -> None:
        self.path, self.block, self.size = path, block, max(1, size // block) * block

    def partitions(self) -> list[InputPartition]:
        store, root = _located(self.path)
        info = store.get_file_info(root)
        files = [info] if info.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        named = sorted((f.path, f.size) for f in files if f.is_file and not f.base_name.startswith((".", "_")))
        return [Range(name, at, min(size, at + self.size)) for name, size in named for at in range(0, size, self.size)]

    def read(self, partition: Range) -> Iterator[tuple]:
        store, _ = _located(self.path)
        with store.open_input_file(partition.file) as f:
            for at in range(partition.start, partition.end, self.block):
                f.seek(at)
                yield partition.file, at, f.read(min(self.block, partition.end - at))


@dataclass
class Pending(WriterCommitMessage):
    file: str | None


class PublishedLines(DataSource):
    """Writes the only column, a string, as lines. Each task writes a pending file; files get their names when all tasks are done,
    and none stays if one has failed for good. Files that are there already stay (append), or go (overwrite)."""

    @classmethod
    def name(cls) -> str:
        return "published_lines"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _LineWriter(self.options["path"], schema.names[0], overwrite)


class _LineWriter(DataSourceWriter):
    def __init__(self, path: str, column: str, overwrite: bool) -> None:
        self.path, self.column, self.overwrite = path, column, overwrite
        self.run = uuid.uuid4().hex

    def _pending(self) -> tuple[fs.FileSystem, str, str]:
        store, root = _located(self.path)
        return store, root, posixpath.join(root, f"_pending-{self.run}")

    def write(self, iterator: Iterator[Row]) -> Pending:
        first = next(iterator, None)
        if first is None:
            return Pending(None)
        store, _, pending = self._pending()
        store.create_dir(pending)
        file = posixpath.join(pending, uuid.uuid4().hex)
        with store.open_output_stream(file) as out:
            row = first
            while row is not None:
                line = row[self.column]
                if line is None or "\n" in line:
                    raise ValueError("a line must be a text without line ends")
                out.write(line.encode() + b"\n")
                row = next(iterator, None)
        return Pending(file)

    def commit(self, messages: list[Pending]) -> None:
        store, root, pending = self._pending()
        store.create_dir(root)
        old = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.is_file] if self.overwrite else []
        for i, m in enumerate(m for m in messages if m and m.file):
            store.move(m.file, posixpath.join(root, f"part-{self.run}-{i:05}.txt"))
        for file in old:
            store.delete_file(file)
        self._clean(store, pending)

    def abort(self, messages: list[Pending]) -> None:
        store, _, pending = self._pending()
        self._clean(store, pending)

    @staticmethod
    def _clean(store: fs.FileSystem, pending: str) -> None:
        if store.get_file_info(pending).type != fs.FileType.NotFound:
            store.delete_dir(pending)


def register(spark: SparkSession) -> None:
    for source in (ByteRanges, PublishedLines):
        spark.dataSource.register(source)
