"""A data source of files, names that begin with a dot among them, read by directory and written by path."""

from __future__ import annotations

import posixpath
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "tidemark_files"
SCHEMA = "path string, content binary, length bigint"
#: Directories that planning lists at most; what lies deeper is listed by the tasks.
PLANNED_DIRECTORIES = 1_000
#: Directories that planning hands on without having listed them; those of a directory that has more come by parts of its names.
HELD_DIRECTORIES = 100_000
#: Files that a partition reads at least, more or less, of directories that planning has listed.
FILES_A_PARTITION = 200
#: Directories beyond those that one task walks at least.
WALKED_TOGETHER = 16
#: Partitions of either kind, more or less, where the session has no more than a quarter as many cores. A task takes as long to start as to read some 600 small files.
PARTITIONS = 64
BATCH_BYTES = 16 * 2**20

# Executors need no copy of the package for this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _opened(url: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(url) if ":" in url else (fs.LocalFileSystem(), url)


def _listed(store, directory: str, skip: frozenset[str]) -> tuple[list, list[str]]:
    """Files and directories right in a directory, sorted by name; a directory that cannot be listed has none."""
    from pyarrow import fs

    try:
        found = sorted(store.get_file_info(fs.FileSelector(directory)), key=lambda f: f.path)
    except OSError:
        return [], []
    files = [f for f in found if f.type == fs.FileType.File]
    return files, [f.path for f in found if f.type == fs.FileType.Directory and posixpath.basename(f.path) not in skip]


@dataclass
class Directory:
    """What one directory holds whose names' hashes leave ``part`` of ``parts``: its files and, with ``below``, all that lies in its directories too; without ``own``, in these only."""

    at: str
    below: bool = False
    part: int = 0
    parts: int = 1
    own: bool = True

    def has(self, path: str) -> bool:
        return self.parts == 1 or zlib.crc32(posixpath.basename(path).encode()) % self.parts == self.part


@dataclass
class Directories(InputPartition):
    """What one task reads."""

    of: list[Directory]


class FilesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.max_bytes, self.tasks = options["path"], int(options.get("maxbytes", "0")), int(options.get("partitions", PARTITIONS))
        self.skip = frozenset(x for x in options.get("skip", ".git").split(",") if x)

    def partitions(self) -> list[Directories]:
        """Breadth first, down to PLANNED_DIRECTORIES: small directories are read together, a large one by parts of its names; those left are walked by tasks.

        More files and directories make partitions larger, not more: what is left is dealt in turn, so that each walks as much of every level.
        """
        store, root = _opened(self.url)
        level, listed, left, wide = [root], [], [], []
        while level:
            below = []
            for directory in level:
                if len(listed) == PLANNED_DIRECTORIES:
                    left.append(Directory(directory, below=True))
                    continue
                files, found = _listed(store, directory, self.skip)
                listed.append((directory, len(files)))
                if len(below) + len(found) > HELD_DIRECTORIES:
                    wide.append(directory)
                else:
                    below += found
            level = below
        most = -(-sum(n for _, n in listed) // self.tasks)
        out, few, n_few, most = [], [], 0, max(most, FILES_A_PARTITION)
        for directory, n in listed:
            parts = -(-n // most)
            if parts > 1:
                out += [Directories([Directory(directory, False, i, parts)]) for i in range(parts)]
                continue
            few, n_few = [*few, Directory(directory)], n_few + n
            if n_few >= most:
                out, few, n_few = [*out, Directories(few)], [], 0
        walks = self.tasks if wide else min(self.tasks, -(-len(left) // WALKED_TOGETHER))
        return [*out, Directories(few), *(Directories(left[i::walks] + [Directory(w, True, i, walks, own=False) for w in wide]) for i in range(walks))]

    def _content(self, store, file) -> bytes | None:
        if self.max_bytes and file.size > self.max_bytes:
            return None
        try:
            with store.open_input_stream(file.path) as f:
                return f.read()
        except OSError:
            return None

    def _files(self, store, partition: Directories) -> Iterator:
        rest = [*partition.of]
        while rest:
            directory = rest.pop()
            files, found = _listed(store, directory.at, self.skip)
            rest += [Directory(f, below=True) for f in found if directory.has(f)] if directory.below else []
            yield from (f for f in files if directory.own and directory.has(f.path))

    def read(self, partition: Directories) -> Iterator[pa.RecordBatch]:
        store, root = _opened(self.url)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            path, content, length = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(content, pa.binary()), pa.array(length, pa.int64())], ["path", "content", "length"])

        for f in self._files(store, partition):
            content = self._content(store, f)
            rows.append((posixpath.relpath(f.path, root), content, f.size))
            size += len(content or b"") + len(f.path)
            if size >= BATCH_BYTES:
                yield batch()
                rows, size = [], 0
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    paths: int


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.url = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """A file a row. Another attempt of a task writes the same files with the same contents."""
        store, root = _opened(self.url)
        n, there = 0, set()
        for path, content in (row for batch in iterator for row in zip(batch.column("path"), batch.column("content"), strict=True)):
            at = posixpath.normpath(posixpath.join(root, path.as_py()))
            if not at.startswith(root.rstrip("/") + "/"):
                raise ValueError("a path leads out of the folder that is written")
            if (folder := posixpath.dirname(at)) not in there:
                store.create_dir(folder, recursive=True)
                there.add(folder)
            with store.open_output_stream(at) as f:
                f.write(content.as_py() or b"")
            n += 1
        return Written(n)


class Files(DataSource):
    """Files below the folder ``path``. Options: ``maxBytes``, above which contents are not read (null, their length known); ``skip``, names of directories left out; ``partitions``, how many to read by, more or less."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema: StructType) -> FilesReader:
        return FilesReader(self._options())

    def writer(self, schema: StructType, overwrite: bool) -> FilesWriter:
        return FilesWriter(self._options())


def read_files(spark: SparkSession, path: str, max_bytes: int | None = None, skip: tuple[str, ...] = (".git",)) -> DataFrame:
    """``(path, content, length)`` of all files below a folder that driver and executors share, by relative path; no name is hidden.

    Planning lists up to PLANNED_DIRECTORIES directories, and tasks the rest, four a core or PARTITIONS; a large directory is read by several tasks. A file that cannot be read has null
    content. Of files over ``max_bytes`` only the length is taken. Links that lead to no file are left out. An empty folder gives no rows.
    """
    spark.dataSource.register(Files)
    tasks = max(PARTITIONS, 4 * spark.sparkContext.defaultParallelism)
    reader = spark.read.format(FORMAT).option("skip", ",".join(skip)).option("partitions", str(tasks))
    return (reader if max_bytes is None else reader.option("maxBytes", str(max_bytes))).load(path)


def write_files(df: DataFrame, path: str) -> None:
    """Writes ``df (path, content)`` as files below a folder; null content makes an empty file. Paths are unique, relative, and stay inside."""
    df.sparkSession.dataSource.register(Files)
    df.select("path", "content").write.format(FORMAT).mode("append").save(path)
