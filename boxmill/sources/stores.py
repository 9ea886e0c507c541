"""Folders and single files of any store that pyarrow knows, as Spark data sources.

`folder_pages` reads the entries of folders, a partition a folder, in frames of bounded
size. `label_texts` writes one text file per row; tasks write under temporary names, and
only a job that has ended well moves them to their places.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..scratch import materialise

#: Names in a frame.
PAGE = 10_000
#: Bytes that a lazily read file takes at a time.
STEP = 1024
#: Folders of writers that are at work, and of files that nobody wants to see.
HIDDEN = ("_temporary", ".")
SCHEMES = ("", "file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def scheme_of(path: str) -> str:
    head, _, _ = path.partition(":")
    return head.lower() if ":" in path and head.isidentifier() else ""


def is_known(path: str) -> bool:
    """Whether tasks can open the path by themselves; Spark's own readers know others as well."""
    return scheme_of(path) in SCHEMES


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, its path) of a path with or without a scheme."""
    if not scheme_of(path):
        return fs.LocalFileSystem(), path
    if scheme_of(path) == "file":
        return fs.LocalFileSystem(), "/" + path.split(":", 1)[1].lstrip("/")
    return fs.FileSystem.from_uri("s3" + path[3:] if path.startswith("s3a:") else path)


def entries_of(folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, is a folder, length) of a folder's entries, one after another."""
    system, base = file_system(folder)
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(base) as found:
            for x in found:
                is_folder = x.is_dir()
                try:
                    yield x.name, is_folder, 0 if is_folder else x.stat().st_size
                except FileNotFoundError:  # gone meanwhile, or a link to nothing
                    continue
        return
    # pyarrow has no listing in pages, so the names of one folder of another store are in the task at once.
    for x in system.get_file_info(fs.FileSelector(base)):
        yield x.base_name, x.type == fs.FileType.Directory, x.size or 0


def pages_of(folder: str, size: int, entries: Callable[[str], Iterator[tuple[str, bool, int]]] = entries_of) -> Iterator[pa.RecordBatch]:
    """path, folder, length of a folder's entries in frames of `size`; hidden folders are left out."""
    prefix, page = folder.rstrip("/"), []

    def frame() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*page, strict=True)] or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.int64())], names=["path", "folder", "length"])

    for name, is_folder, length in entries(folder):
        if is_folder and name.startswith(HIDDEN):
            continue
        page.append((f"{prefix}/{name}", is_folder, length))
        if len(page) == size:
            yield frame()
            page = []
    if page:
        yield frame()


class FolderPages(DataSource):
    """Options: folders (a JSON list), page (names in a frame)."""

    @classmethod
    def name(cls) -> str:
        return "folder_pages"

    def schema(self) -> str:
        return "path string, folder boolean, length long"

    def reader(self, schema) -> DataSourceReader:
        return FolderReader(json.loads(self.options["folders"]), int(self.options.get("page", PAGE)))


class FolderReader(DataSourceReader):
    def __init__(self, folders: list[str], page: int):
        self.folders, self.page = folders, page

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.folders]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from pages_of(partition.value, self.page)


def files_under(spark: SparkSession, root: str) -> DataFrame:
    """path, length of all files under root, empty ones too, as a written table.

    Folders are listed by tasks, each once, level by level; only the names of folders
    reach the driver.
    """
    spark.dataSource.register(FolderPages)
    out, level = None, [root]
    while level:
        found = materialise(spark.read.format("folder_pages").option("folders", json.dumps(level)).load())
        files = found.filter("not folder").select("path", "length")
        out = files if out is None else out.unionByName(files)
        level = [r.path for r in found.filter("folder").select("path").collect()]
    return out


def spread(files: DataFrame, per_task: int = 10_000) -> DataFrame:
    """files dealt out anew, for they come in as many partitions as there are folders."""
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // per_task))
    return files.repartition(tasks, "path")


class LazyFile:
    """The bytes of an open file by index and slice, of which only those near the asked ones are read.

    file: has read_at(count, offset). Steps that were read are kept.
    """

    def __init__(self, file, length: int):
        self.file, self.length, self.steps = file, length, {}

    def __len__(self) -> int:
        return self.length

    def _step(self, k: int) -> bytes:
        if k not in self.steps:
            self.steps[k] = self.file.read_at(min(STEP, self.length - k * STEP), k * STEP)
        return self.steps[k]

    def __getitem__(self, at: int | slice) -> int | bytes:
        if isinstance(at, int):
            if not 0 <= at < self.length:
                raise IndexError(at)
            return self._step(at // STEP)[at % STEP]
        low, high, _ = at.indices(self.length)
        if low >= high:
            return b""
        first = low // STEP
        held = b"".join(self._step(k) for k in range(first, (high - 1) // STEP + 1))
        return held[low - first * STEP : high - first * STEP]


# ---- texts ----------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    """What a task leaves: its own temporary folder."""

    folder: str


class LabelTexts(DataSource):
    """Rows (split, stem, content) as files <path>/<split>/<stem>.txt, or <path>/<stem>.txt for a null split."""

    @classmethod
    def name(cls) -> str:
        return "label_texts"

    def schema(self) -> str:
        return "split string, stem string, content string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return LabelWriter(self.options["path"].rstrip("/"))


class LabelWriter(DataSourceWriter):
    """Each attempt of a task writes into a folder of its own below path/_temporary-<job>.

    commit() moves the files of the attempts that Spark has accepted, so files of failed
    or doubled attempts are never seen; abort() removes all. Files that are there already
    are replaced. A move is one request a file, many at a time.
    """

    def __init__(self, path: str):
        self.path, self.held = path, f"{path}/_temporary-{uuid.uuid4().hex}"
        system, held = file_system(self.held)
        system.create_dir(held, recursive=True)

    def write(self, rows: Iterator) -> Written:
        folder = f"{self.held}/{uuid.uuid4().hex}"
        system, base = file_system(folder)
        system.create_dir(base, recursive=False)  # an error where a failed job has been cleared already
        made = {base}
        for split, stem, content in rows:
            under = f"{base}/{split}" if split else base
            if under not in made:
                system.create_dir(under, recursive=False)
                made.add(under)
            with system.open_output_stream(f"{under}/{stem}.txt") as out:
                out.write((content + ("\n" if content else "")).encode())
        return Written(folder)

    def commit(self, messages: list[Written | None]) -> None:
        system, target = file_system(self.path)
        with ThreadPoolExecutor(32) as pool:
            for message in filter(None, messages):
                _, base = file_system(message.folder)
                found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
                for x in found:
                    if x.type == fs.FileType.Directory:
                        system.create_dir(target + x.path[len(base) :], recursive=True)
                # Moves of a file whose place is taken replace it.
                list(pool.map(lambda x: system.move(x.path, target + x.path[len(base) :]), [x for x in found if x.type == fs.FileType.File]))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        system, held = file_system(self.held)
        if system.get_file_info(held).type == fs.FileType.Directory:
            system.delete_dir(held)
