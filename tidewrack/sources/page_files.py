"""S1 and S2 in the original's own layout, ``NNNN.json`` for each page, as a Python data
source: ``spark.read.format("page_files").load(folder)`` and ``df.write.format("page_files")``.

Rows are ``page long, body string``. *Reading*: the files named by four or more digits, some
``files_per_task`` together, so a feed of many small files is a few tasks; a file's page is
its name. *Writing*: a task writes its pages beside the final names, in a folder of the
write; the driver's commit moves them, which replaces older files of these pages and no
others. A failed write leaves no page file; ``abort`` removes its folder (a task that is
still being stopped may leave a file in it, which no reader looks at). One page given twice
in one write is an error.

The folder is any that ``pyarrow.fs`` reaches from every node (a shared mount, S3, HDFS ...).
A page's document passes through one task, as everywhere.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidewrack import schemas
from tidewrack.sources import pages as PG

SCHEMA = "page long, body string"
NAME = re.compile(r"^([0-9]{4,})\.json$")
FILES_PER_TASK = 256


def file_system(path: str):
    """``(file system, path in it)`` of a URI or a plain path."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub("^file:(//)?(?=/)", "", path)


def page_names(path: str) -> list[str]:
    from pyarrow import fs

    system, root = file_system(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.File and NAME.match(f.base_name))


@dataclass
class PageFilesPartition(InputPartition):
    names: tuple[str, ...]


class PageFilesReader(DataSourceReader):
    def __init__(self, path: str, per_task: int):
        self.path, self.per_task = path, per_task

    def partitions(self) -> list[PageFilesPartition]:
        names = page_names(self.path)
        return [PageFilesPartition(tuple(names[i : i + self.per_task])) for i in range(0, len(names), self.per_task)] or [PageFilesPartition(())]

    def read(self, partition: PageFilesPartition) -> Iterator[pa.RecordBatch]:
        system, root = file_system(self.path)
        for name in partition.names:
            with system.open_input_stream(f"{root}/{name}") as f:
                body = f.read().decode()
            yield pa.RecordBatch.from_arrays([pa.array([int(NAME.match(name)[1])], pa.int64()), pa.array([body], pa.string())], names=["page", "body"])


@dataclass
class PagesWritten(WriterCommitMessage):
    names: tuple[str, ...]


class PageFilesWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.attempt = f".writing-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> PagesWritten:
        from pyspark import TaskContext

        system, root = file_system(self.path)
        # A retried or speculative task writes files of its own.
        own = f"{self.attempt}/{TaskContext.get().taskAttemptId()}"
        system.create_dir(f"{root}/{own}", recursive=True)
        names = []
        for row in rows:
            names.append(f"{own}/{row['page']:04d}.json")
            with system.open_output_stream(f"{root}/{names[-1]}") as f:
                f.write(row["body"].encode())
        return PagesWritten(tuple(names))

    def commit(self, messages: list[PagesWritten | None]) -> None:
        system, root = file_system(self.path)
        names = [n for m in messages if m for n in m.names]
        pages = [n.rsplit("/", 1)[1] for n in names]
        if len(set(pages)) < len(pages):
            self.abort(messages)
            raise ValueError("a page is given more than once")
        old = set(page_names(self.path)) - set(pages) if self.overwrite else ()
        for name, page in zip(names, pages, strict=True):
            system.move(f"{root}/{name}", f"{root}/{page}")
        for page in old:
            system.delete_file(f"{root}/{page}")
        self._clean(system, root)

    def abort(self, messages: list[PagesWritten | None]) -> None:
        self._clean(*file_system(self.path))

    def _clean(self, system, root: str) -> None:
        from pyarrow import fs

        folder = f"{root}/{self.attempt}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class PageFiles(DataSource):
    """Options: ``path``; ``files_per_task`` for reading. Mode ``append`` replaces the pages
    that are given, ``overwrite`` removes all others as well."""

    @classmethod
    def name(cls) -> str:
        return "page_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PageFilesReader:
        return PageFilesReader(self.options["path"].rstrip("/"), int(self.options.get("files_per_task", FILES_PER_TASK)))

    def writer(self, schema: StructType, overwrite: bool) -> PageFilesWriter:
        return PageFilesWriter(self.options["path"].rstrip("/"), overwrite)


def write_page_files(pages: DataFrame, path: str, overwrite: bool = False) -> None:
    """``pages(page, body)`` as files ``NNNN.json``."""
    pages.sparkSession.dataSource.register(PageFiles)
    pages.select(F.col("page").cast("long").alias("page"), "body").write.format("page_files").mode("overwrite" if overwrite else "append").save(path)


def read_page_files(spark: SparkSession, path: str, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    spark.dataSource.register(PageFiles)
    return spark.read.format("page_files").option("files_per_task", files_per_task).load(path)


def scan_page_files(spark: SparkSession, path: str, total_pages: int | None = None) -> DataFrame:
    """The items of pages 1..N in (page, position) order columns; a missing page raises,
    and so does a document that is no page."""
    parsed = read_page_files(spark, path).select(F.from_json("body", StructType(schemas.PAGE.fields), {"mode": "FAILFAST"}).alias("p"), "page").select("p.*", "page")
    PG.check_complete(parsed, total_pages)
    if total_pages is not None:
        parsed = parsed.where(F.col("meta.page").between(1, int(total_pages)))
    return PG.page_items(parsed.drop("page"))
