"""A store of gzipped pages as a Spark data source: batch reads with pruned folders, streams of committed loads, writes with commit and abort.

`{root}/{project}/{domain}/{date}/{md5 of url}.html.gz` holds the pages. `{root}/_loads/` holds, for each load, the keys each task wrote, and once
the load is committed a marker; a load without a marker never was.

    spark.dataSource.register(PageStore)
    spark.read.format("pagestore").load(root).filter("domain = 'a.example'")
"""

from __future__ import annotations

import gzip
import hashlib
import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage,
)

from pageloom.operators.scans import first_per_key

# the processes that plan reads and writes do not see files added to the session
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "project string, domain string, date string, url_md5 string, html string"
WRITE_SCHEMA = "project string, url string, date string, html string"
LOADS = "_loads"
HEX = "0123456789abcdef"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Of a path or address that the driver and all executors reach."""
    fs, path = pa.fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")
    return fs, path.rstrip("/")


def folders(fs: pa.fs.FileSystem, path: str) -> list[str]:
    found = fs.get_file_info(pa.fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == pa.fs.FileType.Directory and not f.base_name.startswith("_"))


def put(fs: pa.fs.FileSystem, path: str, data: bytes) -> None:
    """The whole file under its name, or nothing; a file of that name is replaced."""
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(draft, compression=None) as out:
        out.write(data)
    fs.move(draft, path)


def key_of(project: str, url: str, date: str) -> str:
    domain = urlsplit(url).netloc.lower().removeprefix("www.") or "unknown"
    return f"{project}/{domain}/{date}/{hashlib.md5(url.encode()).hexdigest()}.html.gz"


def page_of(fs: pa.fs.FileSystem, root: str, key: str) -> tuple[str, str, str, str, str]:
    project, domain, date, name = key.split("/")
    with fs.open_input_stream(f"{root}/{key}", compression=None) as f:
        return project, domain, date, name.split(".")[0], gzip.decompress(f.read()).decode("utf-8", "replace")


def batches(rows: Iterator[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pages as Arrow batches of about eight million characters, so that memory does not follow the number of pages."""
    names = ["project", "domain", "date", "url_md5", "html"]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4])
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], names=names)


@dataclass
class Pages(InputPartition):
    """The pages of one folder whose names begin with `prefix`."""

    folder: str
    prefix: str


@dataclass
class Written(InputPartition):
    """The pages one task of a load wrote."""

    journal: str


class PageReader(DataSourceReader):
    """Folders are listed on the driver, pages by the tasks; equality filters on project, domain and date prune folders."""

    def __init__(self, root: str, splits: int):
        self.root, self.splits, self.wanted = root, splits, {}

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            names = f.attribute if isinstance(f, (EqualTo, In)) else ()
            if len(names) == 1 and names[0] in ("project", "domain", "date"):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[names[0]] = self.wanted.get(names[0], values) & values
            else:
                yield f

    def _some(self, fs, path: str, column: str) -> list[str]:
        return [n for n in folders(fs, path) if column not in self.wanted or n in self.wanted[column]]

    def partitions(self) -> list[InputPartition]:
        fs, root = file_system(self.root)
        prefixes = [""]
        while len(prefixes) < self.splits:
            prefixes = [p + c for p in prefixes for c in HEX]
        return [
            Pages(f"{p}/{d}/{day}", prefix) for p in self._some(fs, root, "project") for d in self._some(fs, f"{root}/{p}", "domain")
            for day in self._some(fs, f"{root}/{p}/{d}", "date") for prefix in prefixes]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(self.root)
        if not isinstance(partition, Pages):
            return
        files = fs.get_file_info(pa.fs.FileSelector(f"{root}/{partition.folder}"))
        names = sorted(f.base_name for f in files if f.base_name.endswith(".html.gz") and f.base_name.startswith(partition.prefix))
        yield from batches(page_of(fs, root, f"{partition.folder}/{n}") for n in names)


class LoadReader(DataSourceStreamReader):
    """Committed loads in the order of their commits: an offset is the name of the last marker read."""

    def __init__(self, root: str):
        self.root = root

    def _markers(self) -> list[str]:
        fs, root = file_system(self.root)
        found = fs.get_file_info(pa.fs.FileSelector(f"{root}/{LOADS}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def initialOffset(self) -> dict:
        return {"marker": ""}

    def latestOffset(self) -> dict:
        return {"marker": max(self._markers(), default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        fs, root = file_system(self.root)
        out: list[InputPartition] = []
        for name in self._markers():
            if start["marker"] < name <= end["marker"]:
                with fs.open_input_stream(f"{root}/{LOADS}/{name}") as f:
                    out += [Written(j) for j in json.loads(f.read())["journals"]]
        return out

    def read(self, partition: Written) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(self.root)
        with fs.open_input_stream(f"{root}/{LOADS}/{partition.journal}") as f:
            keys = f.read().decode().split("\n")
        yield from batches(page_of(fs, root, k[1:]) for k in keys if k)

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Journal(WriterCommitMessage):
    name: str
    pages: int


class PageWriter(DataSourceWriter):
    """Each task writes pages under their names, one rename each, and a journal of them; the commit names the journals.

    A task that runs twice writes the same pages again. The journal marks pages that were not there before; an aborted load removes these.
    """

    def __init__(self, root: str):
        self.root, self.load = root, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        fs, root = file_system(self.root)
        context = TaskContext.get()
        name = f"{self.load}/part-{context.partitionId():06d}-{context.taskAttemptId()}.txt"
        fs.create_dir(f"{root}/{LOADS}/{self.load}", recursive=True)
        pages, made = 0, set()
        # the journal goes ahead of the pages it names, so that an abort finds all of them
        with fs.open_output_stream(f"{root}/{LOADS}/{name}") as journal:
            for row in iterator:
                if row.url is None or row.project is None or row.date is None:
                    raise ValueError("a page needs project, url and date")
                key = key_of(row.project, row.url, row.date)
                there = fs.get_file_info(f"{root}/{key}").type == pa.fs.FileType.File
                journal.write(f"{'=' if there else '+'}{key}\n".encode())
                journal.flush()
                folder = key.rsplit("/", 1)[0]
                if folder not in made:
                    fs.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                put(fs, f"{root}/{key}", gzip.compress((row.html or "").encode("utf-8", "replace"), mtime=0))
                pages += 1
        return Journal(name, pages)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.root)
        done = [m for m in messages if m is not None]
        marker = {"load": self.load, "pages": sum(m.pages for m in done), "journals": [m.name for m in done if m.pages]}
        put(fs, f"{root}/{LOADS}/{time.time_ns():020d}-{self.load}.json", json.dumps(marker).encode())

    def abort(self, messages: list) -> None:
        fs, root = file_system(self.root)
        for f in fs.get_file_info(pa.fs.FileSelector(f"{root}/{LOADS}/{self.load}", allow_not_found=True)):
            with fs.open_input_stream(f.path) as journal:
                for line in journal.read().decode().split("\n"):
                    if line.startswith("+") and fs.get_file_info(f"{root}/{line[1:]}").type == pa.fs.FileType.File:
                        fs.delete_file(f"{root}/{line[1:]}")
            fs.delete_file(f.path)


class PageStore(DataSource):
    """Options: `splits`, how many parts (1, 16, 256 …) each folder is read in; a hot domain needs more than one."""

    @classmethod
    def name(cls) -> str:
        return "pagestore"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options["path"], int(self.options.get("splits", "1")))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LoadReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a page store is appended to")
        return PageWriter(self.options["path"])


PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def register(spark) -> None:
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(PageStore)


def write_page_store(pages: DataFrame, root: str) -> None:
    """`pages`: project, url, fetched_at, html. Of a URL fetched twice on a day the last fetch counts.

    The choice and the clustering by folder use the URL's hash, so a hot domain is spread over all tasks.
    """
    register(pages.sparkSession)
    rows = pages.select("project", "url", F.date_format("fetched_at", "yyyy-MM-dd").alias("date"), "fetched_at", "html")
    last = first_per_key(rows, ["project", "url", "date"], ["fetched_at", "html"], last=True)
    last.select("project", "url", "date", "html").write.format("pagestore").mode("append").save(root)
