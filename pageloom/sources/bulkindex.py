"""An index sink with a commit protocol: bulk requests with back-off, rejects that come back, batches that count once.

Tasks send documents in requests and keep what is refused in a file of their own; the commit of a batch names those files. A batch that has a
commit is not sent again, and a task that runs again sends the same documents under the same keys.

    sink = bulk_index(client)
    spark.dataSource.register(sink)
    docs.write.format("bulkindex").mode("append").option("batch", "7").save(path)
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from pageloom.operators.scans import first_per_key
from pageloom.sources import pagestore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Documents of a request, tries of a request.
CHUNK = 500
TRIES = 3
DOC = "index string, doc_id string, doc string"
REJECT = f"{DOC}, error string"

Send = Callable[[list[dict]], dict[str, str]]  # documents of a request to errors by doc_id; may raise


class FileClient:
    """A store of documents as lines in files, which stands for a search server: upsert by key, last batch first read."""

    def __init__(self, path: str, batch: str, task: str):
        self.fs, root = pagestore.file_system(path)
        self.fs.create_dir(f"{root}/docs/batch={batch}", recursive=True)
        self.name, self.requests = f"{root}/docs/batch={batch}/{task}", 0

    def __call__(self, docs: list[dict]) -> dict[str, str]:
        self.requests += 1
        lines = "".join(json.dumps(d, ensure_ascii=False) + "\n" for d in docs)
        pagestore.put(self.fs, f"{self.name}-{self.requests:06d}.jsonl", lines.encode())
        return {}


@dataclass
class Sent(WriterCommitMessage):
    sent: int
    rejects: int
    name: str


class Requests:
    """Sends rows of index, doc_id, doc in requests."""

    def __init__(self, connect: Callable[[str, str, str], Send], path: str, options: dict):
        self.connect, self.path = connect, path
        self.chunk, self.tries, self.wait = int(options.get("chunk", CHUNK)), int(options.get("tries", TRIES)), float(options.get("wait", 1.0))

    def committed(self, batch: str) -> bool:
        fs, root = pagestore.file_system(self.path)
        return fs.get_file_info(f"{root}/commits/{batch}.json").type == pa.fs.FileType.File

    def _request(self, send: Send, docs: list[dict]) -> dict[str, str]:
        """Errors by doc_id; a request that raises is tried again after 1, 2, 4 … times `wait` seconds, then refused as a whole."""
        for attempt in range(self.tries):
            try:
                return send(docs)
            except Exception as exc:
                error = f"{type(exc).__name__}: {exc}"
                if attempt + 1 < self.tries:
                    time.sleep(self.wait * 2 ** attempt)
        return {d["doc_id"]: error for d in docs}

    def run(self, rows: Iterator, batch: str) -> WriterCommitMessage:
        if self.committed(batch):
            return Sent(0, 0, "")
        context = TaskContext.get()
        # the number of a task, not of its attempt: an attempt replaces what one before it sent
        task, attempt = f"part-{context.partitionId():06d}", context.taskAttemptId()
        send, (fs, root) = self.connect(self.path, batch, task), pagestore.file_system(self.path)
        fs.create_dir(f"{root}/rejects/batch={batch}", recursive=True)
        name, sent, refused, held = f"batch={batch}/{task}-{attempt}.jsonl", 0, 0, []
        with fs.open_output_stream(f"{root}/rejects/{name}") as out:
            def flush() -> None:
                nonlocal sent, refused
                errors = self._request(send, held) if held else {}
                for doc in held:
                    if doc["doc_id"] in errors:
                        out.write((json.dumps(doc | {"error": errors[doc["doc_id"]]}, ensure_ascii=False) + "\n").encode())
                        refused += 1
                sent += len(held)
                held.clear()

            for row in rows:
                doc = {"index": row["index"], "doc_id": row["doc_id"], "doc": row["doc"]}
                if not doc["doc_id"]:
                    out.write((json.dumps(doc | {"error": "no uniq_id"}, ensure_ascii=False) + "\n").encode())
                    refused += 1
                    continue
                held.append(doc)
                if len(held) >= self.chunk:
                    flush()
            flush()
        return Sent(sent - refused, refused, name)

    def commit(self, messages: list, batch: str) -> None:
        """Names the reject files: one short name for each task goes through the driver, not the rejects."""
        if self.committed(batch):
            return
        fs, root = pagestore.file_system(self.path)
        done = [m for m in messages if m is not None]
        fs.create_dir(f"{root}/commits", recursive=True)
        pagestore.put(fs, f"{root}/commits/{batch}.json", json.dumps({
            "batch": batch, "sent": sum(m.sent for m in done), "rejects": sum(m.rejects for m in done), "files": [m.name for m in done if m.rejects]}).encode())


class BatchWriter(DataSourceWriter):
    def __init__(self, requests: Requests, batch: str):
        self.requests, self.batch = requests, batch

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        return self.requests.run(iterator, self.batch)

    def commit(self, messages: list) -> None:
        self.requests.commit(messages, self.batch)

    def abort(self, messages: list) -> None:
        """Nothing to undo: what was sent is replaced when the batch is sent again, and has no commit until then."""


def bulk_index(connect: Callable[[str, str, str], Send] = FileClient) -> type[DataSource]:
    """The data source `bulkindex` over a client: `connect(path, batch, task)` gives a function that sends one request.

    Options: chunk (500), tries (3), wait (seconds before the second try, doubled each time), batch (its name; without one, a new one).
    """

    class BulkIndex(DataSource):
        @classmethod
        def name(cls) -> str:
            return "bulkindex"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return BatchWriter(Requests(connect, self.options["path"], self.options), self.options.get("batch") or uuid.uuid4().hex)

    return BulkIndex


def load_stream(docs: DataFrame, path: str, purpose: str = "bulk-index", **options) -> None:
    """Progressive load of all input there is: a micro-batch is a batch of the sink, so a replayed one is not sent again."""
    from pageloom.streaming.streams import run_batches

    def save(batch: DataFrame, batch_id: int, out: str) -> None:
        batch.write.format("bulkindex").mode("append").options(**options).option("batch", f"{batch_id:012d}").save(path)

    run_batches(docs, purpose, save)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """batch, sent, rejects and the files of the rejects, of every committed batch."""
    return spark.read.schema("batch string, sent long, rejects long, files array<string>").json(f"{path}/commits")


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """Documents that committed batches did not take, with the error; what attempts left that did not count is not read."""
    named = commits(spark, path).select("batch", F.explode("files").alias("file"))
    rows = spark.read.schema(REJECT).json(f"{path}/rejects/*", pathGlobFilter="*.jsonl").select(
        "*", F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+)$", 1).alias("file"))
    return rows.join(named, "file").drop("file")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """What the file client holds: one document for each key, of the batch that comes last by name."""
    lines = spark.read.schema(f"{DOC}, batch string").json(f"{path}/docs")
    return first_per_key(lines, ["doc_id"], ["batch", "doc"], last=True)
