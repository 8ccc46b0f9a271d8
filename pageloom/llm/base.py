"""Helpers the operators share: workers, scratch folders, text columns."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from pageloom.session import pin_utc, shared_dir, ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    pin_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and all executors can reach."""
    return f"{shared_dir(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and lost executors lose nothing of it."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> None:
    """Arrow batches of 512 rows instead of 10,000: whole texts pass through the workers, and each batch is held several times."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


_STATE: dict[tuple, object] = {}


def forget_state() -> None:
    """Drop what an operator keeps in this worker process, and give the memory back to the system."""
    if _STATE:
        _STATE.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not glibc
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker_state(key: tuple, make: Callable[[], object]):
    """What an operator keeps from task to task in a worker process. There is room for one: a worker lives on when the next stage begins, and
    the state of the stage before goes."""
    if key not in _STATE:
        forget_state()
        _STATE[key] = make()
    return _STATE[key]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def id_and_text(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names; other columns never meet the operator's own names."""
    small_batches(df)
    return df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def per_text(
    df: DataFrame, make: Callable[[], Callable[[list[int | None], list[str | None]], dict]], schema: str, rows: int = 256
) -> DataFrame:
    """Run `make()(ids, texts) -> columns` over slices of (doc_id, text) rows in the workers.

    `make` is called once for each task. Slices hold at most `rows` texts, so memory follows the texts of
    one slice and not the task's input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, names = make(), None
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = step(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
                names = names or list(out)
                yield pa.RecordBatch.from_pydict(out)

    return df.select("doc_id", "text").mapInArrow(run, schema)


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Of a path or address, as all executors reach it."""
    return pa.fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def put(fs: pa.fs.FileSystem, path: str, parts: list, attempt: str) -> None:
    """Write under a name of this attempt, then give it its own name: a repeated task replaces the file by an equal one."""
    with fs.open_output_stream(f"{path}.{attempt}") as out:
        for part in parts:
            out.write(part)
    fs.move(f"{path}.{attempt}", path)
