"""Keyed state in hash buckets: a batch rewrites only the buckets it touches, readers see one snapshot."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

BUCKET = "bucket"


class Folder:
    """Small files under a path, through the cluster's own file system; driver only."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """The whole file under its name, or nothing; False if the name is taken. A rename does not replace a file."""
        draft = f"_drafts/{uuid.uuid4().hex}"
        out = self.fs.create(self._path(draft))
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self._path(name)):
            return False
        self.fs.mkdirs(self._path(name).getParent())
        return self.fs.rename(self._path(draft), self._path(name))

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class StateTable:
    """One row for each key (a NULL key is a key of its own), in `buckets` folders by hash.

    `snapshots/` holds a small file for each version: the folder of every bucket and the batches it holds. A merge writes new folders for the
    touched buckets, then publishes the next snapshot: until then readers see the old one, and a merge that fails leaves it as it is.
    Two merges at a time: the one that publishes later fails. A batch number counts once, so a replayed batch changes nothing.
    The number of files on the driver is that of the buckets, not of rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, key: str | Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key = spark, path.rstrip("/"), [key] if isinstance(key, str) else list(key)
        self.schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.folder = Folder(spark, path)
        latest = self.snapshot()
        self.buckets = latest.get("of", buckets)

    def snapshot(self) -> dict:
        names = [n for n in self.folder.names("snapshots") if n.endswith(".json")]
        return json.loads(self.folder.read(f"snapshots/{names[-1]}")) if names else {"version": 0, "batches": [], "buckets": {}}

    def bucket(self) -> Column:
        return F.pmod(F.hash(*self.key), F.lit(self.buckets)).alias(BUCKET)

    def _rows(self, snapshot: dict, wanted: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/{p}" for b, p in snapshot["buckets"].items() if wanted is None or int(b) in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """All rows of the latest snapshot."""
        return self._rows(self.snapshot())

    def holds(self, batch: int | str) -> bool:
        return str(batch) in self.snapshot()["batches"]

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of a batch's keys: as many numbers as there are buckets at most."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The rows of the buckets that `rows` touches."""
        return self._rows(self.snapshot(), self.touched(rows))

    def merge(self, rows: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame], batch: int | str) -> bool:
        """Replace the touched buckets by `step(their state, rows)`; False if the batch was merged before.

        `step` returns rows of the table's schema whose keys come from its two inputs. The last thousand batch names are remembered.
        """
        before = self.snapshot()
        if str(batch) in before["batches"]:
            return False
        version, wanted = before["version"] + 1, self.touched(rows)
        data = f"data/{version:010d}-{uuid.uuid4().hex}"
        after = step(self._rows(before, wanted), rows).select(*self.schema.names, self.bucket())
        after.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{data}")
        held = {n.split("=")[1]: f"{data}/{n}" for n in self.folder.names(data) if n.startswith(f"{BUCKET}=")}
        stray = set(map(int, held)) - set(wanted)
        if stray:
            raise ValueError(f"the step gave keys of buckets {sorted(stray)}, which its rows do not touch")
        kept = {b: p for b, p in before["buckets"].items() if int(b) not in wanted}
        text = json.dumps({"version": version, "of": self.buckets, "batches": [*before["batches"], str(batch)][-1000:], "buckets": kept | held})
        if not self.folder.publish(f"snapshots/{version:010d}.json", text):
            raise RuntimeError(f"another merge has published version {version}")
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove folders that none of the last `keep` snapshots names, and older snapshots; returns what went.

        Call it when no merge is running. Readers of the kept snapshots are not disturbed.
        """
        names = [n for n in self.folder.names("snapshots") if n.endswith(".json")]
        used = {p for n in names[-keep:] for p in json.loads(self.folder.read(f"snapshots/{n}"))["buckets"].values()}
        gone = [f"{top}/{d}" if top else d for top in ("data",) for d in self.folder.names(top) if not any(u.startswith(f"{top}/{d}/") for u in used)]
        for data in self.folder.names("data"):
            if f"data/{data}" not in gone:
                gone += [f"data/{data}/{b}" for b in self.folder.names(f"data/{data}") if b.startswith(f"{BUCKET}=") and f"data/{data}/{b}" not in used]
        gone += [f"snapshots/{n}" for n in names[:-keep]]
        for name in gone:
            self.folder.remove(name)
        return gone
