"""Structured Streaming forms of the page and run operators.

State is bounded by a watermark or a TTL everywhere; sinks are files with a
checkpoint in the shared folder, so a restart neither loses nor repeats rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pageloom.functions import classify as C
from pageloom.session import new_folder
from pageloom.sources.records import index_docs, split_unkeyed

# Consumption window and expiry times.
MIN_WINDOW = 20
CHANGE_TTL_DAYS = 30
RUN_TTL_H = 12
HEARTBEAT_S = 90
DLQ_TTL_H = 24


def stream_table(spark: SparkSession, path: str, schema, max_files: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_pages(spark: SparkSession, path: str, schema, workers: int = 8, pattern: str = "*.parquet") -> DataFrame:
    """Page files in windows of max(2 x workers, 20) files."""
    return stream_table(spark, path, schema, max(2 * workers, MIN_WINDOW), pattern)


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _run(writer, spark: SparkSession, idle_batches: bool):
    """Start, and wait for the end of the input.

    Keyed state with a TTL asks for another batch for ever, so a run to the end
    of the input goes without idle batches; windows need them to close.
    """
    before = spark.conf.get(IDLE_BATCHES)
    spark.conf.set(IDLE_BATCHES, str(idle_batches).lower())
    try:
        query = writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(IDLE_BATCHES, before)
    query.awaitTermination()
    return query


def drain(df: DataFrame, purpose: str, idle_batches: bool = True) -> DataFrame:
    """Process all input there is, in micro-batches, into an append-only file table and read it back."""
    spark = df.sparkSession
    out = new_folder(spark, purpose)
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint")
    )
    _run(writer, spark, idle_batches)
    return spark.read.schema(df.schema).parquet(f"{out}/data")


def run_batches(df: DataFrame, purpose: str, handle: Callable[[DataFrame, int, str], None], mode: str = "append",
                idle_batches: bool = True) -> str:
    """Process all input there is, giving each micro-batch to `handle(batch, batch_id, folder)`."""
    out = new_folder(df.sparkSession, purpose)
    writer = (
        df.writeStream.outputMode(mode).option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(lambda batch, batch_id: handle(batch, batch_id, out))
    )
    _run(writer, df.sparkSession, idle_batches)
    return out


def latest_updates(df: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """Run an update-mode stream; the newest output row of each key is the table."""
    from pageloom.operators.scans import first_per_key

    def save(batch: DataFrame, batch_id: int, out: str) -> None:
        # a replayed batch overwrites its own folder
        batch.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    out = run_batches(df, purpose, save, "update")
    saved = df.sparkSession.read.parquet(f"{out}/data")
    return first_per_key(saved, keys, ["batch_id"], last=True).select(*df.columns)


def stream_dedup(df: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def split_good_bad(df: DataFrame, ok: Column, purpose: str = "split") -> tuple[str, str]:
    """One pass, two tables: rows that pass, and dead letters."""

    def save(batch: DataFrame, batch_id: int, out: str) -> None:
        tagged = batch.withColumn("part", F.when(F.coalesce(ok, F.lit(False)), "good").otherwise("bad"))
        (
            tagged.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("part", "batch_id").parquet(f"{out}/data")
        )

    out = run_batches(df, purpose, save)
    return f"{out}/data/part=good", f"{out}/data/part=bad"


def run_progress(events: DataFrame, ts: str = "ts", ttl_h: int = RUN_TTL_H) -> DataFrame:
    """Latest stage and counters of each run; a run silent for `ttl_h` hours leaves the state.

    Expiry needs the watermark, so the group has a coarse time window as a second key.
    """
    return (
        events.withWatermark(ts, f"{ttl_h} hours")
        .groupBy(F.window(ts, f"{ttl_h} hours").alias("w"), "run_key")
        .agg(
            F.max(ts).alias("updated_at"),
            F.max_by("stage", F.struct(ts, "event_id")).alias("stage"),
            F.count("*").alias("updates"),
            F.sum("n").alias("n"),
        )
        .select("run_key", F.col("w.start").alias("period"), "updated_at", "stage", "updates", "n")
    )


def success_rate(log: DataFrame, window: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes",
                 by: str = "domain") -> DataFrame:
    """Windowed success % by domain; tumbling, or sliding with `slide`."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (
        log.withWatermark("ts", delay).groupBy(w.alias("w"), by)
        .agg(F.count("*").alias("n"), (F.avg(F.col("ok").cast("double")) * 100).alias("success_pct"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), by, "n", "success_pct")
    )


def liveness_sessions(heartbeats: DataFrame, by: str = "worker_id", gap_s: int = HEARTBEAT_S, delay: str = "10 minutes") -> DataFrame:
    """Spells of activity: a worker silent for `gap_s` seconds is dead until its next heartbeat."""
    return (
        heartbeats.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", f"{gap_s} seconds").alias("s"), by)
        .agg(F.count("*").alias("beats"))
        .select(by, F.col("s.start").alias("alive_from"), F.col("s.end").alias("dead_at"), "beats")
    )


def stream_index_load(df: DataFrame, project: str, prefix: str = "", purpose: str = "index") -> tuple[DataFrame, DataFrame]:
    """Progressive index load: the documents, one for each key, and the rejects.

    Each micro-batch writes its own folders, so a replayed batch adds nothing; of a key's documents that of the latest batch counts.
    """
    from pageloom.operators.scans import first_per_key

    def save(batch: DataFrame, batch_id: int, out: str) -> None:
        keyed, rejects = split_unkeyed(index_docs(batch, project, prefix))
        first_per_key(keyed, ["doc_id"], ["doc"], last=True).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/batch_id={batch_id}")

    out = run_batches(df, purpose, save)
    saved = df.sparkSession.read.parquet(f"{out}/data")
    docs = first_per_key(saved, ["doc_id"], ["batch_id"], last=True).drop("batch_id")
    return docs, df.sparkSession.read.parquet(f"{out}/rejects").drop("batch_id")


def stream_index(df: DataFrame, project: str, prefix: str = "", purpose: str = "index") -> DataFrame:
    return stream_index_load(df, project, prefix, purpose)[0]


def stream_expire_dlq(dlq: DataFrame, hours: int = DLQ_TTL_H, ts: str = "failed_at", now: Column | None = None) -> DataFrame:
    """Letters not older than `hours`, by the batch's clock unless a time is given."""
    at = F.current_timestamp() if now is None else now
    return dlq.filter(F.col(ts) > at - F.make_dt_interval(F.lit(0), F.lit(hours)))


class LateRows(StreamingQueryListener):
    """Adds up the rows each query drops behind its watermark, batch by batch; add it to the session before the start.

    A query's own `recentProgress` keeps the last hundred batches only.
    """

    def __init__(self):
        self.dropped: dict[str, dict[int, int]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped.setdefault(str(progress.runId), {})[progress.batchId] = sum(
            op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def of(self, query, wait_s: float = 30) -> int:
        """Of a query, once the reports of its last batch have come if it has ended."""
        run, until = str(query.runId), time.monotonic() + wait_s
        while not query.isActive and run not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return sum(self.dropped.get(run, {}).values())


def good_pages(df: DataFrame) -> DataFrame:
    return df.filter(C.is_ok(F.col("status_code"), F.col("html")))
