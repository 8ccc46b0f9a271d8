"""Runs in progress and finished ones, kept by a stream: pieces of open runs with event-time timers; the last finished runs of a site are drawn from its output."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pageloom.operators.scans import first_per_key, top_per_group
from pageloom.streaming.stateful import use_rocksdb

# the process that sets up state on the driver does not see files added to the session
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Finished runs kept, hours after which a silent run is dropped, the stage a run begins with.
MAX_LAST_RUNS = 50
RUN_TTL_H = 12
FIRST_STAGE = "discovery"
# The open runs of a site are kept in this many pieces.
PIECES = 64

START, PROGRESS, COMPLETE = "start", "progress", "complete"
RUN = "stage string, started_at timestamp, updated_at timestamp, completed_at timestamp, status string, counters string"
OUTPUT = f"project string, site string, place string, schedule_id string, tie bigint, {RUN}"
FIELDS = ["stage", "started_at", "updated_at", "completed_at", "status", "counters"]


def _us(at: pd.Timestamp) -> int:
    return at.value // 1000


class RunTracker(StatefulProcessor):
    """State of a piece of a site: its open runs as one JSON text of (schedule id, run), read and written once in a micro-batch, and the time of its timer."""

    def __init__(self, ttl_h: float):
        self.ttl_ms = int(ttl_h * 3600 * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runs", "due bigint, runs string")

    def _held(self) -> tuple[int | None, dict[str | None, dict]]:
        row = self.state.get()
        return (row[0], dict(json.loads(row[1]))) if row else (None, {})

    def _keep(self, due: int | None, runs: dict[str | None, dict]) -> None:
        """Write the open runs, with a timer not later than the first of them that falls silent."""
        if not runs:
            self.state.clear()
            return
        first = min(run["updated_at"] for run in runs.values()) // 1000 + self.ttl_ms
        if due is None or first < due:
            due = first
            self.handle.registerTimer(due)
        self.state.update((due, json.dumps(list(runs.items()))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due, runs = self._held()
        touched: dict[str | None, None] = {}
        done = []
        for r in pd.concat(list(rows)).sort_values(["ts", "tie"]).itertuples(index=False):
            touched[r.schedule_id] = None
            if r.kind == START:
                runs[r.schedule_id] = {"stage": r.stage or FIRST_STAGE, "started_at": _us(r.ts), "counters": {}}
            run = runs.get(r.schedule_id)
            if run is None:
                continue
            run["updated_at"] = _us(r.ts)
            if r.kind != START and r.stage:
                run["stage"] = r.stage
            # a counter is replaced by each new value
            run["counters"].update({k: v for k, v in json.loads(r.counters or "{}").items() if v is not None})
            if r.kind == COMPLETE:
                done.append((r.schedule_id, r.tie, runs.pop(r.schedule_id) | {"completed_at": _us(r.ts), "status": r.status or "completed"}))
        self._keep(due, runs)
        yield self._table(key, "current", [(s, None, runs.get(s, {})) for s in touched])
        if done:
            yield self._table(key, "history", done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, runs = self._held()
        # all that fell silent before the watermark go at once
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1) - self.ttl_ms
        silent = [s for s, run in runs.items() if run["updated_at"] // 1000 <= until]
        self._keep(None, {s: run for s, run in runs.items() if run["updated_at"] // 1000 > until})
        if silent:
            yield self._table(key, "current", [(s, None, {}) for s in silent])

    def _table(self, key, place: str, runs: list[tuple[str, int | None, dict]]) -> pd.DataFrame:
        out = pd.DataFrame(
            [(key[0], key[1], place, s, tie, *(run.get(f) for f in FIELDS)) for s, tie, run in runs],
            columns=["project", "site", "place", "schedule_id", "tie", *FIELDS])
        out["tie"] = out["tie"].astype("Int64")
        for name in ("started_at", "updated_at", "completed_at"):
            out[name] = pd.Series([None if run.get(name) is None else pd.Timestamp(run[name], unit="us") for _, _, run in runs], dtype="datetime64[us]")
        out["counters"] = [json.dumps(c, sort_keys=True) if isinstance(c, dict) else None for c in out["counters"]]
        return out

    def close(self) -> None:
        pass


def track_runs(events: DataFrame, ttl_h: float = RUN_TTL_H, delay: str = "1 hour", pieces: int = PIECES) -> DataFrame:
    """Run events to changes of the open runs, and the finished runs with the `tie` of their last event, in update mode.

    `events`: project, site, schedule_id, ts, tie, kind (start, progress, complete), stage, status, counters (map of name to value).
    A start opens a run, and opens it anew if it was open. Progress sets the stage if it has one and replaces the counters it names; of a run
    that is not open it is ignored. A completed run leaves the open ones and is told of as finished. A run silent for `ttl_h` hours of
    event time leaves the open ones by a timer once the watermark has passed. Events apply in the order of their micro-batches, and by (ts, tie) within one.
    The runs of a site are dealt by schedule id to `pieces` keys of state, so a site with many runs uses many tasks; the events of one piece
    in one micro-batch are in memory together.
    """
    use_rocksdb(events.sparkSession)
    piece = F.pmod(F.xxhash64("schedule_id"), F.lit(pieces)).alias("piece")
    rows = events.withWatermark("ts", delay).select(
        "project", "site", piece, "schedule_id", "ts", "tie", "kind", "stage", "status", F.to_json("counters").alias("counters"))
    return rows.groupBy("project", "site", "piece").transformWithStateInPandas(
        statefulProcessor=RunTracker(ttl_h), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def run_tables(events: DataFrame, purpose: str = "runs", keep: int = MAX_LAST_RUNS, **options) -> tuple[DataFrame, DataFrame]:
    """Process all input there is; the open runs, and the last `keep` finished ones of each site with `number` 1 for the newest."""
    from pageloom.streaming.streams import run_batches

    spark = events.sparkSession

    def save(batch: DataFrame, batch_id: int, out: str) -> None:
        # of the rows of one micro-batch the last written of a key counts; a replayed batch overwrites its own folder
        batch.withColumn("seq", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    out = run_batches(track_runs(events, **options), purpose, save, "update")
    saved = spark.read.parquet(f"{out}/data")
    run: list[Column] = [F.col(f) for f in FIELDS]
    key = ["project", "site", "schedule_id"]
    newest = first_per_key(saved.filter("place = 'current'"), key, ["batch_id", "seq"], last=True)
    current = newest.filter(F.col("updated_at").isNotNull()).select(*key, *run)
    # in the order in which they finished
    order = [F.desc(c) for c in ("batch_id", "completed_at", "tie", "seq")]
    last = top_per_group(saved.filter("place = 'history'"), key[:2], order, keep)
    number = F.row_number().over(W.partitionBy(*key[:2]).orderBy(*order)).alias("number")
    return current, last.select(*key, number, *run)
