"""State tables, streams that fold into them, and run tracking with timers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators import changes as CH, health as HE
from pageloom.session import new_folder
from pageloom.sources.state import StateTable
from pageloom.streaming import runs as RN, stateful as SF, streams as ST


def files(table):
    return {p for p in table.snapshot()["buckets"].values()}


def test_only_touched_buckets_are_rewritten(spark):
    table = StateTable(spark, new_folder(spark, "state"), CH.STATE, "url", 8)
    now = F.lit("2024-01-01").cast("timestamp")
    rows = lambda *urls: spark.createDataFrame([(u, f"h{u}") for u in urls], "url string, hash string")
    assert CH.merge_crawl(table, rows(*map(str, range(100)), None), now, 1)
    before = files(table)
    assert len(before) == 8 and table.read().count() == 101
    assert CH.merge_crawl(table, rows("5"), now, 2)
    assert len(before - files(table)) == 1 and len(files(table) - before) == 1
    assert not CH.merge_crawl(table, rows("6", "new"), now, 2) and table.read().count() == 101
    old = table.read()  # a reader of the old snapshot
    CH.merge_crawl(table, spark.createDataFrame([("7", "other"), ("7", "an"), (None, "x")], "url string, hash string"), now, 3)
    assert old.count() == 101
    assert {tuple(r) for r in table.read().filter("change_count > 0").select("url", "hash").collect()} == {("7", "other"), (None, "x")}
    table.vacuum(1)
    kept = {f"data/{d}/{b}" for d in table.folder.names("data") for b in table.folder.names(f"data/{d}") if b.startswith("bucket=")}
    assert kept == files(table) and table.folder.names("snapshots") == [table.folder.names("snapshots")[-1]]
    assert table.read().count() == 101


def test_failed_and_competing_merges_leave_the_snapshot(spark):
    table = StateTable(spark, new_folder(spark, "state"), "k long, v long", "k", 4)
    rows = spark.range(20).selectExpr("id k", "id v")
    table.merge(rows, lambda state, new: new, "a")
    with pytest.raises(Exception, match="boom"):
        table.merge(rows, lambda state, new: new.withColumn("v", F.raise_error(F.lit("boom")).cast("long")), "b")
    assert table.snapshot()["version"] == 1 and table.read().agg(F.sum("v")).first()[0] == 190

    def slow(state, new):
        StateTable(spark, table.path, "k long, v long", "k", 4).merge(rows.limit(1), lambda s, n: s, "quick")
        return new

    with pytest.raises(RuntimeError):
        table.merge(rows, slow, "c")
    assert not table.holds("c") and table.holds("quick")
    with pytest.raises(ValueError, match="touch"):
        table.merge(rows.filter("k = 3"), lambda state, new: rows, "d")
    assert table.read().count() == 20
    empty = StateTable(spark, new_folder(spark, "state"), "k long, v long", "k")
    assert empty.read().count() == 0 and empty.merge(rows.limit(0), lambda state, new: new, 1) and empty.read().count() == 0


def sliced(spark, df, column, n):
    folder = new_folder(spark, "slices")
    for k in range(n):
        df.filter(F.col(column) == k).drop(column).coalesce(1).write.mode("append").parquet(folder)
    return ST.stream_table(spark, folder, df.drop(column).schema, 1)


def test_composed_stretches_are_the_whole_log(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), i // 7, i, rng.random() < 0.4, rng.choice([None, 0.0, 5.0, 900.0]), i * 5 // 700) for i in range(700)]
    log = spark.createDataFrame(rows, "endpoint long, s long, event_id long, ok boolean, latency_ms double, part int").withColumn(
        "ts", F.timestamp_seconds("s")).drop("s")
    stretches = [HE.folded(log.filter(F.col("part") == k), chunk_s=9) for k in range(5)]
    state = spark.createDataFrame([], SF.HEALTH_STATE)
    for stretch in stretches:
        state = HE.composed(state, stretch)
    want = {}
    for endpoint, _, _, ok, ms, _ in rows:
        rate, latency, fails, n = want.get(endpoint, (1.0, 500.0, 0, 0))
        want[endpoint] = (0.15 * ok + 0.85 * rate, 0.2 * ms + 0.8 * latency if ok and ms else latency, 0 if ok else fails + 1, n + 1)
    got = {r["endpoint"]: r for r in state.collect()}
    assert set(got) == set(want)
    for endpoint, (rate, latency, fails, n) in want.items():
        r = got[endpoint]
        assert (r["consecutive_fails"], r["total_requests"]) == (fails, n)
        assert abs(r["ema_rate"] - rate) < 1e-9 and abs(r["ema_latency_ms"] - latency) < 1e-6
    _, streamed = SF.stream_health(sliced(spark, log, "part", 5))
    assert {r["endpoint"]: round(r["ema_rate"], 9) for r in streamed.collect()} == {e: round(w[0], 9) for e, w in want.items()}


def test_old_state_of_changes_does_not_count(spark):
    rows = [("a", 0, 1, "x", 0), ("b", 0, 2, "x", 0), ("a", 5, 3, "x", 1), ("b", 40, 4, "x", 2), ("a", 40, 5, "y", 2), ("a", 40, 6, "y", 2), (None, 40, 7, "z", 2)]
    df = spark.createDataFrame(rows, "url string, day int, tie long, hash string, part int").withColumn(
        "ts", F.timestamp_seconds(F.col("day") * 86400)).drop("day")
    got = {r["tie"]: (r["change_type"], r["old_hash"]) for r in SF.stream_changes(sliced(spark, df, "part", 3), 36, buckets=4).collect()}
    assert got == {1: ("new", None), 2: ("new", None), 3: ("unchanged", "x"), 4: ("new", None), 5: ("modified", "x"), 6: ("unchanged", "y"), 7: ("new", None)}


def test_runs_leave_by_completion_and_by_timer(spark):
    def event(hour, run, kind, stage=None, status=None, part=0, **counters):
        return ("p", "s", run, hour, kind, stage, status, {k: v for k, v in counters.items()}, part)

    rows = [
        event(0, "a", "start"), event(1, "a", "progress", "retriever", found=3, done=1), event(13, "a", "progress", None, done=2),  # over a 12 h border
        event(0, "b", "progress", "x", n=1),  # never started
        event(2, "c", "start"), event(3, "c", "complete", None, "failed", n=9), event(4, "c", "progress", "late", n=10),
        event(14, "d", "start", part=1), event(20, "a", "complete", "done", None, part=1, done=7), event(1, "silent", "start"),
        event(60, "e", "start", part=2), event(61, "e", "progress", "parser", n=1, part=2), event(100, "f", "start", part=3), event(101, "f", "progress", part=4),
        *(event(101 + k / 10, f"g{k}", kind, part=4) for k in range(5) for kind in ("start", "complete")),
    ]
    df = spark.createDataFrame(
        [(p, s, r, float(h), i, k, st, x, c, part) for i, (p, s, r, h, k, st, x, c, part) in enumerate(rows)],
        "project string, site string, schedule_id string, hour double, tie long, kind string, stage string, status string, counters map<string,long>, part int")
    df = df.withColumn("ts", F.timestamp_seconds(1_700_000_000 + F.col("hour") * 3600)).drop("hour")
    current, history = RN.run_tables(sliced(spark, df, "part", 5), ttl_h=12, keep=3)
    open_runs = {r["schedule_id"]: r for r in current.collect()}
    assert set(open_runs) == {"f"}  # silent, d and e left by their timers
    last = {r["number"]: r for r in history.collect()}
    assert [last[n]["schedule_id"] for n in (1, 2, 3)] == ["g4", "g3", "g2"] and set(last) == {1, 2, 3}
    current, history = RN.run_tables(sliced(spark, df.filter("part < 2"), "part", 2), ttl_h=500)
    assert {r["schedule_id"] for r in current.collect()} == {"d", "silent"}
    last = {r["number"]: r for r in history.collect()}
    assert [last[n]["schedule_id"] for n in (1, 2)] == ["a", "c"]
    assert (last[1]["stage"], json.loads(last[1]["counters"]), last[1]["status"]) == ("done", {"found": 3, "done": 7}, "completed")
    assert (last[2]["stage"], json.loads(last[2]["counters"]), last[2]["status"]) == ("discovery", {"n": 9}, "failed")
    assert (last[1]["completed_at"] - last[1]["started_at"]).total_seconds() == 20 * 3600


def test_runs_do_not_depend_on_arrow_batches(spark):
    """Events of a micro-batch apply in time order, also where a site has more of them than an Arrow batch holds."""
    rows = [(f"r{k}", 10 * step + k % 7, 100 * step + k, kind, step) for step, kind in enumerate(["start", "progress", "complete"]) for k in range(40)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "schedule_id string, s long, tie long, kind string, step int").select(
        F.lit("p").alias("project"), F.lit("s").alias("site"), "schedule_id", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"), "tie", "kind",
        F.lit(None).cast("string").alias("stage"), F.lit(None).cast("string").alias("status"), F.create_map(F.lit("step"), "step").alias("counters"),
        F.lit(0).alias("part"))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        current, history = RN.run_tables(sliced(spark, df, "part", 1), ttl_h=500, keep=3)
        got = {r["number"]: (r["schedule_id"], json.loads(r["counters"])) for r in history.collect()}
    finally:
        spark.conf.set(name, before)
    assert current.count() == 0
    want = sorted((r for r in rows if r[3] == "complete"), key=lambda r: (r[1], r[2]), reverse=True)[:3]
    assert got == {n: (r[0], {"step": 2}) for n, r in enumerate(want, 1)}
