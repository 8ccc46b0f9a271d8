"""Streaming operators, run to the end of their input with `availableNow`.

Append-mode results hold only what the final watermark has closed; the SQL
applies the same cut.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import DOMAIN_LOG_SQL, LOG_SQL, domain_log, fetch_log, query
from pageloom.catalog.quality import DLQ_SQL, dlq
from pageloom.session import new_folder
from pageloom.sources import bulkindex as BI, records as SR
from pageloom.sources.state import Folder
from pageloom.streaming import runs as RN, stateful as SF, streams as ST


def stream(t, name: str):
    """A table, one file or a folder of files, as a stream; NTZ times become timestamps, which watermarks need."""
    # as a pattern: a plain path is taken for the base of partition folders, which a file cannot be
    return zoned(ST.stream_pages(t.spark, f"{t.folder}/{{{name}}}.parquet", getattr(t, name).schema))


def zoned(df):
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"})


def plain(df):
    """Timestamps back to zone-less ones for comparison."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"})


_CUT = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {delay} FROM events)"


@query("stream_drain", f"WITH {LOG_SQL} SELECT event_id, endpoint, status_code FROM log WHERE ok")
def stream_drain(t):
    return ST.drain(fetch_log(t, stream(t, "events")).filter("ok").select("event_id", "endpoint", "status_code"), "drain")


@query("stream_dedup", f"WITH {LOG_SQL} SELECT DISTINCT endpoint, domain FROM log")
def stream_dedup(t):
    rows = fetch_log(t, stream(t, "events")).select("ts", "endpoint", "domain")
    return ST.drain(ST.stream_dedup(rows, ["endpoint", "domain"], "ts", "60 days"), "dedup").select("endpoint", "domain")


@query("stream_split_good_bad", f"WITH {LOG_SQL} SELECT CASE WHEN ok THEN 'good' ELSE 'bad' END AS part, count(*) AS n, min(event_id) AS first_id FROM log GROUP BY 1")
def stream_split_good_bad(t):
    good, bad = ST.split_good_bad(fetch_log(t, stream(t, "events")), F.col("ok"))
    count = lambda path, name: t.spark.read.parquet(path).agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.min("event_id").alias("first_id"))
    return count(good, "good").unionByName(count(bad, "bad"))


def in_slices(t, df, place, files: int = 6):
    """Rows as a stream of several slices, each a micro-batch, in the order of `place` (0 to files - 1).

    File times are the order in which a stream takes files, so the slices are written one after the other. Each is written by many tasks, and all have the
    same number of files, which is what a micro-batch takes; files without rows make up for tasks that had none.
    """
    folder, cores = new_folder(t.spark, "slices"), t.spark.sparkContext.defaultParallelism
    each = max(cores, -(-df.rdd.getNumPartitions() // files))
    there = Folder(t.spark, folder)
    for k in range(files):
        df.filter(place == k).repartition(each).write.mode("append").parquet(folder)
        for _ in range(each * (k + 1) - sum(n.endswith(".parquet") for n in there.names())):
            t.spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(folder)
    return zoned(ST.stream_table(t.spark, folder, df.schema, each))


def by_days(t, files: int = 6):
    """The events as a stream of six stretches of time."""
    return in_slices(t, t.events, F.least(F.floor(F.datediff("ts", F.lit("2024-01-01").cast("date")) / 5), F.lit(files - 1)), files)


@query("stream_changes", """
SELECT CASE WHEN user_id % 7 <> 0 THEN 'u' || CAST(user_id AS VARCHAR) END AS url, event_id AS tie,
  CASE WHEN old IS NULL THEN 'new' WHEN old = event_type THEN 'unchanged' ELSE 'modified' END AS change_type,
  old AS old_hash, event_type AS new_hash, old IS NULL OR old <> event_type AS changed
FROM (SELECT *, lag(event_type) OVER (PARTITION BY CASE WHEN user_id % 7 <> 0 THEN user_id END ORDER BY ts, event_id) AS old FROM events)""")
def stream_changes(t):
    """Six micro-batches; a seventh of the rows has no URL and so shares one hot key."""
    versions = by_days(t).select(
        F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("url"), "ts", F.col("event_id").alias("tie"),
        F.col("event_type").alias("hash"))
    return SF.stream_changes(versions).drop("ts", "batch_id")


@query("stream_document_changes", """
WITH v AS (
  SELECT source || '/' || CAST(length(text) % 50 AS VARCHAR) AS url, doc_id, md5(text) AS hash, doc_id % 3 AS batch FROM documents),
l AS (SELECT *, lag(hash) OVER (PARTITION BY url ORDER BY batch, doc_id) AS old FROM v)
SELECT doc_id, url, CASE WHEN old IS NULL THEN 'new' WHEN old = hash THEN 'unchanged' ELSE 'modified' END AS change_type FROM l""")
def stream_document_changes(t):
    """Documents of a source and length as versions of one page, in three micro-batches."""
    docs = t.documents.select(
        F.concat(F.col("source"), F.lit("/"), (F.length("text") % 50).cast("string")).alias("url"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
        F.col("doc_id").alias("tie"), F.md5(F.encode("text", "UTF-8")).alias("hash"))
    return SF.stream_changes(in_slices(t, docs, F.col("tie") % 3, 3)).select(F.col("tie").alias("doc_id"), "url", "change_type")


@query("stream_run_progress", """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_key, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2024-01-01') AS period, max(ts) AS updated_at,
  arg_max(event_type, ts) AS stage, count(*) AS updates, CAST(sum(event_id) AS BIGINT) AS n FROM events GROUP BY 1, 2""")
def stream_run_progress(t):
    rows = stream(t, "events").select(
        "ts", "event_id", F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_key"), F.col("event_type").alias("stage"), F.col("event_id").alias("n")
    )
    return plain(ST.latest_updates(ST.run_progress(rows), "progress", ["run_key", "period"]))


@query("stream_success_tumbling", f"""
WITH {DOMAIN_LOG_SQL}, w AS (SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2024-01-01') AS window_start, domain, count(*) AS n, avg(ok::INT) * 100 AS success_pct FROM dlog GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, domain, n, round(success_pct, 6) AS success_pct FROM w WHERE window_start + INTERVAL 1 DAY <= {_CUT.format(delay='10 MINUTE')}""")
def stream_success_tumbling(t):
    rates = ST.success_rate(domain_log(t, stream(t, "events")), "1 day")
    return plain(ST.drain(rates, "tumbling")).withColumn("success_pct", F.round("success_pct", 6))


@query("stream_success_5m", f"""
WITH {DOMAIN_LOG_SQL}, w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2024-01-01') AS window_start, domain, count(*) AS n, avg(ok::INT) * 100 AS success_pct FROM dlog GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, domain, n, round(success_pct, 6) AS success_pct FROM w WHERE window_start + INTERVAL 5 MINUTE <= {_CUT.format(delay='10 MINUTE')}""")
def stream_success_5m(t):
    rates = ST.success_rate(domain_log(t, stream(t, "events")))
    return plain(ST.drain(rates, "tumbling5")).withColumn("success_pct", F.round("success_pct", 6))


@query("stream_success_sliding", f"""
WITH {DOMAIN_LOG_SQL}, e AS (SELECT *, unnest(generate_series(0, 3)) AS back FROM dlog),
w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') - to_hours(6 * back) AS window_start, domain, count(*) AS n, avg(ok::INT) * 100 AS success_pct FROM e GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, domain, n, round(success_pct, 6) AS success_pct FROM w WHERE window_start + INTERVAL 1 DAY <= {_CUT.format(delay='10 MINUTE')}""")
def stream_success_sliding(t):
    rates = ST.success_rate(domain_log(t, stream(t, "events")), "1 day", "6 hours")
    return plain(ST.drain(rates, "sliding")).withColumn("success_pct", F.round("success_pct", 6))


@query("stream_health", f"""
WITH {LOG_SQL},
hot AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 AND endpoint % 5 = 0 THEN NULL ELSE endpoint END AS endpoint, ts, event_id, ok, latency_ms FROM log),
behind AS (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY endpoint ORDER BY ts DESC, event_id DESC) AS later_ok FROM hot)
SELECT endpoint, round(list_reduce(list_concat([1.0::DOUBLE], list(ok::INT::DOUBLE ORDER BY ts, event_id)), lambda r, x: 0.15 * x + 0.85 * r), 9) AS ema_rate,
  round(list_reduce(list_concat([500.0::DOUBLE], coalesce(list(latency_ms ORDER BY ts, event_id) FILTER (WHERE ok AND latency_ms > 0), [])), lambda r, x: 0.2 * x + 0.8 * r), 6) AS ema_latency_ms,
  count(*) FILTER (WHERE later_ok = 0) AS consecutive_fails, count(*) AS total_requests
FROM behind GROUP BY endpoint""")
def stream_health(t):
    """Six micro-batches, an endpoint with a third of all rows, rows without an endpoint: as the batch form over the whole log."""
    log = fetch_log(t, by_days(t))
    endpoint = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("bigint")).when((F.col("event_id") % 3 != 1) | (F.col("endpoint") % 5 != 0), F.col("endpoint"))
    _, health = SF.stream_health(log.withColumn("endpoint", endpoint))
    return health.select("endpoint", F.round("ema_rate", 9).alias("ema_rate"), F.round("ema_latency_ms", 6).alias("ema_latency_ms"), "consecutive_fails", "total_requests")


RUNS_SQL = """
marked AS (
  SELECT 's' || CAST(user_id % 5 AS VARCHAR) AS site, CAST(user_id AS VARCHAR) AS schedule_id, ts, event_id, event_type,
         count(*) FILTER (WHERE event_type = 'signup') OVER w AS run FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
cut AS (SELECT *, count(*) FILTER (WHERE event_type = 'purchase') OVER (PARTITION BY schedule_id, run ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done
        FROM marked WHERE run > 0),
runs AS (
  SELECT site, schedule_id, run, min(ts) AS started_at, max(ts) AS updated_at, max(ts) FILTER (WHERE event_type = 'purchase') AS completed_at,
         coalesce(arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type NOT IN ('signup', 'purchase')), 'discovery') AS stage,
         max(event_id) FILTER (WHERE event_type = 'signup') AS signup, arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'view') AS viewed,
         arg_max(event_id, (ts, event_id)) AS last_id
  FROM cut WHERE done = 0 GROUP BY ALL)
"""


def _run_events(t):
    """Signups start the run of a user, purchases complete it, other events are progress; counters hold the last event of each type."""
    kind = F.when(F.col("event_type") == "signup", RN.START).when(F.col("event_type") == "purchase", RN.COMPLETE).otherwise(RN.PROGRESS)
    return by_days(t).select(
        F.lit("web").alias("project"), F.concat(F.lit("s"), (F.col("user_id") % 5).cast("string")).alias("site"), F.col("user_id").cast("string").alias("schedule_id"),
        "ts", F.col("event_id").alias("tie"), kind.alias("kind"), F.when(kind == RN.PROGRESS, F.col("event_type")).alias("stage"),
        F.lit(None).cast("string").alias("status"), F.create_map(F.col("event_type"), F.col("event_id")).alias("counters"))


def _viewed(df):
    return df.withColumns({"viewed": F.get_json_object("counters", "$.view").cast("bigint"), "signup": F.get_json_object("counters", "$.signup").cast("bigint")})


@query("stream_open_runs", f"""
WITH {RUNS_SQL}, last AS (SELECT schedule_id, max(run) AS run FROM cut GROUP BY schedule_id)
SELECT site, schedule_id, stage, started_at, updated_at, signup, viewed FROM runs JOIN last USING (schedule_id, run) WHERE completed_at IS NULL""")
def stream_open_runs(t):
    """Runs in progress after six micro-batches."""
    current, _ = RN.run_tables(_run_events(t), ttl_h=24 * 60)
    return plain(_viewed(current).select("site", "schedule_id", "stage", "started_at", "updated_at", "signup", "viewed"))


@query("stream_last_runs", f"""
WITH {RUNS_SQL}
SELECT site, schedule_id, CAST(number AS INTEGER) AS number, stage, started_at, completed_at, 'completed' AS status, signup, viewed FROM (
  SELECT *, row_number() OVER (PARTITION BY site ORDER BY completed_at DESC, last_id DESC) AS number FROM runs WHERE completed_at IS NOT NULL) WHERE number <= 50""")
def stream_last_runs(t):
    """The last fifty finished runs of each site after six micro-batches."""
    _, history = RN.run_tables(_run_events(t), ttl_h=24 * 60)
    return plain(_viewed(history).select("site", "schedule_id", "number", "stage", "started_at", "completed_at", "status", "signup", "viewed"))


@query("stream_liveness", f"""
WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g),
r AS (SELECT user_id AS worker_id, min(ts) AS alive_from, max(ts) + INTERVAL 6 HOUR AS dead_at, count(*) AS beats FROM s GROUP BY user_id, k)
SELECT * FROM r WHERE dead_at <= {_CUT.format(delay='10 MINUTE')}""")
def stream_liveness(t):
    beats = stream(t, "events").select("ts", F.col("user_id").alias("worker_id"))
    return plain(ST.drain(ST.liveness_sessions(beats, gap_s=6 * 3600), "liveness"))


@query("stream_index", "SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, 'web' AS index FROM documents")
def stream_index(t):
    docs = stream(t, "documents").select(F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("uniq_id"), "lang", "source")
    return ST.stream_index(docs, "web").select("doc_id", "index")


@query("stream_expire_dlq", f"WITH {DLQ_SQL} SELECT event_id FROM dlq WHERE failed_at > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR")
def stream_expire_dlq(t):
    letters = dlq(t, stream(t, "events"))
    return ST.drain(ST.stream_expire_dlq(letters, now=F.lit("2024-01-30 12:00:00").cast("timestamp")).select("event_id"), "dlq")


def in_time_order(t, name: str, by: str, files: int = 6):
    df = getattr(t, name)
    return in_slices(t, df, F.pmod(F.col(by), F.lit(files)), files)


@query("stream_late_rows", """
WITH dealt AS (SELECT *, event_id % 6 AS b FROM events),
seen AS (SELECT b, max(ts) AS top FROM dealt GROUP BY b),
marks AS (SELECT b, max(top) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS top FROM seen),
judged AS (
  SELECT coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= date_trunc('milliseconds', marks.top) - INTERVAL 1 DAY, false) AS late FROM dealt JOIN marks USING (b))
SELECT count(*) AS rows_in, count(*) FILTER (WHERE late) AS late, true AS told FROM judged""")
def stream_late_rows(t):
    """Six micro-batches over the same days: rows of windows that are closed by then are dropped. They are what the windows' last counts lack; the listener tells of them."""
    late = ST.LateRows()
    t.spark.streams.addListener(late)
    try:
        counts = in_time_order(t, "events", "event_id").withWatermark("ts", "1 day").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
        kept = ST.latest_updates(counts.select(F.col("w.start").alias("hour"), "n"), "late", ["hour"])
        n_kept = kept.agg(F.sum("n")).first()[0] or 0
        t.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        told = any(sum(batches.values()) > 0 for batches in late.dropped.values())
    finally:
        t.spark.streams.removeListener(late)
    return t.events.agg(F.count("*").alias("rows_in"), (F.count("*") - F.lit(n_kept)).alias("late"), F.lit(told).alias("told"))


@query("stream_index_batches", """
SELECT CAST(user_id AS VARCHAR) AS doc_id, max(event_id % 6)::VARCHAR AS batch FROM events GROUP BY 1""")
def stream_index_batches(t):
    """Keys that come in several micro-batches have one document, that of the latest."""
    rows = in_time_order(t, "events", "event_id").select(
        F.col("user_id").cast("string").alias("uniq_id"), F.pmod("event_id", F.lit(6)).cast("string").alias("batch"))
    docs, _ = ST.stream_index_load(rows, "web")
    return docs.select("doc_id", F.get_json_object("doc", "$.batch").alias("batch"))


@query("stream_bulk_index", """
SELECT CAST(user_id AS VARCHAR) AS doc_id, max(event_id % 6)::VARCHAR AS batch, (SELECT count(*) FROM events WHERE user_id IS NOT NULL) AS sent FROM events GROUP BY 1""")
def stream_bulk_index(t):
    """Micro-batches as batches of the bulk sink."""
    path = new_folder(t.spark, "bulk")
    t.spark.dataSource.register(BI.bulk_index())
    rows = in_time_order(t, "events", "event_id").select(
        F.col("user_id").cast("string").alias("uniq_id"), F.pmod("event_id", F.lit(6)).cast("string").alias("batch"))
    BI.load_stream(SR.index_docs(rows, "web"), path)
    sent = BI.commits(t.spark, path).agg(F.sum("sent")).first()[0]
    return BI.documents(t.spark, path).select("doc_id", F.get_json_object("doc", "$.batch").alias("batch"), F.lit(sent).alias("sent"))


@query("stream_index_rejects", """
SELECT count(*) AS rejects FROM events WHERE user_id % 10 = 3""")
def stream_index_rejects(t):
    """Rows without a key come back as rejects."""
    key = F.when(F.col("user_id") % 10 != 3, F.col("user_id").cast("string"))
    _, rejects = ST.stream_index_load(stream(t, "events").select(key.alias("uniq_id"), "event_type"), "web")
    return rejects.agg(F.count("*").alias("rejects"))
