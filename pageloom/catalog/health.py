"""Endpoint health, counters and latency over the fetch log."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import DOMAIN_LOG_SQL, LOG_SQL, domain_log, fetch_log, query
from pageloom.operators import health as HE

NOW = "2024-01-30 12:00:00"
FOLD = """list_reduce(list_concat([{init}::DOUBLE], list({x} ORDER BY ts, event_id)), lambda r, x: {a} * x + {k} * r)"""


def fold(x: str, init: float, a: float) -> str:
    return FOLD.format(x=x, init=init, a=a, k=1 - a)


STREAK_SQL = """
last_ok AS (SELECT endpoint, max(ts) FILTER (WHERE ok) AS ok_ts FROM log GROUP BY endpoint),
fails AS (SELECT l.endpoint, count(*) FILTER (WHERE ok_ts IS NULL OR ts > ok_ts) AS consecutive_fails, max(ts) AS last_ts
          FROM log l JOIN last_ok USING (endpoint) GROUP BY l.endpoint),
breaker AS (SELECT endpoint, consecutive_fails, last_ts,
  CASE WHEN consecutive_fails >= 4 THEN least(pow(2, consecutive_fails - 3), 8) ELSE 1 END AS cooldown_mult,
  CASE WHEN consecutive_fails >= 4 THEN least(120 * least(pow(2, consecutive_fails - 4), 8), 900) ELSE 0 END AS cooldown_s FROM fails)
"""


@query("ema_success", f"WITH {LOG_SQL} SELECT endpoint, round({fold('ok::INT::DOUBLE', 1.0, 0.15)}, 9) AS ema_rate FROM log GROUP BY endpoint")
def ema_success(t):
    return HE.ema(fetch_log(t), chunk_s=6 * 3600).withColumn("ema_rate", F.round("ema_rate", 9))


@query("ema_latency", f"""
WITH {LOG_SQL}, f AS (SELECT endpoint, {fold('latency_ms', 500.0, 0.2)} AS e FROM log WHERE ok AND latency_ms > 0 GROUP BY endpoint)
SELECT endpoint, round(coalesce(e, 500.0), 6) AS ema_latency_ms FROM (SELECT DISTINCT endpoint FROM log) LEFT JOIN f USING (endpoint)""")
def ema_latency(t):
    return HE.latency_ema(fetch_log(t)).withColumn("ema_latency_ms", F.round("ema_latency_ms", 6))


@query("fail_streaks", f"""
WITH {LOG_SQL}, g AS (SELECT endpoint, event_id, ts, ok, sum(ok::INT) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS grp FROM log)
SELECT endpoint, event_id, sum((NOT ok)::INT) OVER (PARTITION BY endpoint, grp ORDER BY ts, event_id)::BIGINT AS fail_streak FROM g""")
def fail_streaks(t):
    return HE.with_fail_streak(fetch_log(t)).select("endpoint", "event_id", "fail_streak")


@query("breaker_state", f"""
WITH {LOG_SQL}, {STREAK_SQL}
SELECT endpoint, consecutive_fails, last_ts, CAST(cooldown_mult AS INTEGER) AS cooldown_mult, CAST(cooldown_s AS DOUBLE) AS cooldown_s,
  CASE WHEN consecutive_fails < 4 THEN 'closed' WHEN TIMESTAMP '{NOW}' < last_ts + to_seconds(cooldown_s) THEN 'open' ELSE 'half_open' END AS cb_state FROM breaker""")
def breaker_state(t):
    return HE.breaker_state(fetch_log(t), F.lit(NOW).cast("timestamp_ntz"))


_LABELS = f"""
e AS (SELECT endpoint, {fold('ok::INT::DOUBLE', 1.0, 0.15)} AS ema_rate, count(*) AS total_requests, count(*) FILTER (WHERE ok) AS total_successes FROM log GROUP BY endpoint),
h AS (SELECT endpoint, ema_rate, total_requests, total_successes,
        CASE WHEN consecutive_fails < 4 THEN 'closed' WHEN TIMESTAMP '{NOW}' < last_ts + to_seconds(cooldown_s) THEN 'open' ELSE 'half_open' END AS cb_state
      FROM e JOIN breaker USING (endpoint))
"""


@query("health_label", f"""
WITH {LOG_SQL}, {STREAK_SQL}, {_LABELS}
SELECT endpoint, total_requests, total_successes, cb_state, cb_state = 'closed' AND ema_rate >= 0.70 AS is_healthy, ema_rate < 0.40 AS is_degraded,
  round(CASE cb_state WHEN 'open' THEN 0.0 WHEN 'half_open' THEN 0.05 ELSE greatest(0.05, ema_rate) END, 9) AS weight FROM h""")
def health_label(t):
    out = HE.endpoint_health(fetch_log(t), F.lit(NOW).cast("timestamp_ntz"))
    return out.select("endpoint", "total_requests", "total_successes", "cb_state", "is_healthy", "is_degraded", F.round("weight", 9).alias("weight"))


@query("pool_stats", f"""
WITH {LOG_SQL}, {STREAK_SQL}, {_LABELS}
SELECT count(*) AS total, count(*) FILTER (WHERE cb_state = 'closed' AND ema_rate >= 0.7) AS healthy, count(*) FILTER (WHERE cb_state = 'closed' AND ema_rate < 0.4) AS degraded,
  count(*) FILTER (WHERE cb_state = 'open') AS circuit_open, count(*) FILTER (WHERE cb_state = 'half_open') AS circuit_half, round_even(avg(ema_rate), 3) AS avg_ema_rate FROM h""")
def pool_stats(t):
    return HE.pool_stats(HE.endpoint_health(fetch_log(t), F.lit(NOW).cast("timestamp_ntz")))


@query("blocked_domains", f"""
WITH {LOG_SQL} SELECT endpoint, regexp_replace(domain, '^www\\.', '') AS domain, count(*) AS hits, min(ts) AS first_ts FROM log WHERE blocked GROUP BY 1, 2""")
def blocked_domains(t):
    return HE.blocked_domains(fetch_log(t))


@query("fetch_counters", f"""
WITH {LOG_SQL}
SELECT domain, CASE WHEN blocked THEN 'blocked' WHEN status_code = 200 THEN 'none' WHEN status_code IN (429, 500) THEN 'retryable' ELSE 'client_error' END AS error_type, count(*) AS n
FROM log GROUP BY 1, 2""")
def fetch_counters(t):
    return HE.fetch_counters(fetch_log(t))


def _histogram(bounds, value: str) -> str:
    parts = [f"SELECT domain, '{b}' AS le, count(*) FILTER (WHERE {value} <= {b}) AS n FROM dlog GROUP BY domain" for b in bounds]
    return f"WITH {DOMAIN_LOG_SQL} " + " UNION ALL ".join([*parts, "SELECT domain, '+Inf', count(*) FROM dlog GROUP BY domain"])


@query("fetch_latency_histogram", _histogram([0.1, 0.25, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 30.0], "latency_ms / 10"))
def fetch_latency_histogram(t):
    return HE.latency_histogram(domain_log(t), seconds=F.col("latency_ms") / 10)


@query("parse_latency_histogram", _histogram([0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0], "latency_ms / 1000"))
def parse_latency_histogram(t):
    return HE.latency_histogram(domain_log(t), HE.PARSE_BUCKETS)


@query("rolling_success", f"""
WITH {DOMAIN_LOG_SQL}
SELECT event_id, domain, round(avg(ok::INT * 100.0::DOUBLE) OVER (PARTITION BY domain ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW), 6) AS success_pct FROM dlog""")
def rolling_success(t):
    log = domain_log(t).select("event_id", "domain", "ts", "ok")
    return HE.rolling_success(log, 3600, chunk_s=2 * 3600).select("event_id", "domain", F.round("success_pct", 6).alias("success_pct"))


@query("rolling_success_5m", f"""
WITH {LOG_SQL}
SELECT event_id, endpoint, round(avg(ok::INT * 100.0::DOUBLE) OVER (PARTITION BY endpoint ORDER BY epoch_us(ts) RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW), 6) AS success_pct FROM log""")
def rolling_success_5m(t):
    log = fetch_log(t).select("event_id", "endpoint", "ts", "ok")
    return HE.rolling_success(log, 300, by="endpoint").select("event_id", "endpoint", F.round("success_pct", 6).alias("success_pct"))


@query("domain_strategies", f"""
WITH {LOG_SQL} SELECT domain, coalesce(max(strategy) FILTER (WHERE ok), 0) AS min_strategy, max(ts) FILTER (WHERE ok) AS last_success FROM log GROUP BY domain""")
def domain_strategies(t):
    return HE.domain_strategies(fetch_log(t))


@query("strategy_distribution", f"""
WITH {LOG_SQL}, d AS (SELECT domain, coalesce(max(strategy) FILTER (WHERE ok), 0) AS min_strategy FROM log GROUP BY domain)
SELECT min_strategy, count(*) AS domains FROM d GROUP BY 1 ORDER BY 1 DESC""")
def strategy_distribution(t):
    return HE.strategy_distribution(fetch_log(t))


@query("queue_depths", """
SELECT stage, count(event_id) AS depth FROM (VALUES ('discovery'), ('retriever'), ('parser')) AS s(stage)
LEFT JOIN (SELECT event_id, CASE WHEN value < 20 THEN 'discovery' ELSE 'retriever' END AS st FROM events WHERE event_type = 'error') ON st = stage GROUP BY stage""")
def queue_depths(t):
    dlq = t.events.filter(F.col("event_type") == "error").select(F.when(F.col("value") < 20, "discovery").otherwise("retriever").alias("stage"))
    stages = t.spark.createDataFrame([("discovery",), ("retriever",), ("parser",)], "stage string")
    return HE.queue_depths(dlq, stages)


@query("publish_latency_histogram", _histogram([0.001, 0.005, 0.01, 0.05, 0.1, 0.5], "latency_ms / 1000"))
def publish_latency_histogram(t):
    return HE.latency_histogram(domain_log(t), HE.PUBLISH_BUCKETS)


@query("pipeline_counters", f"""
WITH {LOG_SQL}
SELECT domain, count(*) AS urls_discovered, count(*) - count(DISTINCT endpoint) AS urls_deduplicated, count(*) FILTER (WHERE ok) AS pages_fetched,
       count(*) FILTER (WHERE NOT ok) AS dead_letters FROM log GROUP BY domain""")
def pipeline_counters(t):
    return HE.pipeline_counters(fetch_log(t), "endpoint")


def _some_without_endpoint(t):
    """The log with one endpoint in five unknown."""
    return fetch_log(t).withColumn("endpoint", F.when(F.col("endpoint") % 5 != 3, F.col("endpoint")))


_NULL_LOG_SQL = LOG_SQL + """,
nlog AS (SELECT * REPLACE (CASE WHEN endpoint % 5 <> 3 THEN endpoint END AS endpoint) FROM log)"""


@query("fail_streaks_unknown_endpoint", f"""
WITH {_NULL_LOG_SQL}, g AS (SELECT endpoint, event_id, ts, ok, sum(ok::INT) OVER (PARTITION BY endpoint ORDER BY ts, event_id) AS grp FROM nlog)
SELECT endpoint, event_id, sum((NOT ok)::INT) OVER (PARTITION BY endpoint, grp ORDER BY ts, event_id)::BIGINT AS fail_streak FROM g""")
def fail_streaks_unknown_endpoint(t):
    return HE.with_fail_streak(_some_without_endpoint(t)).select("endpoint", "event_id", "fail_streak")


@query("consecutive_failures_unknown_endpoint", f"""
WITH {_NULL_LOG_SQL}, last_ok AS (SELECT endpoint, max((ts, event_id)) FILTER (WHERE ok) AS last FROM nlog GROUP BY endpoint)
SELECT l.endpoint, count(*) FILTER (WHERE last IS NULL OR (ts, event_id) > last) AS consecutive_fails, max(ts) AS last_ts
FROM nlog l JOIN last_ok o ON l.endpoint IS NOT DISTINCT FROM o.endpoint GROUP BY l.endpoint""")
def consecutive_failures_unknown_endpoint(t):
    return HE.consecutive_failures(_some_without_endpoint(t))


@query("health_totals_unknown_endpoint", f"""
WITH {_NULL_LOG_SQL} SELECT endpoint, count(*) AS total_requests, count(*) FILTER (WHERE ok) AS total_successes FROM nlog GROUP BY endpoint""")
def health_totals_unknown_endpoint(t):
    """Endpoint health keeps the rows of unknown endpoints."""
    health = HE.endpoint_health(_some_without_endpoint(t), F.lit(NOW).cast("timestamp_ntz"))
    return health.select("endpoint", "total_requests", "total_successes")
