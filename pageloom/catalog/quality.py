"""Alerts, quality rules, log searches and dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import PRODUCTS_SQL, RUNS_SQL, products, query, runs
from pageloom.operators import quality as Q
from pageloom.sources import pages as SP

NOW = "2001-08-01 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("run_alerts", f"""
WITH {RUNS_SQL}
SELECT project, site, schedule_id, 'run_failed' AS alert FROM runs WHERE status = 'failed'
UNION ALL SELECT project, site, schedule_id, 'no_urls' FROM runs WHERE status = 'completed' AND discovery_urls = 0
UNION ALL SELECT project, site, schedule_id, 'low_fetch_rate' FROM runs WHERE retriever_total > 0 AND retriever_fetched < 0.5 * retriever_total""")
def run_alerts(t):
    return Q.run_alerts(runs(t))


@query("find_records", f"""
WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a' WHEN 'O' THEN 'b' ELSE 'c' END AS site, o_orderdate AS crawled_at,
                  CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS price FROM orders)
SELECT o_orderkey FROM r WHERE site IN ('a', 'b') AND crawled_at >= TIMESTAMP '{NOW}' - INTERVAL 365 DAY AND price IS NULL""")
def find_records(t):
    s = F.col("o_orderstatus")
    rows = t.orders.select(
        "o_orderkey", F.when(s == "F", "a").when(s == "O", "b").otherwise("c").alias("site"), F.col("o_orderdate").alias("crawled_at"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
    )
    return Q.find_records(rows, ["a", "b"], 365, _now(), missing="price").select("o_orderkey")


_SANE = f"""
WITH {PRODUCTS_SQL}, p AS (SELECT site, CASE WHEN line_status = 'O' AND flag = 'R' THEN NULL ELSE list_price END AS lp,
  CASE WHEN flag = 'A' THEN selling_price + 50 ELSE selling_price END AS sp, CASE WHEN flag = 'N' THEN discount_percentage - 3 ELSE discount_percentage END AS pct FROM products)
"""


@query("price_sanity", _SANE + """
SELECT site, count(*) AS rows, count(*) FILTER (WHERE sp > lp) AS sell_above_list, count(*) FILTER (WHERE lp IS NULL OR sp IS NULL) AS price_missing,
  count(*) FILTER (WHERE pct < 0 OR pct > 100) AS discount_out_of_range FROM p GROUP BY site""")
def price_sanity(t):
    flag = F.col("flag")
    rows = products(t).select(
        "site", F.when((F.col("line_status") == "O") & (flag == "R"), None).otherwise(F.col("list_price")).alias("list_price"),
        F.when(flag == "A", F.col("selling_price") + 50).otherwise(F.col("selling_price")).alias("selling_price"),
        F.when(flag == "N", F.col("discount_percentage") - 3).otherwise(F.col("discount_percentage")).alias("discount_percentage"),
    )
    return Q.price_sanity(rows)


@query("constant_columns", f"""
WITH {PRODUCTS_SQL}, p AS (SELECT site || '/' || CAST(year(scraped_at) AS VARCHAR) || '/' || flag AS site, line_status, flag, CAST(month(scraped_at) AS VARCHAR) AS mon FROM products)
SELECT site, 'flag' AS field, min(flag) AS value, count(flag) AS rows FROM p GROUP BY site HAVING count(flag) >= 3 AND min(flag) = max(flag)
UNION ALL SELECT site, 'line_status', min(line_status), count(line_status) FROM p GROUP BY site HAVING count(line_status) >= 3 AND min(line_status) = max(line_status)
UNION ALL SELECT site, 'mon', min(mon), count(mon) FROM p GROUP BY site HAVING count(mon) >= 3 AND min(mon) = max(mon)""")
def constant_columns(t):
    rows = products(t).select(
        F.concat_ws("/", "site", F.year("scraped_at").cast("string"), "flag").alias("site"), "line_status", "flag",
        F.month("scraped_at").cast("string").alias("mon"),
    )
    return Q.constant_columns(rows, ["flag", "line_status", "mon"], min_rows=3)


# ---- pipeline log: one line for each event ----------------------------------------------------

LINES_SQL = """
lines AS (
  SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' WHEN 'signup' THEN 'DEBUG' WHEN 'view' THEN 'INFO' END AS level,
         CASE event_type WHEN 'error' THEN 'fetch failed' WHEN 'view' THEN CASE WHEN value < 20 THEN '0 URLs found' ELSE 'run completed' END ELSE 'other ' || event_type END AS info,
         'https://x.example/' || CAST(user_id AS VARCHAR) AS url
  FROM events)
"""


def log_lines(t):
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "click", "WARNING").when(kind == "signup", "DEBUG").when(kind == "view", "INFO")
    info = F.when(kind == "error", "fetch failed").when(
        kind == "view", F.when(F.col("value") < 20, "0 URLs found").otherwise("run completed")
    ).otherwise(F.concat(F.lit("other "), kind))
    body = F.to_json(F.struct(info.alias("info"), F.concat(F.lit("https://x.example/"), F.col("user_id").cast("string")).alias("url")))
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS")
    line = F.when(level.isNull(), F.concat_ws(" ", stamp, body)).otherwise(F.concat(stamp, F.lit(" ["), level, F.lit("] "), body))
    return t.events.select("event_id", line.alias("line"))


@query("parse_log", f"""
WITH {LINES_SQL} SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS ts, level, CASE WHEN level IS NOT NULL THEN info END AS info, CASE WHEN level IS NOT NULL THEN url END AS url FROM lines""")
def parse_log(t):
    out = SP.parse_log_lines(log_lines(t), "line", ("event_id",))
    return out.select("event_id", "ts", "level", F.when(F.col("level").isNotNull(), F.col("info")).alias("info"), "url")


@query("log_searches", f"""
WITH {LINES_SQL}
SELECT 'failed_fetches' AS search, count(*) AS n FROM lines WHERE level = 'ERROR' AND contains(info, 'fetch')
UNION ALL SELECT 'zero_url_discoveries', count(*) FROM lines WHERE level = 'INFO' AND contains(info, '0 URLs found')
UNION ALL SELECT 'completed_runs', count(*) FROM lines WHERE level = 'INFO' AND contains(info, 'completed')""")
def log_searches(t):
    lines = SP.parse_log_lines(log_lines(t), "line", ("event_id",))
    return Q.log_search_counts(lines)


@query("log_tail", f"""
WITH {LINES_SQL} SELECT event_id, level FROM lines WHERE level = 'WARNING' OR level IS NULL ORDER BY event_id DESC LIMIT 200""")
def log_tail(t):
    tail = Q.log_tail(log_lines(t), ["event_id"], "WARNING", 200)
    return tail.select("event_id", F.nullif(F.regexp_extract("line", r"\[([A-Z]+)\]", 1), F.lit("")).alias("level"))


@query("parse_yield", """
SELECT l_orderkey AS schedule_id, count(*) AS pages, count(*) FILTER (WHERE l_returnflag = 'A') AS records,
       count(*) FILTER (WHERE l_returnflag = 'A') / count(*)::DOUBLE AS yield FROM lineitem GROUP BY l_orderkey""")
def parse_yield(t):
    meta = t.lineitem.select(F.col("l_orderkey").alias("schedule_id"), "l_returnflag")
    return Q.parse_yield(meta, meta.filter(F.col("l_returnflag") == "A"))


@query("config_report", """
WITH p AS (SELECT n_nationkey AS site, 'no customers above 9900' AS problem FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)
           UNION ALL SELECT n_nationkey, 'no region rule' FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA'))
SELECT n_nationkey AS site, CASE WHEN count(problem) = 0 THEN 'OK' ELSE 'FAIL' END AS result, coalesce(string_agg(problem, '; ' ORDER BY problem), '') AS reasons
FROM nation LEFT JOIN p ON p.site = n_nationkey GROUP BY n_nationkey""")
def config_report(t):
    sites = t.nation.select(F.col("n_nationkey").alias("site"), "n_regionkey")
    rich = t.customer.filter("c_acctbal > 9900").select(F.col("c_nationkey").alias("site")).distinct()
    ruled = t.region.filter("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    problems = (
        sites.join(rich, "site", "left_anti").select("site", F.lit("no customers above 9900").alias("problem"))
        .union(sites.join(ruled, "n_regionkey", "left_anti").select("site", F.lit("no region rule").alias("problem")))
    )
    return Q.config_report(sites, problems, ["site"])


DLQ_SQL = """
dlq AS (SELECT CASE WHEN value < 20 THEN 'discovery' WHEN value < 60 THEN 'retriever' ELSE 'parser' END AS stage, event_id, 'u' || CAST(user_id AS VARCHAR) AS url,
               CASE WHEN value > 30 THEN 'site_' || CAST(user_id AS VARCHAR) END AS site, 'media_crawl' AS project, ts AS failed_at, props AS error, 2 AS retry_count
        FROM events WHERE event_type = 'error')
"""


def dlq(t, events=None):
    e = (t.events if events is None else events).filter(F.col("event_type") == "error")
    v = F.col("value")
    user = F.col("user_id").cast("string")
    return e.select(
        F.when(v < 20, "discovery").when(v < 60, "retriever").otherwise("parser").alias("stage"), "event_id", F.concat(F.lit("u"), user).alias("url"),
        F.when(v > 30, F.concat(F.lit("site_"), user)).alias("site"), F.lit("media_crawl").alias("project"), F.col("ts").alias("failed_at"),
        F.col("props").alias("error"), F.lit(2).alias("retry_count"),
    )


@query("browse_dlq", f"""
WITH {DLQ_SQL} SELECT stage, event_id, failed_at FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY failed_at DESC, event_id DESC) AS rn FROM dlq) WHERE rn <= 50""")
def browse_dlq(t):
    return Q.browse_dlq(dlq(t), tie="event_id").select("stage", "event_id", "failed_at")


@query("requeue_dlq", f"""
WITH {DLQ_SQL} SELECT stage, event_id, url, site, project, 0 AS retry_count, 3 AS priority, stage || '.' || coalesce(site, 'unknown') || '.' || project AS routing_key FROM dlq""")
def requeue_dlq(t):
    return Q.requeue(dlq(t))


@query("expire_dlq", f"WITH {DLQ_SQL} SELECT event_id FROM dlq WHERE failed_at > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR")
def expire_dlq(t):
    return Q.expire_dlq(dlq(t), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")).select("event_id")
