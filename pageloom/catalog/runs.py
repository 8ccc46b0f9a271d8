"""Run history analytics, orderings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import PRODUCTS_SQL, RUNS_SQL, products, query, runs
from pageloom.operators import frontier as FR, runs as R, scans


@query("run_kpis", f"""
WITH {RUNS_SQL}
SELECT CAST(sum(parser_records) AS BIGINT) AS total_records, CAST(sum(retriever_fetched) AS BIGINT) AS total_pages, CAST(sum(discovery_urls) AS BIGINT) AS total_urls,
       count(*) AS total_runs, count(*) FILTER (WHERE status = 'completed') AS completed_runs,
       count(*) FILTER (WHERE status = 'completed') * 100.0::DOUBLE / count(*) AS success_pct FROM runs""")
def run_kpis(t):
    return R.run_kpis(runs(t))


@query("stage_counts", f"""
WITH {RUNS_SQL}
SELECT CAST(sum(discovery_urls) AS BIGINT) AS discovery, CAST(sum(retriever_fetched) AS BIGINT) AS retriever, CAST(sum(parser_records) AS BIGINT) AS parser, count(*) AS runs
FROM runs WHERE project = 'media_crawl'""")
def stage_counts(t):
    return R.stage_counts(runs(t), project="media_crawl")


@query("records_by_site", f"""
WITH {RUNS_SQL}
SELECT site, project, CAST(sum(parser_records) AS BIGINT) AS records FROM runs GROUP BY 1, 2 ORDER BY records DESC, site, project LIMIT 15""")
def records_by_site(t):
    return R.records_by_site(runs(t))


@query("funnel", f"""
WITH {RUNS_SQL}, s AS (SELECT CAST(sum(discovery_urls) AS BIGINT) AS u, CAST(sum(retriever_fetched) AS BIGINT) AS p, CAST(sum(parser_records) AS BIGINT) AS r FROM runs)
SELECT 1 AS step, 'discovered' AS stage, u AS n, 100.0::DOUBLE AS pct_of_previous, 100.0::DOUBLE AS pct_of_first FROM s
UNION ALL SELECT 2, 'fetched', p, p * 100.0::DOUBLE / u, p * 100.0::DOUBLE / u FROM s
UNION ALL SELECT 3, 'parsed', r, r * 100.0::DOUBLE / p, r * 100.0::DOUBLE / u FROM s""")
def funnel(t):
    return R.funnel(runs(t))


@query("recent_runs", f"""
WITH {RUNS_SQL}
SELECT right(schedule_id, 8) AS run, parser_records, retriever_fetched, site, status FROM runs ORDER BY completed_at DESC, schedule_id DESC LIMIT 20""")
def recent_runs(t):
    return R.recent_runs(runs(t))


@query("status_counts", f"WITH {RUNS_SQL} SELECT status, count(*) AS n FROM runs GROUP BY status")
def status_counts(t):
    return R.status_counts(runs(t))


@query("durations", f"""
WITH {RUNS_SQL}
SELECT site, count(*) AS runs, CAST(sum(discovery_urls) * 60 AS DOUBLE) AS total_s, avg(discovery_urls) * 60 AS avg_s, CAST(sum(retriever_fetched) AS BIGINT) AS pages,
       CASE WHEN sum(retriever_fetched) > 0 THEN CAST(sum(discovery_urls) * 60 AS DOUBLE) / sum(retriever_fetched) END AS s_per_page FROM runs GROUP BY site""")
def durations(t):
    return R.durations(runs(t))


@query("doc_counts", "SELECT source, lang, count(*) AS docs FROM documents GROUP BY source, lang")
def doc_counts(t):
    return R.doc_counts(t.documents, ["source", "lang"])


@query("sites_per_project", "SELECT n_regionkey AS project, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS sites, count(DISTINCT n_name) AS n_sites FROM nation GROUP BY n_regionkey")
def sites_per_project(t):
    out = R.sites_per_project(t.nation.select(F.col("n_regionkey").alias("project"), F.col("n_name").alias("site")))
    return out.withColumn("sites", F.array_join("sites", ","))


@query("progress_pct", """
SELECT o_orderpriority AS phase, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS done,
       CAST(floor(count(*) FILTER (WHERE o_orderstatus = 'F') * 100 / count(*)) AS INTEGER) AS pct FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def progress_pct(t):
    tasks = t.orders.select(F.col("o_orderpriority").alias("phase"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("todo").alias("status"))
    return R.progress_pct(tasks)


@query("fill_rate", """
SELECT source AS site, field, avg(filled) AS rate FROM (
  SELECT source, 'text' AS field, (length(text) > 500)::INT AS filled FROM documents
  UNION ALL SELECT source, 'lang', (lang <> 'en')::INT FROM documents) GROUP BY source, field""")
def fill_rate(t):
    docs = t.documents.select(
        F.col("source").alias("site"), F.when(F.length("text") > 500, F.col("text")).alias("text"), F.when(F.col("lang") != "en", F.col("lang")).alias("lang")
    )
    return R.fill_rate(docs, ["text", "lang"])


@query("batch_totals", "SELECT count(*) AS total, count(*) FILTER (WHERE p_size > 10) AS ok FROM part")
def batch_totals(t):
    return R.batch_totals(t.part.select(F.when(F.col("p_size") > 10, F.col("p_name")).alias("product_name")))


# ---- orderings ------------------------------------------------------------------------------

@query("latest_per_site", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_per_site(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return scans.first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], last=True)


@query("newest_runs", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def newest_runs(t):
    return R.newest(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 50)


@query("dispatch_log", """
SELECT o_custkey AS site, o_orderkey AS schedule_id, CAST(left(o_orderpriority, 1) AS INTEGER) AS priority, o_orderdate AS dispatched_at FROM orders
WHERE o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 48 HOUR ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 200""")
def dispatch_log(t):
    """Dispatches of the last 48 hours, newest first, at most the 200 the report shows."""
    recent = t.orders.filter(F.col("o_orderdate") > F.lit("2001-07-30 00:00:00").cast("timestamp_ntz"))
    return R.newest(recent, ["o_orderdate", "o_orderkey"], 200).select(
        F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("schedule_id"),
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("priority"), F.col("o_orderdate").alias("dispatched_at"),
    )


@query("custom_order", """
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS sort_rank FROM orders""")
def custom_order(t):
    return R.custom_order(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "F"], ["o_orderkey"])


@query("queue_position", f"""
WITH {RUNS_SQL}
SELECT schedule_id, priority, row_number() OVER (ORDER BY priority DESC, completed_at, schedule_id) AS position FROM runs""")
def queue_position(t):
    rows = runs(t).select("schedule_id", "priority", "completed_at")
    return scans.position_by_level(rows, "priority", "completed_at", "schedule_id", "position").drop("completed_at")


@query("union_lists", "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def union_lists(t):
    a = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return a.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")))


@query("distinct_hosts", "SELECT DISTINCT regexp_extract(url, '//([^/?#]*)', 1) AS host FROM pages")
def distinct_hosts(t):
    return t.pages.select(F.regexp_extract("url", "//([^/?#]*)", 1).alias("host")).distinct()


@query("top_products_per_site", f"""
WITH {PRODUCTS_SQL}, m AS (SELECT site, product_id, CAST(max(selling_price) AS DOUBLE) AS price FROM products GROUP BY 1, 2)
SELECT site, product_id, price FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY price DESC, product_id) AS rn FROM m) WHERE rn <= 10""")
def top_products_per_site(t):
    best = products(t).groupBy("site", "product_id").agg(F.max("selling_price").cast("double").alias("price"))
    return scans.top_per_group(best, ["site"], [F.desc("price"), F.col("product_id")], 10)


@query("dedup_products", f"WITH {PRODUCTS_SQL} SELECT DISTINCT site, product_id FROM products")
def dedup_products(t):
    return FR.dedup_in_run(products(t).select("site", "product_id"), ["site", "product_id"])


@query("queue_position_unranked", f"""
WITH {RUNS_SQL}, r AS (SELECT schedule_id, CASE WHEN priority <> 3 THEN priority END AS priority, completed_at FROM runs)
SELECT schedule_id, priority, row_number() OVER (ORDER BY priority DESC NULLS LAST, completed_at, schedule_id) AS position FROM r""")
def queue_position_unranked(t):
    """Runs without a priority come last, none is lost."""
    rows = runs(t).select("schedule_id", F.when(F.col("priority") != 3, F.col("priority")).alias("priority"), "completed_at")
    return scans.position_by_level(rows, "priority", "completed_at", "schedule_id", "position").drop("completed_at")
