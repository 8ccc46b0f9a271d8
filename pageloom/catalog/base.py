"""Query registry, table access and the views the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pageloom.session import pin_utc, ship_package, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """`t.pages`, `t.orders`, ... read lazily from one folder; derived views are methods."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        ship_package(spark)
        pin_utc(spark)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """A table ahead of a CPU-heavy step; only a small scan is repartitioned."""
        df = getattr(self, name)
        return spread(df.select(*columns) if columns else df)


def query(name: str, sql: str | None = None):
    """Register `fn(t: Tables) -> DataFrame`, with the SQL that must give the same rows."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


# ---- runs: one for each order, counters from its lines -------------------------------------

RUNS_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag <> 'R') AS kept,
         count(*) FILTER (WHERE l_returnflag <> 'R' AND l_linestatus = 'F') AS done
  FROM lineitem GROUP BY l_orderkey),
runs AS (
  SELECT CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'media_crawl' ELSE 'commerce_crawl' END AS project,
         'site_' || CAST(o_custkey AS VARCHAR) AS site, 'run' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS schedule_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed' ELSE 'running' END AS status,
         o_orderdate - to_seconds(CAST(coalesce(n, 0) AS BIGINT) * 60) AS started_at, o_orderdate AS completed_at,
         coalesce(n, 0) AS discovery_urls, coalesce(n, 0) AS retriever_total, coalesce(kept, 0) AS retriever_fetched,
         coalesce(kept, 0) AS parser_pages, coalesce(done, 0) AS parser_records,
         CAST(left(o_orderpriority, 1) AS INTEGER) AS priority
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)
"""


def runs(t: Tables) -> DataFrame:
    kept = F.col("l_returnflag") != "R"
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.count_if(kept).alias("kept"),
        F.count_if(kept & (F.col("l_linestatus") == "F")).alias("done"),
    )
    n = F.coalesce("n", F.lit(0))
    kept_n = F.coalesce("kept", F.lit(0))
    first = F.left("o_orderpriority", F.lit(1))
    return t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        F.when(first.isin("1", "2"), "media_crawl").otherwise("commerce_crawl").alias("project"),
        F.concat(F.lit("site_"), F.col("o_custkey").cast("string")).alias("site"),
        F.concat(F.lit("run"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("schedule_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed")
        .otherwise("running").alias("status"),
        (F.col("o_orderdate") - F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))).alias("started_at"),
        F.col("o_orderdate").alias("completed_at"),
        n.alias("discovery_urls"), n.alias("retriever_total"), kept_n.alias("retriever_fetched"),
        kept_n.alias("parser_pages"), F.coalesce("done", F.lit(0)).alias("parser_records"),
        first.cast("int").alias("priority"),
    )


# ---- fetch log: one row for each event ------------------------------------------------------

LOG_SQL = """
log AS (
  SELECT ts, event_id, user_id AS endpoint,
         CASE WHEN event_type IN ('view', 'error') THEN 'www.' ELSE '' END || 'd' || json_extract_string(props, '$.k') || '.example.com' AS domain,
         event_type <> 'error' AS ok, event_type = 'error' AND value < 20 AS blocked,
         CASE WHEN event_type <> 'error' THEN 200 WHEN value < 20 THEN 403 WHEN value < 60 THEN 429
              WHEN value < 120 THEN 500 ELSE 404 END AS status_code,
         CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS strategy,
         value AS latency_ms
  FROM events)
"""


def fetch_log(t: Tables, events: DataFrame | None = None) -> DataFrame:
    e = t.events if events is None else events
    failed = F.col("event_type") == "error"
    value = F.col("value")
    strategy = F.lit(5)
    for name, level in (("view", 0), ("click", 2), ("signup", 3), ("purchase", 4)):
        strategy = F.when(F.col("event_type") == name, level).otherwise(strategy)
    host = F.concat(
        F.when(F.col("event_type").isin("view", "error"), "www.").otherwise(""), F.lit("d"), F.get_json_object("props", "$.k"),
        F.lit(".example.com"),
    )
    return e.select(
        "ts", "event_id", F.col("user_id").alias("endpoint"), host.alias("domain"), (~failed).alias("ok"),
        (failed & (value < 20)).alias("blocked"),
        F.when(~failed, 200).when(value < 20, 403).when(value < 60, 429).when(value < 120, 500).otherwise(404).alias("status_code"),
        strategy.alias("strategy"), value.alias("latency_ms"),
    )


def domain_log(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """The log with few domains, so that windows by domain hold several rows."""
    return fetch_log(t, events).withColumn("domain", F.concat(F.lit("d"), F.col("strategy").cast("string"), F.lit(".example.com")))


DOMAIN_LOG_SQL = LOG_SQL + """,
dlog AS (SELECT * REPLACE ('d' || CAST(strategy AS VARCHAR) || '.example.com' AS domain) FROM log)
"""

# ---- products: one for each line ------------------------------------------------------------

PRODUCTS_SQL = """
products AS (
  SELECT l_partkey AS product_id, 's' || CAST(l_suppkey AS VARCHAR) AS site, l_shipdate AS scraped_at,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS list_price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2)) AS selling_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_percentage,
         l_returnflag AS flag, l_linestatus AS line_status, l_orderkey, l_linenumber, l_quantity, l_tax
  FROM lineitem)
"""


def products(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("product_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("site"),
        F.col("l_shipdate").alias("scraped_at"), F.col("l_extendedprice").cast("decimal(12,2)").alias("list_price"),
        F.round(F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")), 2)
        .cast("decimal(12,2)").alias("selling_price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_percentage"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line_status"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax",
    )


# ---- crawls: the labelled documents were crawled before, toxic ones with another text ------

CRAWLS_SQL = """
before AS (
  SELECT 'https://' || d.source || '.example.com/' || d.lang || '/' || CAST(d.doc_id AS VARCHAR) AS url,
         md5(CASE WHEN l.toxic = 1 THEN d.text || ' (old)' ELSE d.text END) AS hash,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(least(d.n_chars // 100, 59) AS INTEGER)) AS last_crawled,
         TIMESTAMP '2023-06-01 00:00:00' AS first_seen, CAST(l.quality AS BIGINT) AS change_count
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
batch AS (
  SELECT 'https://' || source || '.example.com/' || lang || '/' || CAST(doc_id AS VARCHAR) AS url, md5(text) AS hash, doc_id
  FROM documents)
"""


def _doc_url():
    return F.concat(
        F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string")
    )


def crawl_before(t: Tables) -> DataFrame:
    text = F.when(F.col("toxic") == 1, F.concat(F.col("text"), F.lit(" (old)"))).otherwise(F.col("text"))
    return t.documents.join(t.labels, "doc_id").select(
        _doc_url().alias("url"), F.md5(F.encode(text, "UTF-8")).alias("hash"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.least(F.floor(F.col("n_chars") / 100), F.lit(59)).cast("int"))).alias("last_crawled"),
        F.lit("2023-06-01 00:00:00").cast("timestamp_ntz").alias("first_seen"),
        F.col("quality").cast("bigint").alias("change_count"),
    )


def crawl_batch(t: Tables) -> DataFrame:
    return t.documents.select(_doc_url().alias("url"), F.md5(F.encode(F.col("text"), "UTF-8")).alias("hash"), "doc_id")
