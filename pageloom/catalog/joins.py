"""Joins of metadata, pages, configs, states and workers."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import query
from pageloom.operators import frontier as FR, joins as J


@query("attach_pages", """
SELECT o_orderkey, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def attach_pages(t):
    meta = t.orders.select(F.col("o_orderkey").alias("url_key"))
    pages = t.lineitem.select(F.col("l_orderkey").alias("url_key"), "l_quantity")
    return J.attach_pages(meta, pages).groupBy(F.col("url_key").alias("o_orderkey")).agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query("missing_pages", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000)")
def missing_pages(t):
    done = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 400000)).select(F.col("o_custkey").alias("c_custkey"))
    return J.missing_pages(t.customer.select("c_custkey"), done, "c_custkey")


@query("with_config", "SELECT c_custkey, n_name AS site, n_regionkey AS project FROM customer JOIN nation ON n_nationkey = c_nationkey")
def with_config(t):
    config = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("site"), F.col("n_regionkey").alias("project"))
    return J.with_config(t.customer.select("c_custkey", "c_nationkey"), config, ["c_nationkey"]).select("c_custkey", "site", "project")


@query("overlay", """
WITH c AS (SELECT CASE WHEN c_custkey % 50 <> 7 THEN c_custkey END AS key, c_name AS name, c_acctbal AS balance FROM customer),
s AS (SELECT CASE WHEN s_suppkey <> 3 THEN s_suppkey END AS key, s_name AS name, s_acctbal AS balance, true AS top FROM supplier)
SELECT coalesce(c.key, s.key) AS key, CASE WHEN top THEN s.name ELSE c.name END AS name, CASE WHEN top THEN s.balance ELSE c.balance END AS balance,
       CASE WHEN top THEN 'top' ELSE 'base' END AS source
FROM c FULL JOIN s ON s.key IS NOT DISTINCT FROM c.key""")
def overlay(t):
    """Rows without a key meet like any others."""
    base = t.customer.select(F.when(F.col("c_custkey") % 50 != 7, F.col("c_custkey")).alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    top = t.supplier.select(F.when(F.col("s_suppkey") != 3, F.col("s_suppkey")).alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return J.overlay(base, top, "key")


@query("missing_rules", """
SELECT key, problem FROM (
  SELECT n_regionkey AS key, 'no_rule' AS problem FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')
  UNION SELECT n_nationkey, 'no_rule' FROM nation WHERE n_nationkey NOT IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA')
  UNION SELECT r_regionkey, 'no_field' FROM region WHERE r_name <> 'ASIA' AND r_regionkey NOT IN (SELECT n_regionkey FROM nation UNION SELECT n_nationkey FROM nation))""")
def missing_rules(t):
    fields = t.nation.select(F.col("n_regionkey").alias("key")).union(t.nation.select(F.col("n_nationkey").alias("key")))
    rules = t.region.filter(F.col("r_name") != "ASIA").select(F.col("r_regionkey").alias("key"))
    return J.missing_rules(fields, rules, ["key"])


@query("site_matrix", """
SELECT c_custkey AS site, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS has_discovery,
       EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '2-HIGH') AS has_retriever,
       EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey) AS has_parser, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS outputs
FROM customer""")
def site_matrix(t):
    orders = t.orders.select(F.col("o_custkey").alias("site"), "o_orderpriority")
    parts = {
        "discovery": orders.filter(F.col("o_orderpriority") == "1-URGENT"),
        "retriever": orders.filter(F.col("o_orderpriority") == "2-HIGH"),
        "parser": t.supplier.select(F.col("s_suppkey").alias("site")),
    }
    return J.site_matrix(t.customer.select(F.col("c_custkey").alias("site")), parts, orders)


@query("resolve_refs", "SELECT p_partkey, s_name AS author FROM part LEFT JOIN supplier ON s_suppkey = p_size")
def resolve_refs(t):
    return J.resolve_refs(t.part, t.supplier, "p_size", "s_suppkey").select("p_partkey", F.col("s_name").alias("author"))


_NOW = "TIMESTAMP '2024-01-30 23:00:00'"


@query("worker_view", f"""
WITH b AS (SELECT event_type AS hostname, user_id AS worker_id, ts FROM events WHERE ts <= {_NOW}),
last AS (SELECT hostname, worker_id, max(ts) AS last_seen FROM b GROUP BY 1, 2 HAVING max(ts) > {_NOW} - INTERVAL 12 HOUR),
jobs AS (SELECT event_type AS hostname, user_id AS worker_id, arg_max(props, ts) AS job FROM events WHERE value > 50 GROUP BY 1, 2)
SELECT hostname, worker_id, last_seen, job FROM last LEFT JOIN jobs USING (hostname, worker_id)""")
def worker_view(t):
    now = F.lit("2024-01-30 23:00:00").cast("timestamp_ntz")
    beats = t.events.select(F.col("event_type").alias("hostname"), F.col("user_id").alias("worker_id"), "ts", F.col("props").alias("job"), "value")
    return J.worker_view(beats.filter(F.col("ts") <= now), beats.filter(F.col("value") > 50), now, alive_s=12 * 3600)


@query("sites_not_done", "SELECT c_custkey AS site FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')")
def sites_not_done(t):
    done = t.orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select(F.col("o_custkey").alias("site"))
    return FR.pending(t.customer.select(F.col("c_custkey").alias("site")), done, "site")
