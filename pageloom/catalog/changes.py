"""Change detection between two crawls of the documents, and between events as page versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import CRAWLS_SQL, crawl_batch, crawl_before, query
from pageloom.operators import changes as CH
from pageloom.session import new_folder
from pageloom.sources.state import StateTable

NOW = "2024-02-15 00:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


CHANGES_SQL = f"""
{CRAWLS_SQL},
changes AS (SELECT b.url, CASE WHEN s.hash IS NULL THEN 'new' WHEN s.hash = b.hash THEN 'unchanged' ELSE 'modified' END AS change_type,
                   s.hash AS old_hash, b.hash AS new_hash FROM batch b LEFT JOIN before s USING (url))
"""
VERSIONS_SQL = """
known AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS url, 'view' AS hash FROM customer WHERE c_acctbal > 5000),
versions AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS url, ts, event_id, event_type AS hash FROM events),
lagged AS (SELECT v.*, coalesce(lag(v.hash) OVER (PARTITION BY v.url ORDER BY ts, event_id), k.hash) AS old_hash FROM versions v LEFT JOIN known k USING (url))
"""


def versions(t):
    """Events as page versions: the event type is the content."""
    return t.events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), "ts", "event_id", F.col("event_type").alias("hash"))


def known(t):
    return t.customer.filter("c_acctbal > 5000").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"), F.lit("view").alias("hash")
    )


@query("content_hash", "SELECT doc_id, md5(text) AS hash FROM documents")
def content_hash(t):
    return t.documents.select("doc_id", CH.content_hash(F.col("text")).alias("hash"))


@query("detect_changes", f"WITH {CHANGES_SQL} SELECT url, change_type, old_hash, new_hash, change_type <> 'unchanged' AS changed FROM changes")
def detect_changes(t):
    return CH.detect_changes(crawl_before(t), crawl_batch(t))


_ADVANCED = f"""
WITH {CRAWLS_SQL},
advanced AS (
  SELECT coalesce(b.url, s.url) AS url, coalesce(b.hash, s.hash) AS hash, coalesce(s.first_seen, TIMESTAMP '{NOW}') AS first_seen,
         CASE WHEN b.url IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE s.last_crawled END AS last_crawled,
         coalesce(s.change_count, 0) + CASE WHEN s.hash <> b.hash THEN 1 ELSE 0 END AS change_count
  FROM before s FULL JOIN (SELECT * FROM batch WHERE url NOT LIKE '%/de/%') b ON b.url = s.url)
"""


def _advanced(t):
    batch = crawl_batch(t).filter(~F.contains("url", F.lit("/de/")))
    return CH.advance_state(crawl_before(t), batch, _now())


@query("advance_state", _ADVANCED + "SELECT * FROM advanced")
def advance_state(t):
    return _advanced(t)


@query("merge_state", f"""
WITH {CRAWLS_SQL},
crawls AS (
  SELECT CASE WHEN doc_id % 4 = 3 THEN NULL ELSE url END AS url, hash, doc_id % 3 AS n FROM batch),
each AS (SELECT url, n, max(hash) AS hash FROM crawls GROUP BY url, n),
steps AS (
  SELECT url, n, hash, lag(hash) OVER (PARTITION BY url ORDER BY n) AS old FROM (
    SELECT url, -1 AS n, hash FROM before UNION ALL SELECT url, n, hash FROM each))
SELECT url, arg_max(hash, n) AS hash, CASE WHEN max(n) >= 0 THEN TIMESTAMP '{NOW}' + to_days(CAST(max(n) AS INTEGER)) END AS last_crawled,
       count(*) FILTER (WHERE old IS NOT NULL AND old <> hash) AS changes
FROM steps GROUP BY url""")
def merge_state(t):
    """Three crawls, each sent twice, merged into a state that held the labelled documents; some rows have no URL."""
    table = StateTable(t.spark, new_folder(t.spark, "state"), CH.STATE, "url", 16)
    before = crawl_before(t).withColumns({c: F.col(c).cast("timestamp") for c in ("first_seen", "last_crawled")})
    table.merge(before.withColumns({"change_count": F.lit(0).cast("bigint"), "last_crawled": F.lit(None).cast("timestamp")}), lambda state, rows: rows, "before")
    crawls = crawl_batch(t).withColumn("url", F.when(F.col("doc_id") % 4 != 3, F.col("url")))
    for n in range(3):
        for _ in range(2):
            now = (_now() + F.make_dt_interval(F.lit(n))).cast("timestamp")
            CH.merge_crawl(table, crawls.filter(F.col("doc_id") % 3 == n), now, n)
    table.vacuum()
    return table.read().select("url", "hash", F.col("last_crawled").cast("timestamp_ntz").alias("last_crawled"), F.col("change_count").alias("changes"))


@query("change_stats", _ADVANCED + "SELECT count(*) AS total_urls, CAST(sum(change_count) AS BIGINT) AS total_changes FROM advanced")
def change_stats(t):
    return CH.change_stats(_advanced(t))


@query("expire_state", f"WITH {CRAWLS_SQL} SELECT url, last_crawled FROM before WHERE last_crawled > TIMESTAMP '{NOW}' - INTERVAL 30 DAY")
def expire_state(t):
    return CH.expire_state(crawl_before(t), _now()).select("url", "last_crawled")


@query("detect_changes_ordered", f"""
WITH {VERSIONS_SQL}
SELECT url, ts, event_id, CASE WHEN old_hash IS NULL THEN 'new' WHEN old_hash = hash THEN 'unchanged' ELSE 'modified' END AS change_type, old_hash, hash AS new_hash,
  old_hash IS NULL OR old_hash <> hash AS changed FROM lagged""")
def detect_changes_ordered(t):
    return CH.detect_changes_ordered(known(t), versions(t), "ts", "event_id")


@query("changed_pages", f"""
WITH {CHANGES_SQL} SELECT doc_id, n_chars FROM documents JOIN batch USING (doc_id) JOIN changes USING (url) WHERE change_type <> 'unchanged'""")
def changed_pages(t):
    pages = crawl_batch(t).join(t.documents.select("doc_id", "n_chars"), "doc_id")
    changes = CH.detect_changes(crawl_before(t), crawl_batch(t))
    return CH.changed_pages(pages, changes).select("doc_id", "n_chars")
