"""Sources and sinks, as round trips of the given tables through the shared folder."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pageloom.catalog.base import query
from pageloom.session import new_folder
from pageloom.sources import bulkindex as BI, pages as SP, pagestore as PS, records as SR
from pageloom.streaming import streams as ST


@query("page_store_round_trip", """
SELECT page_id, 'web' AS project, regexp_replace(regexp_extract(url, '//([^/?#]*)', 1), '^www\\.', '') AS domain, '2026-03-11' AS date, md5(url) AS url_md5, CAST(length(html) AS INTEGER) AS n FROM pages""")
def page_store_round_trip(t):
    path = new_folder(t.spark, "pages")
    pages = t.pages.withColumns({"project": F.lit("web"), "fetched_at": F.lit("2026-03-11 10:00:00").cast("timestamp_ntz")})
    SP.write_pages(pages, path)
    return SP.read_page_table(t.spark, path).select(
        "page_id", "project", "domain", F.col("date").cast("string").alias("date"), "url_md5", F.length("html").alias("n")
    )


STORED_SQL = """
stored AS (
  SELECT CASE WHEN contains(url, '/en/') THEN 'news' ELSE 'shop' END AS project, regexp_replace(regexp_extract(url, '//([^/?#]*)', 1), '^www\\.', '') AS domain,
         CASE WHEN page_id % 2 = 0 THEN '2026-03-11' ELSE '2026-03-12' END AS date, md5(url) AS url_md5, html, page_id
  FROM pages)
"""


def _to_store(t):
    """All pages in two loads, those of the second day last; returns the store's address."""
    root = new_folder(t.spark, "store")
    day = F.when(F.col("page_id") % 2 == 0, "2026-03-11 10:00:00").otherwise("2026-03-12 10:00:00").cast("timestamp_ntz")
    project = F.when(F.contains("url", F.lit("/en/")), "news").otherwise("shop")
    rows = t.pages.withColumns({"project": project, "fetched_at": day})
    for n in (0, 1):
        PS.write_page_store(rows.filter(F.col("page_id") % 2 == n), root)
    return root


@query("page_store_source", f"""
WITH {STORED_SQL}
SELECT project, domain, date, url_md5, CAST(length(max(html)) AS INTEGER) AS n, md5(max(html)) AS hash FROM stored WHERE project = 'shop' AND date = '2026-03-12' GROUP BY ALL""")
def page_store_source(t):
    """Gzipped pages written and read by tasks through the data source; filters prune its folders."""
    pages = t.spark.read.format("pagestore").option("splits", 16).load(_to_store(t))
    return pages.filter("project = 'shop' AND date IN ('2026-03-12')").select(
        "project", "domain", "date", "url_md5", F.length("html").alias("n"), F.md5(F.encode("html", "UTF-8")).alias("hash"))


@query("page_files", f"WITH {STORED_SQL} SELECT project, domain, date, url_md5, md5(max(html)) AS hash FROM stored GROUP BY ALL")
def page_files(t):
    """The same files through Spark's own file source."""
    pages = SP.read_pages(t.spark, _to_store(t))
    return pages.select("project", "domain", "date", "url_md5", F.md5(F.encode("html", "UTF-8")).alias("hash"))


@query("page_store_stream", f"WITH {STORED_SQL} SELECT project, date, url_md5, md5(max(html)) AS hash FROM stored GROUP BY ALL")
def page_store_stream(t):
    """The store as a stream of its committed loads."""
    pages = t.spark.readStream.format("pagestore").load(_to_store(t))
    return ST.drain(pages.select("project", "date", "url_md5", F.md5(F.encode("html", "UTF-8")).alias("hash")), "store-stream")


def flaky(path: str, batch: str, task: str):
    """A client that is down for every other request, and takes no document of over 3,000 characters."""
    store, calls = BI.FileClient(path, batch, task), [0]

    def send(docs: list[dict]) -> dict[str, str]:
        calls[0] += 1
        if calls[0] % 2:
            raise ConnectionError("down")
        errors = {d["doc_id"]: "too long" for d in docs if json.loads(d["doc"])["n_chars"] > 3000}
        store([d for d in docs if d["doc_id"] not in errors])
        return errors

    return send


_BULK_SQL = """
sent AS (
  SELECT CASE WHEN doc_id % 10 <> 9 THEN md5(CAST(doc_id AS VARCHAR)) END AS doc_id, n_chars, 'first' AS load FROM documents
  UNION ALL SELECT md5(CAST(d.doc_id AS VARCHAR)), n_chars, 'second' FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""


def _bulk(t):
    """Two batches, the first of them sent a second time with other documents: that one is not sent."""
    path = new_folder(t.spark, "bulk")
    t.spark.dataSource.register(BI.bulk_index(flaky))
    key = F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    docs = t.documents.join(t.labels.select("doc_id", F.lit(1).alias("labelled")), "doc_id", "left")
    for batch, load, rows, doc_id in (
        ("1", "first", docs, F.when(F.col("doc_id") % 10 != 9, key)), ("2", "second", docs.filter("labelled = 1"), key), ("1", "again", docs, key),
    ):
        records = rows.select(doc_id.alias("uniq_id"), "n_chars", F.lit(load).alias("load"))
        SR.index_docs(records, "web").write.format("bulkindex").mode("append").option("batch", batch).option("wait", 0.01).save(path)
    return path


@query("bulk_index_documents", f"""
WITH {_BULK_SQL} SELECT doc_id, max(load) AS load FROM sent WHERE doc_id IS NOT NULL AND n_chars <= 3000 GROUP BY doc_id""")
def bulk_index_documents(t):
    """The index behind a flaky client: one document for each key, of the last batch that has it."""
    docs = BI.documents(t.spark, _bulk(t))
    return docs.select("doc_id", F.get_json_object("doc", "$.load").alias("load"))


@query("bulk_index_rejects", f"""
WITH {_BULK_SQL} SELECT doc_id, load, CASE WHEN doc_id IS NULL THEN 'no uniq_id' ELSE 'too long' END AS error FROM sent WHERE doc_id IS NULL OR n_chars > 3000""")
def bulk_index_rejects(t):
    """All documents that two batches could not place, and why."""
    return BI.rejects(t.spark, _bulk(t)).select("doc_id", F.get_json_object("doc", "$.load").alias("load"), "error")


@query("fetch_metadata", """
SELECT url, CAST(page_id + 1 AS INTEGER) AS rank, 'out/' || md5(url) || '.html' AS output_file, md5(url || '|{''rank'': ' || CAST(page_id + 1 AS VARCHAR) || '}') AS uniq_id FROM pages""")
def fetch_metadata(t):
    path = new_folder(t.spark, "metadata")
    key = F.concat(F.col("url"), F.lit("|{'rank': "), (F.col("page_id") + 1).cast("string"), F.lit("}"))
    line = F.to_json(F.struct(key.alias("url"), F.concat(F.lit("out/"), F.md5(F.encode("url", "UTF-8")), F.lit(".html")).alias("output_file")))
    # every line is followed by a blank one
    t.pages.select(F.concat(line, F.lit("\n")).alias("value")).write.text(path)
    return SP.read_fetch_metadata(t.spark, path).select("url", "rank", "output_file", "uniq_id")


@query("records_csv_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, CAST(length(text) AS INTEGER) AS n, md5(text) AS hash FROM documents")
def records_csv_round_trip(t):
    path = new_folder(t.spark, "csv")
    SR.write_records_csv(t.documents, path, ["doc_id", "source", "text"])
    back = SR.read_records_csv(t.spark, path)
    return back.select("doc_id", "source", F.length("text").alias("n"), F.md5(F.encode("text", "UTF-8")).alias("hash"))


@query("merge_sites", """
SELECT 'customer' AS site_name, '20260426001' AS schedule_id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', '20260426001', s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def merge_sites(t):
    parts = {
        "customer": t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment")),
        "supplier": t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")),
    }
    return SR.merge_sites(parts, "20260426001")


@query("merge_site_files", """
SELECT 'small_shop' AS site_name, '7' AS schedule_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS extra FROM supplier
UNION ALL SELECT 'nation', '7', n_name, NULL FROM nation""")
def merge_site_files(t):
    root = new_folder(t.spark, "merge")
    SR.write_records_csv(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("extra")), f"{root}/small_shop_web_7", ["name", "extra"])
    SR.write_records_csv(t.nation.select(F.col("n_name").alias("name")), f"{root}/nation_web_7", ["name"])
    return SR.merge_site_files(t.spark, root, "web", "7")


@query("backfill_records", """
SELECT 'web' AS project, 'small_shop' AS site, '7' AS schedule_id, s_name AS name FROM supplier
UNION ALL SELECT 'web', 'big', '8', c_name FROM customer""")
def backfill_records(t):
    root = new_folder(t.spark, "backfill")
    SR.write_records_csv(t.supplier.select(F.col("s_name").alias("name")), f"{root}/web/small_shop_web_7", ["name"])
    SR.write_records_csv(t.customer.select(F.col("c_name").alias("name")), f"{root}/web/big_web_8", ["name"])
    return SR.backfill_records(t.spark, root)


@query("backfill_headers", """
SELECT 'a' AS site, s_name AS name, CAST(s_nationkey AS VARCHAR) AS price, 'red, "x"' AS color, NULL AS sku FROM supplier
UNION ALL SELECT 'b', c_name, NULL, NULL, CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT 'c', n_name, CAST(n_regionkey AS VARCHAR), NULL, NULL FROM nation""")
def backfill_headers(t):
    """Three sites whose headers differ in columns and order."""
    root = new_folder(t.spark, "backfill")
    a = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("price"), F.lit('red, "x"').alias("color"))
    b = t.customer.select(F.col("c_custkey").alias("sku"), F.col("c_name").alias("name"))
    c = t.nation.select(F.col("n_regionkey").alias("price"), F.col("n_name").alias("name"))
    for site, df in (("a", a), ("b", b), ("c", c)):
        SR.write_records_csv(df, f"{root}/web/{site}_web_1", df.columns)
    return SR.backfill_records(t.spark, root).select("site", "name", "price", "color", "sku")


@query("backfill_index", """
SELECT 'web' AS index, s_name AS doc_id, CAST(s_nationkey AS VARCHAR) AS price FROM supplier
UNION ALL SELECT 'web', n_name, NULL FROM nation""")
def backfill_index(t):
    """From the record files of two sites to the documents of the index."""
    root, out = new_folder(t.spark, "backfill"), new_folder(t.spark, "index")
    SR.write_records_csv(t.supplier.select(F.col("s_name").alias("uniq_id"), F.col("s_nationkey").alias("price")), f"{root}/web/a_web_1", ["uniq_id", "price"])
    SR.write_records_csv(t.nation.select(F.col("n_regionkey").alias("note"), F.col("n_name").alias("uniq_id")), f"{root}/web/b_web_1", ["note", "uniq_id"])
    SR.backfill_index(t.spark, root, out)
    return t.spark.read.parquet(out).select("index", "doc_id", F.get_json_object("doc", "$.price").alias("price"))


@query("index_docs", """
SELECT 'web-crawl' AS index, md5(CAST(doc_id AS VARCHAR)) AS doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang, n_chars,
       'shop' AS site_name, '2026-03-11T23:26:23.000Z' AS stamp FROM documents""")
def index_docs(t):
    records = t.documents.select(
        F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("uniq_id"), F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"),
        "n_chars", F.lit("shop").alias("site_name"), F.lit("2026-03-11 23:26:23").alias("crawl_timestamp"),
    )
    doc = F.col("doc")
    return SR.index_docs(records, "WEB_crawl").select(
        "index", "doc_id", F.get_json_object(doc, "$.lang").alias("lang"), F.get_json_object(doc, "$.n_chars").cast("bigint").alias("n_chars"),
        F.get_json_object(doc, "$.site_name").alias("site_name"), F.get_json_object(doc, "$['@timestamp']").alias("stamp"),
    )


@query("index_load_twice", """
SELECT md5(text) AS _id, 'web' AS _index FROM documents GROUP BY 1""")
def index_load_twice(t):
    """Two loads of the same records leave one document for each key."""
    path = new_folder(t.spark, "index")
    records = t.documents.select(F.md5(F.encode("text", "UTF-8")).alias("uniq_id"), "lang", "source")
    for _ in range(2):
        SR.write_index_docs(records, "web", path)
    return SR.read_index(t.spark, path).select(F.col("doc_id").alias("_id"), F.col("index").alias("_index"))


@query("index_two_loads", """
SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'second' ELSE 'first' END AS load FROM documents""")
def index_two_loads(t):
    """Other records loaded into the same index leave it as it is; a key of both loads has the later document."""
    path = new_folder(t.spark, "index")
    key = F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("uniq_id")
    SR.write_index_docs(t.documents.select(key, F.lit("first").alias("mark")), "web", path, load="1")
    SR.write_index_docs(t.labels.select(key, F.lit("second").alias("mark")), "web", path, load="2")
    return SR.read_index(t.spark, path).select("doc_id", F.get_json_object("doc", "$.mark").alias("load"))


@query("page_store_two_loads", """
SELECT page_id, CASE WHEN contains(url, '/en/') THEN 'second' ELSE 'first' END AS load FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages) WHERE n = 1""")
def page_store_two_loads(t):
    """Two loads of one day: pages of the first stay, those loaded again come from the second."""
    path = new_folder(t.spark, "pages")
    one = t.pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
    for load, rows in (("first", one), ("second", one.filter(F.contains("url", F.lit("/en/"))))):
        SP.write_pages(rows.withColumns({
            "project": F.lit("web"), "fetched_at": F.lit("2026-03-11 10:00:00").cast("timestamp_ntz"), "html": F.lit(load)}), path, load)
    return SP.read_page_table(t.spark, path).select("page_id", F.col("html").alias("load"))


@query("index_rejects", """
SELECT md5(CAST(doc_id AS VARCHAR)) AS doc_id, 'too long' AS error FROM documents WHERE n_chars > 3000""")
def index_rejects(t):
    """Documents a writer refuses come back as rejects."""
    records = t.documents.select(F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("uniq_id"), "n_chars")

    def writer(batch):
        return {d["doc_id"]: "too long" for d in batch if json.loads(d["doc"])["n_chars"] > 3000}

    return SR.send_batches(SR.index_docs(records, "web"), writer).select("doc_id", "error")


@query("index_upsert", """
SELECT md5(CAST(d.doc_id AS VARCHAR)) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'first' ELSE 'second' END AS load FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def index_upsert(t):
    path = new_folder(t.spark, "upsert")
    key = F.md5(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("uniq_id")
    SR.index_docs(t.documents.select(key, F.lit("first").alias("load")), "web").write.parquet(f"{path}/0")
    second = SR.index_docs(t.labels.select(key, F.lit("second").alias("load")), "web")
    merged = SR.upsert_index(t.spark, f"{path}/0", second, f"{path}/1")
    return merged.select("doc_id", F.get_json_object("doc", "$.load").alias("load"))


@query("sitemap_xml", "SELECT url AS loc FROM pages")
def sitemap_xml(t):
    path = new_folder(t.spark, "sitemap")
    rows = t.pages.select(F.col("url").alias("loc"), F.lit("2026-01-01").alias("lastmod"))
    rows.write.format("xml").option("rootTag", "urlset").option("rowTag", "url").save(path)
    return SP.read_sitemap(t.spark, path).select("loc")


@query("sitemap_text", "SELECT page_id, 0 AS pos, url AS loc FROM pages UNION ALL SELECT page_id, 1, 'https://x.example/' || CAST(page_id AS VARCHAR) FROM pages")
def sitemap_text(t):
    loc = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    xml = F.concat(F.lit("<urlset><url><loc>\n "), loc, F.lit("</loc></url><url><loc>https://x.example/"), F.col("page_id").cast("string"), F.lit("</loc></url></urlset>"))
    return SP.sitemap_urls(t.pages.select("page_id", xml.alias("xml")), keep=("page_id",))


@query("listing_items", """
SELECT p_partkey, 3 AS page, CAST(135 + i AS INTEGER) AS rank, 'https://shop.example/p/' || x AS url FROM (
  SELECT p_partkey, unnest([1, 2, 3]) AS i, unnest([CAST(p_partkey AS VARCHAR), p_brand, p_type]) AS x FROM part)""")
def listing_items(t):
    """A listing payload of each part: rank = page x 45 + position, blank and repeated items dropped."""
    item = lambda c: F.struct(F.concat(F.lit("/p/"), c).alias("url"), F.col("p_name").alias("title"))
    blank = F.struct(F.lit("").alias("url"), F.lit("x").alias("title"))
    key, brand, kind = F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_type")
    body = F.to_json(F.struct(
        F.array(item(key), blank, item(brand), item(key), item(kind)).alias("products"), F.struct(F.lit(3).alias("currentPage")).alias("pagination")
    ))
    return SP.listing_items(t.part.select("p_partkey", body.alias("j")), "j", site_root="https://shop.example", keep=("p_partkey",))


@query("listing_articles", """
SELECT p_partkey, 0 AS pos, 'https://news.example/' || lower(p_type) || '/features/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS VARCHAR) AS url FROM part""")
def listing_articles(t):
    article = F.struct(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"))
    no_id = F.struct(F.lit(None).cast("string").alias("id"), F.lit("x").alias("title"))
    body = F.to_json(F.struct(F.col("p_type").alias("categoryname"), F.array(article, no_id).alias("articles")))
    return SP.listing_articles(t.part.select("p_partkey", body.alias("j")), "j", "https://news.example", ("p_partkey",))


@query("pipeline_log_file", "SELECT CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, count(*) AS n FROM events GROUP BY 1")
def pipeline_log_file(t):
    path = new_folder(t.spark, "log")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    t.events.select(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS"), F.lit(" ["), level, F.lit("] "), F.col("props")).alias("value")).write.text(path)
    return SP.read_pipeline_log(t.spark, path).groupBy("level").agg(F.count("*").alias("n"))


@query("run_status", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'history' ELSE 'current' END AS place, 'media_crawl__s' || CAST(o_custkey AS VARCHAR) || '__' || CAST(o_orderkey AS VARCHAR) AS run_key,
       o_custkey AS discovery_urls, CAST(o_orderdate AS TIMESTAMP) AS started_at FROM orders""")
def run_status(t):
    """Status documents, one for each order: open ones in the map, finished ones in the list, the others in the old form with a single run."""
    path = new_folder(t.spark, "status")
    site, sid = F.concat(F.lit("s"), F.col("o_custkey").cast("string")), F.col("o_orderkey").cast("string")
    run = F.struct(
        F.lit("media_crawl").alias("project"), site.alias("site"), sid.alias("schedule_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("started_at"),
        F.create_map(F.lit("discovery_urls"), F.col("o_custkey")).alias("progress"),
    )
    status = F.col("o_orderstatus")
    doc = F.struct(
        F.when(status == "O", F.create_map(F.concat_ws("__", F.lit("media_crawl"), site, sid), run)).alias("current_runs"),
        F.when(status == "F", F.array(run)).alias("last_runs"), F.when(~status.isin("O", "F"), run).alias("current_run"),
    )
    t.orders.select(F.to_json(doc).alias("value")).write.text(path)
    runs = SR.flatten_runs(t.spark.read.schema(SR.schemas.RUN_STATUS).json(path))
    return runs.select("place", "run_key", "discovery_urls", F.col("started_at").cast("timestamp_ntz").alias("started_at"))


@query("site_config_files", """
SELECT 'r' || CAST(n_regionkey AS VARCHAR) AS project, lower(n_name) AS site, 'https://' || n_name || '.example/' AS seed, 'get_pages' AS method1, 'get_items' AS method2, '30' AS timeout FROM nation""")
def site_config_files(t):
    """YAML config files, one for each nation, written by project folder and read back."""
    root = new_folder(t.spark, "config")
    project = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    text = F.format_string(
        "depth0:\n  seed_url: [\"https://%s.example/\"]\ndepth1:\n  method_name: get_pages\ndepth2:\n  method_name: get_items\nrequest_params:\n  timeout: 30\n",
        F.col("n_name"),
    )
    rows = t.nation.select(F.concat(F.lit(f"{root}/"), project, F.lit("/"), F.lower("n_name"), F.lit("_"), project, F.lit(".yml")).alias("path"), text.alias("text"))
    _write_files(rows)
    config = SR.read_site_config(t.spark, root)
    return config.select(
        "project", "site", F.element_at("seed_url", 1).alias("seed"), F.col("depths")[0]["method"].alias("method1"), F.col("depths")[1]["method"].alias("method2"),
        F.element_at("request_params", "timeout").alias("timeout"),
    )


def _write_files(rows) -> None:
    """One file for each row, through the cluster's file system, from the driver: config-sized tables only."""
    spark = rows.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in rows.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(r.path)
        out = path.getFileSystem(conf).create(path)
        out.write(bytearray(r.text.encode()))
        out.close()


@query("output_inventory", """
WITH written AS (
  SELECT 'parser' AS stage, c_nationkey % 3 AS part, length(c_custkey::VARCHAR || ',' || c_name) + 1 AS bytes FROM customer
  UNION ALL SELECT 'retriever', s_nationkey % 3, length(s_suppkey::VARCHAR || ',' || s_name) + 1 FROM supplier),
files AS (SELECT stage, part, sum(bytes) + CASE stage WHEN 'parser' THEN length('c_custkey,c_name') ELSE length('s_suppkey,s_name') END + 1 AS bytes FROM written GROUP BY 1, 2)
SELECT stage, count(*) AS files, round(sum(bytes) / 1048576.0::DOUBLE, 9) AS mb FROM files GROUP BY 1""")
def output_inventory(t):
    """Files and megabytes of two stages, a file for each third of the nations."""
    root = new_folder(t.spark, "inventory")
    for stage, df, columns, nation in (("parser/a", t.customer, ["c_custkey", "c_name"], "c_nationkey"), ("retriever/b", t.supplier, ["s_suppkey", "s_name"], "s_nationkey")):
        df.select(*columns, (F.col(nation) % 3).alias("part")).repartition(1).write.option("header", True).partitionBy("part").csv(f"{root}/{stage}")
    return SP.output_inventory(t.spark, root).select("stage", "files", F.round("mb", 9).alias("mb"))


@query("newest_files")
def newest_files(t):
    root = new_folder(t.spark, "newest")
    t.customer.write.option("header", True).csv(f"{root}/a")
    return SP.newest_files(t.spark, root).select(F.regexp_extract("path", r"\.(\w+)$", 1).alias("kind"), "length")


@query("preview", "SELECT doc_id, source, lang FROM documents ORDER BY doc_id LIMIT 20")
def preview(t):
    return SP.preview(t.documents.select("doc_id", "source", "lang"), "doc_id")
