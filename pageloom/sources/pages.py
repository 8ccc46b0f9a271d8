"""Page stores, fetch metadata, sitemaps, listing payloads and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageloom import schemas
from pageloom.functions import html as H, urls as U
from pageloom.operators import scans


def read_pages(spark: SparkSession, root: str, pattern: str = "*.html.gz") -> DataFrame:
    """HTML files under `{project}/{domain}/{date}/{md5}.html[.gz]`. gzip is undone by the file source."""
    path = F.col("_metadata.file_path")
    part = lambda i: F.regexp_extract(path, r"([^/]+)/([^/]+)/([^/]+)/([^/]+?)\.html(?:\.gz)?$", i)
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    return files.select(
        part(1).alias("project"), part(2).alias("domain"), part(3).alias("date"), part(4).alias("url_md5"),
        F.col("value").alias("html"),
    )


def write_pages(pages: DataFrame, path: str, load: str = "0") -> None:
    """Pages by project, domain, date and load; other loads of the same day stay, the same load written again replaces itself.

    Rows are clustered on the partition columns by a rebalance, so that run-time
    statistics join small domains into one task and split a large one over many.
    """
    rows = pages.withColumns({
        "domain": U.domain(F.col("url")),
        "date": F.to_date("fetched_at"),
        "url_md5": U.url_hash(F.col("url")),
        "load": F.lit(load),
    })
    (
        rows.hint("rebalance", "project", "domain", "date")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("project", "domain", "date", "load").parquet(path)
    )


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    """All stored pages; one that was loaded again on its day comes from its latest load (by time, then name of the load).

    Which load that is comes from the narrow columns; page text is not shuffled for pages of one load unless the join is.
    """
    pages = spark.read.option("basePath", path).parquet(path).withColumn("load", F.col("load").cast("string"))
    key = ["project", "domain", "date", "url_md5"]
    again = pages.groupBy(*key).agg(F.max(F.struct("fetched_at", "load")).alias("__last"), F.count_distinct("load").alias("__n"))
    again = again.filter("__n > 1").select(*key, F.col("__last.load").alias("__load"))
    joined = scans.same_keys(pages, again, key, "left")
    return joined.filter(F.col("__load").isNull() | (F.col("__load") == F.col("load"))).drop("__load", "load")


def read_fetch_metadata(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines {url, output_file}; blank lines are skipped."""
    rows = spark.read.schema(schemas.FETCH_METADATA).json(path).filter(F.col("url").isNotNull())
    key = U.split_url_key(F.col("url"))
    return rows.select(
        key["url"].alias("url"), key["rank"].alias("rank"), F.col("url").alias("url_key"), "output_file",
        U.url_hash(F.col("url")).alias("uniq_id"),
    )


def sitemap_urls(df: DataFrame, xml: str = "xml", keep: tuple[str, ...] = ()) -> DataFrame:
    """`<loc>` entries of sitemap texts."""
    return df.select(*keep, F.posexplode(H.sitemap_locs(F.col(xml))).alias("pos", "loc"))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """Sitemap files through the XML source, one row for each url element, split across tasks."""
    return (
        spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)
        .select(F.trim("loc").alias("loc"), "lastmod").filter(F.col("loc") != "")
    )


LISTING_SCHEMA = (
    "products array<struct<url:string,title:string,sku:string,uniqueId:string>>, "
    "pagination struct<currentPage:int,totalNumberOfPages:int>"
)


def listing_items(df: DataFrame, column: str, schema: str = LISTING_SCHEMA, page_size: int = 45,
                  site_root: str = "", keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of a listing payload with rank = page x size + position; repeats in a page keep their first place."""
    body = F.from_json(F.col(column), schema)
    urls = F.transform(
        F.filter(F.col("__b.products"), lambda p: F.coalesce(p["url"], F.lit("")) != ""),
        lambda p: F.when(F.startswith(p["url"], F.lit("/")), F.concat(F.lit(site_root), p["url"])).otherwise(p["url"]),
    )
    page = F.coalesce(F.col("__b.pagination.currentPage"), F.lit(0))
    return (
        df.select(*keep, body.alias("__b"))
        .select(*keep, page.alias("page"), F.posexplode(F.array_distinct(urls)).alias("__p", "url"))
        .select(*keep, "page", (F.col("page") * page_size + F.col("__p") + 1).alias("rank"), "url")
    )


ARTICLES_SCHEMA = "categoryname string, articles array<struct<id:string,title:string,categoryname:string,subcategoryname:string>>"


def listing_articles(df: DataFrame, column: str, base: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Article URLs of a category payload."""
    rows = df.select(*keep, F.from_json(F.col(column), ARTICLES_SCHEMA).alias("__b")).select(
        *keep, F.col("__b.categoryname").alias("__c"), F.posexplode("__b.articles").alias("pos", "__a")
    ).filter(F.coalesce(F.col("__a.id"), F.lit("")) != "")
    url = U.article_url(
        F.lit(base), F.coalesce("__a.categoryname", "__c"), F.col("__a.subcategoryname"), F.col("__a.title"), F.col("__a.id")
    )
    return rows.select(*keep, "pos", url.alias("url"))


LOG_BODY = "status string, info string, url string"


def parse_log_lines(df: DataFrame, line: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """`<asctime> [LEVEL] {json}` or `<asctime> [LEVEL] text`."""
    text = F.col(line)
    body = F.regexp_extract(text, r"\[[A-Z]+\]\s*(.*)$", 1)
    parsed = F.from_json(F.when(body.startswith("{"), body), LOG_BODY)
    return df.select(
        *keep, F.col(line),
        F.nullif(F.regexp_extract(text, r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:[,.]\d+)?)", 1), F.lit("")).alias("ts"),
        F.nullif(F.regexp_extract(text, r"\[([A-Z]+)\]", 1), F.lit("")).alias("level"),
        parsed["status"].alias("status"),
        F.coalesce(parsed["info"], F.nullif(body, F.lit("")), text).alias("info"),
        parsed["url"].alias("url"),
    )


def read_pipeline_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with a file-order key: file, split start, then line within the split."""
    raw = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line_no"),
    )
    return parse_log_lines(raw, "line", ("file", "block_start", "line_no"))


def read_file_sizes(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, bytes and time of every file; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
        .select("path", "length", "modificationTime")
    )


def output_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and MB for each stage directory, the one below the root."""
    stage = F.regexp_extract(F.col("path"), _below(root), 1)
    return read_file_sizes(spark, root).groupBy(stage.alias("stage")).agg(
        F.count("*").alias("files"), (F.sum("length") / F.lit(1024 * 1024)).alias("mb")
    )


def _below(root: str) -> str:
    import re

    return re.escape(re.sub(r"^file:/*", "/", root).rstrip("/")) + r"/([^/]+)/"


def newest_files(spark: SparkSession, root: str, pattern: str = "*.csv", n: int = 50) -> DataFrame:
    """Output files, newest first."""
    return read_file_sizes(spark, root, pattern).orderBy(F.desc("modificationTime"), "path").limit(n)


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    return df.orderBy(key).limit(n)


def with_domain(df: DataFrame, url: Column | None = None) -> DataFrame:
    return df.withColumn("domain", U.domain(F.col("url") if url is None else url))
