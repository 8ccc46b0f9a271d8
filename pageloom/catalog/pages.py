"""Page classes and field extraction."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from pageloom.catalog.base import LOG_SQL, fetch_log, query
from pageloom.functions import classify as C, cleaning as K, embedded as E, html as H, urls as U
from pageloom.operators import extraction as X
from pageloom.plans.crawl import domain_digest, records_of_crawl, rejected_pages
from pageloom.plans.rules import RULE_SETS
from pageloom.session import new_folder, spread
from pageloom.streaming import streams as ST


def sql_unescape(c: str) -> str:
    """The references that the given pages hold, written out."""
    for name, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        c = f"replace({c}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    return c


def sql_strip(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_tag(tag: str) -> str:
    return f"regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1)"


def sql_visible(c: str) -> str:
    hidden = "(?is)<!--.*?-->|<script[ >].*?</script>|<style[ >].*?</style>"
    return sql_unescape(sql_strip(f"regexp_replace({c}, '{hidden}', ' ', 'g')"))


TITLE, H1 = sql_unescape(sql_strip(sql_tag("title"))), sql_unescape(sql_strip(sql_tag("h1")))
ARTICLE = sql_visible(sql_tag("article"))
# Written out here, so that the SQL does not follow a change of the list.
BLOCK_TEXTS = (
    "access denied|403 forbidden|blocked|please verify you are a human|checking your browser|just a moment|cf-browser-verification|ddos-guard|"
    "perimeterx|datadome|enable javascript and cookies to continue|please enable cookies|ray id|captcha")
SHORT = "length(regexp_replace(html, '^\\s+|\\s+$', '', 'g')) < 500"
BLOCKED = f"{SHORT} OR regexp_matches(lower(html), '{BLOCK_TEXTS}')"
DOMAIN = "regexp_replace(regexp_extract(url, '//([^/?#]*)', 1), '^www\\.', '')"


@query("domain_digest", f"""
WITH usable AS (SELECT page_id, {DOMAIN} AS domain, md5(html) AS hash, length({TITLE}) AS title_len, length({ARTICLE}) AS text_len
                FROM pages WHERE NOT ({BLOCKED})),
firsts AS (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY page_id) AS rn FROM usable)
SELECT domain, count(*) AS docs, CAST(sum(text_len) AS BIGINT) AS text_chars, round(avg(title_len), 6) AS avg_title_len
FROM firsts WHERE rn = 1 GROUP BY domain ORDER BY docs DESC, domain LIMIT 20""")
def digest(t):
    return domain_digest(t.spread("pages"))


# ---- classes -------------------------------------------------------------------------------

_DOC_STATUS = "CASE lang WHEN 'en' THEN 200 WHEN 'de' THEN 403 WHEN 'fr' THEN 503 ELSE 404 END"


def _doc_status():
    return F.when(F.col("lang") == "en", 200).when(F.col("lang") == "de", 403).when(F.col("lang") == "fr", 503).otherwise(404)


@query("is_challenge_page", r"""
SELECT doc_id, regexp_matches(lower(text), 'robot check|type the characters you see|sorry, we just need to make sure|please complete the captcha|solve the captcha|captcha to continue|api-services\.amazon|site maintenance|oops! something went wrong') AS challenge FROM documents""")
def is_challenge_page(t):
    return t.spread("documents", "doc_id", "lang", "text").select("doc_id", C.is_challenge_page(F.col("text")).alias("challenge"))


@query("is_blocked", f"""
SELECT doc_id, CASE WHEN {_DOC_STATUS} IN (403, 407, 429, 503) THEN true WHEN {_DOC_STATUS} <> 200 THEN false
  ELSE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 500 OR regexp_matches(lower(text), '{BLOCK_TEXTS}') END AS blocked
FROM documents""")
def is_blocked(t):
    return t.spread("documents", "doc_id", "lang", "text").select("doc_id", C.is_blocked(_doc_status(), F.col("text"), 500).alias("blocked"))


@query("rejected_pages", f"""
SELECT page_id, url, CASE WHEN {SHORT} THEN 'short' ELSE 'block text' END AS reason
FROM (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN left(html, 400) WHEN page_id % 3 = 1 THEN html || ' Access DENIED ' ELSE html END AS html FROM pages) WHERE {BLOCKED}""")
def rejected(t):
    """A third of the pages cut short, a third with a block text."""
    html = F.when(F.col("page_id") % 3 == 0, F.left("html", F.lit(400))).when(F.col("page_id") % 3 == 1, F.concat("html", F.lit(" Access DENIED "))).otherwise(F.col("html"))
    return rejected_pages(t.pages.withColumn("html", html))


@query("is_ok", f"SELECT doc_id, {_DOC_STATUS} = 200 AND trim(text) <> '' AS ok FROM documents")
def is_ok(t):
    return t.spread("documents", "doc_id", "lang", "text").select("doc_id", C.is_ok(_doc_status(), F.col("text")).alias("ok"))


@query("retryable", f"""
WITH {LOG_SQL} SELECT status_code, status_code IN (429, 500, 502, 503, 504) AS retry, CAST(pow(2, strategy) AS DOUBLE) AS delay_s, count(*) AS n
FROM log GROUP BY ALL""")
def retryable(t):
    return fetch_log(t).groupBy(
        "status_code", C.retryable(F.col("status_code")).alias("retry"), C.backoff_s(F.col("strategy")).alias("delay_s")
    ).agg(F.count("*").alias("n"))


@query("error_type", f"""
WITH {LOG_SQL} SELECT CASE WHEN blocked THEN 'blocked' WHEN status_code = 200 THEN NULL WHEN status_code IN (429, 500) THEN 'retryable'
  ELSE 'client_error' END AS error_type, count(*) AS n FROM log GROUP BY 1""")
def error_type(t):
    kind = C.error_type(F.col("status_code"), F.col("blocked"))
    return fetch_log(t).groupBy(kind.alias("error_type")).agg(F.count("*").alias("n"))


# ---- fields of pages -----------------------------------------------------------------------

@query("title_and_h1", f"SELECT page_id, nullif({TITLE}, '') AS title, nullif({H1}, '') AS h1 FROM pages")
def title_and_h1(t):
    return t.pages.select("page_id", H.title(F.col("html")).alias("title"), H.h1(F.col("html")).alias("h1"))


@query("container_text", f"SELECT page_id, nullif({ARTICLE}, '') AS body FROM pages")
def container_text(t):
    return t.spread("pages").select("page_id", H.container_text(F.col("html"), "article").alias("body"))


@query("text_with_class", f"""
SELECT page_id, nullif(trim({sql_unescape("regexp_extract(html, 'class=\"ad\">([^<]*)', 1)")}), '') AS ad FROM pages""")
def text_with_class(t):
    return t.pages.select("page_id", H.text_with_class(F.col("html"), "ad", "token").alias("ad"))


@query("script_value", "SELECT page_id, CAST(page_id AS VARCHAR) AS tracked FROM pages")
def script_value(t):
    return t.pages.select("page_id", H.script_value(F.col("html"), "track").alias("tracked"))


@query("strip_html", f"SELECT page_id, {sql_strip('html')} AS text FROM pages")
def strip_html(t):
    return t.spread("pages").select("page_id", H.strip_html(F.col("html")).alias("text"))


def nested_page():
    """Boxes in boxes, with tags in a comment and a script, a stray closing tag, a tag whose name only begins alike, and a last box that is not closed."""
    inner = F.concat(F.lit("<div class='in'>"), F.col("p_brand"), F.lit("<DIV\n>deep</DIV></div>"))
    return F.concat(
        F.lit("</div><p>lead</p><div id=a>"), F.col("p_name"), F.lit(" "), F.when(F.col("p_size") % 2 == 0, inner).otherwise(F.lit("")),
        F.lit("<!-- <div> --><script>var x = '</div>';</script>"), F.lit(" tail</div><divider>no</divider>"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("<div>second <div>"), F.col("p_type"), F.lit("</div></div>"))).otherwise(F.lit("")),
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("<div>open <div>"), F.col("p_type"), F.lit("</div> end"))).otherwise(F.lit("")))


@query("nested_container_text", """
SELECT p_partkey, p_name || CASE WHEN p_size % 2 = 0 THEN ' ' || p_brand || ' deep' ELSE '' END || ' tail' AS body FROM part""")
def nested_container_text(t):
    return t.part.select("p_partkey", H.container_text(nested_page(), "div").alias("body"))


@query("nested_sections", """
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY k) - 1 AS INTEGER) AS section, text FROM (
  SELECT p_partkey, 1 AS k, p_name || CASE WHEN p_size % 2 = 0 THEN ' ' || p_brand || ' deep' ELSE '' END || ' tail' AS text FROM part
  UNION ALL SELECT p_partkey, 2, 'second ' || p_type FROM part WHERE p_size % 3 = 0
  UNION ALL SELECT p_partkey, 3, 'open ' || p_type || ' end' FROM part WHERE p_size % 5 = 0)""")
def nested_sections(t):
    parts = X.split_sections(t.part.select("p_partkey", nested_page().alias("html")), "div", ["p_partkey"])
    return parts.select("p_partkey", "section", H.visible_text(F.col("html")).alias("text"))


@query("split_sections", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS section, CAST(length(ps[i]) AS INTEGER) AS n FROM (
  SELECT page_id, ps, unnest(generate_series(1, len(ps))) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '(?is)(<p(?:\\s[^>]*)?>.*?</p>)', 1) AS ps FROM pages))""")
def split_sections(t):
    return X.split_sections(t.pages, "p").select("page_id", "section", F.length("html").alias("n"))


@query("split_by_path")
def split_by_path(t):
    """The same through a table function on the page tree."""
    return X.split_by_path(t.pages, "//article//p").select("page_id", "section", F.length("text").alias("n"))


@query("record_identity", """
SELECT page_id, url AS page_url, md5(url) AS uniq_id, strftime(TIMESTAMP '2026-03-11 23:26:23.03' + to_seconds(page_id), '%b %d, %Y @ %H:%M:%S.%g') AS crawl_timestamp FROM pages""")
def record_identity(t):
    ts = F.lit("2026-03-11 23:26:23.030").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("page_id").cast("decimal(18,6)"))
    return t.pages.select(
        "page_id", F.col("url").alias("page_url"), U.uniq_id(F.col("url")).alias("uniq_id"), K.crawl_timestamp(ts).alias("crawl_timestamp")
    )


PAGE_RULES = {
    "page": [
        X.Rule("article_title", "xpath", "//meta[@property='og:title']/@content | //h1/text()"),
        X.Rule("head_title", "css", "head title::text"),
        X.Rule("ad", "xpath", "//div[contains(@class,'ad')]//text()"),
        X.Rule("first_link", "xpath", "//nav//a/@href"),
        X.Rule("tracked", "script", "track"),
        X.Rule("sub_title", "meta", "description"),
        X.Rule("lang", "regex", r'<html lang="([a-z]+)"'),
        X.Rule("kind", "const", "page"),
        X.Rule("charset", "xpath", "//meta/@charset"),
        X.Rule("link_count", "xpath", "//nav//li/a[@href]", take="count"),
    ]
}


@query("extract_fields", f"""
SELECT page_id, url AS page_url, md5(url) AS uniq_id, nullif(trim({sql_unescape(sql_tag('h1'))}), '') AS article_title,
       nullif(trim({sql_unescape(sql_tag('title'))}), '') AS head_title,
       nullif(trim({sql_unescape("regexp_extract(html, 'class=\"ad\">([^<]*)', 1)")}), '') AS ad,
       {sql_unescape("regexp_extract(html, '<a href=\"([^\"]*)\"', 1)")} AS first_link, CAST(page_id AS VARCHAR) AS tracked,
       CAST(NULL AS VARCHAR) AS sub_title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, 'page' AS kind, 'utf-8' AS charset,
       CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href')) AS VARCHAR) AS link_count, 0 AS n_errors
FROM pages""")
def extract_fields(t):
    pages = spread(t.pages.withColumn("rule_set", F.lit("page")))
    return X.extract_fields(pages, PAGE_RULES).withColumn("n_errors", F.size("errors")).drop("errors", "rule_set")


@query("generic_media_records", f"""
SELECT page_id, nullif(trim({sql_unescape(sql_tag('h1'))}), '') AS article_title, CAST(NULL AS VARCHAR) AS sub_title, CAST(NULL AS VARCHAR) AS author_name,
       CAST(NULL AS VARCHAR) AS post_date, CAST(NULL AS VARCHAR) AS image_url,
       regexp_replace({sql_visible("regexp_replace(" + sql_tag('article') + ", '(?s)<h1>.*?</h1>', ' ')")}, '\\s', '', 'g') AS body
FROM pages""")
def generic_media_records(t):
    """The shared article rules on whole pages. White space is left out of the body on both sides."""
    pages = spread(t.pages.withColumn("rule_set", F.lit("generic_media")))
    out = X.extract_fields(pages, {"generic_media": RULE_SETS["generic_media"]})
    return out.select(
        "page_id", "article_title", "sub_title", "author_name", "post_date", "image_url",
        F.regexp_replace("article_content", r"\s", "").alias("body"),
    )


@query("paragraph_own_text")
def paragraph_own_text(t):
    rules = {"own": [X.Rule("content", "xpath", "//article/p/text()[1]", take="join")]}
    return X.extract_fields(spread(t.pages.withColumn("rule_set", F.lit("own"))), rules).select("page_id", "content")


@query("field_errors", """
SELECT 'broken' AS rule_set, 'always: ZeroDivisionError' AS error, count(*) AS n FROM pages
UNION ALL SELECT 'broken', 'sometimes: ValueError', count(*) FROM pages WHERE contains(html, '<html lang="fr"')""")
def field_errors(t):
    """A failing field costs that field only and is counted."""

    def always(page):
        return str(1 // 0)

    def sometimes(page):
        return str(int("0" if page.select("//html/@lang")[0] != "fr" else "x"))

    rules = {"broken": [X.Rule("always", "python", always), X.Rule("sometimes", "python", sometimes),
                        X.Rule("title", "xpath", "//title/text()")]}
    return X.field_errors(X.extract_fields(spread(t.pages.withColumn("rule_set", F.lit("broken"))), rules))


# ---- embedded JSON, on pages made from table rows -------------------------------------------

def product_page(broken: bool = False):
    """A product page of each part, in three ld+json forms."""
    product = F.to_json(F.struct(
        F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.concat(F.lit("SKU"), F.col("p_partkey")).alias("sku"),
        F.struct(F.col("p_brand").alias("name")).alias("brand"),
        F.struct(F.col("p_retailprice").alias("price"), (F.col("p_retailprice") + 100).alias("highPrice"),
                 F.lit("https://schema.org/InStock").alias("availability")).alias("offers"),
        F.struct((F.col("p_size") / 10).alias("ratingValue"), F.col("p_size").alias("reviewCount")).alias("aggregateRating"),
    ))
    other = F.lit('{"@type":"Organization","name":"x"}')
    open_tag, close_tag = F.lit('<script type="application/ld+json">'), F.lit("</script>")
    body = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("["), other, F.lit(","), product, F.lit("]")))
        .when(F.col("p_type") == "SMALL", F.left(product, F.length(product) - 3))
        .when(F.col("p_type") == "LARGE", other)
        .otherwise(product)
    )
    return F.concat(F.lit("<html><head>"), open_tag, F.lit("not json"), close_tag, open_tag, body, close_tag, F.lit("</head></html>"))


def _shop_pages(t, parts=None):
    """Product pages with a price that may be no price and a state that may be no JSON, under two rule sets."""
    price = F.when(F.col("p_size") % 4 == 0, "call us").when(F.col("p_size") % 4 == 1, "").otherwise(F.col("p_retailprice").cast("string"))
    state = F.when(F.col("p_size") % 3 == 0, F.lit("{broken,}")).otherwise(F.to_json(F.struct(F.col("p_brand").alias("brand"))))
    html = F.concat(
        F.lit('<meta property="price" content="'), price, F.lit('"><script>window.__S__ = '), state, F.lit(";</script>"), product_page())
    return (t.part if parts is None else parts).select(
        F.col("p_partkey").alias("page_id"), F.concat(F.lit("https://shop.example/"), F.col("p_partkey").cast("string")).alias("url"),
        html.alias("html"), F.when(F.col("p_partkey") % 2 == 0, "even").otherwise("odd").alias("rule_set"))


def _shop_rules():
    def sometimes(page):
        return "x" if "broken" in page.select("//script/text()")[0] else str(1 // 0)

    return {
        "even": [X.Rule("list_price", "meta", "price", post="price"), X.Rule("brand", "state", ("window.__S__ = ", "$.brand")),
                 X.Rule("sku", "ldjson", ("$.sku",)), X.Rule("color", "meta", "color")],
        "odd": [X.Rule("list_price", "meta", "price", post="price"), X.Rule("list_price", "const", "9"), X.Rule("note", "python", sometimes)],
    }


_SHOP_SQL = """
shop AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS rule_set, p_size, p_type NOT IN ('SMALL', 'LARGE') AS good, p_partkey FROM part),
failed AS (
  SELECT rule_set, 'list_price' AS field, CASE WHEN p_size % 4 = 0 THEN 'cast' ELSE 'empty' END AS kind FROM shop WHERE rule_set = 'even' AND p_size % 4 < 2
  UNION ALL SELECT rule_set, 'brand', 'json' FROM shop WHERE rule_set = 'even' AND p_size % 3 = 0
  UNION ALL SELECT rule_set, 'sku', 'json' FROM shop WHERE rule_set = 'even' AND NOT good
  UNION ALL SELECT rule_set, 'color', 'empty' FROM shop WHERE rule_set = 'even'
  UNION ALL SELECT rule_set, 'note', 'python' FROM shop WHERE rule_set = 'odd' AND p_size % 3 <> 0)
"""


@query("registered_rules", """
SELECT p_partkey AS page_id, 'no. ' || CAST(p_partkey AS VARCHAR) AS name, CAST(round(p_retailprice, 2) AS DECIMAL(12, 2)) AS list_price FROM part WHERE p_size % 4 > 1""")
def registered_rules(t):
    """A rule set that is only in the registry: a selector, and a column function."""
    if "registered_shop" not in X.RULE_SETS:
        X.register_rule("registered_shop", X.Rule("name", "column", lambda html, url: F.concat(F.lit("no. "), F.regexp_extract(url, r"(\d+)$", 1))))
        X.register_rule("registered_shop", X.Rule("list_price", "xpath", "//meta[@property='price']/@content", post="price"))
    pages = _shop_pages(t).withColumn("rule_set", F.lit("registered_shop"))
    records = X.extract_fields(pages, {"registered_shop": X.RULE_SETS["registered_shop"]})
    return records.filter("list_price IS NOT NULL").select("page_id", "name", "list_price")


@query("field_accounts", f"WITH {_SHOP_SQL} SELECT rule_set, field, kind, count(*) AS n FROM failed GROUP BY ALL")
def field_accounts(t):
    """Failed casts, bad JSON, Python errors and empty fields, counted by the pass that writes the records."""
    seen = Observation()
    records = X.extract_fields(_shop_pages(t), _shop_rules(), observation=seen)
    records.write.parquet(new_folder(t.spark, "records"))
    return X.observed(t.spark, seen)


@query("field_accounts_stream", f"WITH {_SHOP_SQL} SELECT rule_set, field, kind, count(*) AS n FROM failed GROUP BY ALL")
def field_accounts_stream(t):
    """The same over the four micro-batches of a stream, of a file for each core or more, added up by a listener."""
    folder, each = new_folder(t.spark, "shop-pages"), t.spark.sparkContext.defaultParallelism
    pages = _shop_pages(t, t.part.repartition(4 * each))
    pages.write.parquet(folder)
    seen = X.ObservedFields("shop-fields")
    t.spark.streams.addListener(seen)
    try:
        stream = ST.stream_table(t.spark, folder, pages.schema, each)
        ST.drain(X.extract_fields(stream, _shop_rules(), observation="shop-fields").select("page_id", "errors"), "shop-records")
        t.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        t.spark.streams.removeListener(seen)
    return seen.accounts(t.spark)


@query("field_errors_all", f"WITH {_SHOP_SQL} SELECT rule_set, CASE WHEN kind = 'python' THEN 'note: ZeroDivisionError' ELSE field || ': ' || kind END AS error, count(*) AS n FROM failed WHERE kind <> 'empty' GROUP BY ALL")
def field_errors_all(t):
    """Errors of column rules beside those of Python rules, from the records."""
    return X.field_errors(X.extract_fields(_shop_pages(t), _shop_rules(), observation=Observation()))


@query("ld_json", """
SELECT p_partkey, CASE WHEN good THEN p_name END AS name, CASE WHEN good THEN 'SKU' || CAST(p_partkey AS VARCHAR) END AS sku,
       CASE WHEN good THEN p_brand END AS brand, CASE WHEN good THEN p_retailprice END AS price, CASE WHEN good THEN CAST(p_size AS BIGINT) END AS reviews,
       CASE WHEN good THEN 'in_stock' END AS availability
FROM (SELECT *, p_type NOT IN ('SMALL', 'LARGE') AS good FROM part)""")
def ld_json(t):
    v = F.col("v")
    return t.part.select("p_partkey", E.ld_json(product_page()).alias("v")).select(
        "p_partkey", E.field(v, "$.name").alias("name"), E.field(v, "$.sku").alias("sku"), E.name_or_text(v, "$.brand").alias("brand"),
        E.field(v, "$.offers.price", "double").alias("price"), E.field(v, "$.aggregateRating.reviewCount", "bigint").alias("reviews"),
        K.availability(E.field(v, "$.offers.availability")).alias("availability"),
    )


@query("product_records", """
SELECT p_partkey, CASE WHEN good THEN p_name END AS product_name, CASE WHEN good THEN CAST(p_retailprice + 100 AS DOUBLE) END AS list_price,
       CASE WHEN good THEN p_retailprice END AS selling_price,
       CASE WHEN good THEN CAST(round_even(100.0 / CAST(CAST(p_retailprice + 100 AS DECIMAL(12,2)) AS DOUBLE) * 100, 0) AS INTEGER) ELSE 0 END AS discount_percentage,
       CASE WHEN good THEN CAST(p_size AS BIGINT) END AS review_count, CASE WHEN good THEN round(p_size / 10.0, 1) END AS rating,
       CASE WHEN good THEN 'in_stock' END AS availability
FROM (SELECT *, p_type NOT IN ('SMALL', 'LARGE') AS good FROM part)""")
def product_records(t):
    """A full custom rule set on product pages: JSON first, then metas, then selectors."""
    pages = t.part.select("p_partkey", F.lit("https://shop.example/a/p/1").alias("url"), product_page().alias("html"),
                          F.lit("ajio_com").alias("rule_set"))
    out = X.extract_fields(spread(pages), {"ajio_com": RULE_SETS["ajio_com"]}, keep=("p_partkey",))
    return out.select("p_partkey", "product_name", F.col("list_price").cast("double").alias("list_price"),
                      F.col("selling_price").cast("double").alias("selling_price"),
                      "discount_percentage", "review_count", "rating", "availability")


@query("meta_content", """
SELECT doc_id, nullif(trim(replace(left(text, 60), '"', '')), '') AS title, nullif(trim(replace(source, '"', '')), '') AS description FROM documents""")
def meta_content(t):
    title = F.trim(F.replace(F.left("text", F.lit(60)), F.lit('"'), F.lit("")))
    escaped = F.replace(F.replace(F.replace(title, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(
        F.lit('<head><meta property="og:title" content=""><meta charset="x"><meta property="og:title" content="'), escaped,
        F.lit('"><meta content=\''), F.col("source"), F.lit("' name='description'></head>"),
    )
    return t.documents.select("doc_id", page.alias("html")).select(
        "doc_id", H.meta(F.col("html"), "og:title").alias("title"), H.meta(F.col("html"), "description").alias("description")
    )


@query("label_sibling", "SELECT p_partkey, p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part")
def label_sibling(t):
    page = F.concat(
        F.lit("<table><tr><th class=k> Brand </th> <td>"), F.col("p_brand"), F.lit("</td></tr><tr><th>Item size</th><td><b>"),
        F.col("p_size").cast("string"), F.lit("</b></td></tr></table>"),
    )
    return t.part.select(
        "p_partkey", H.label_sibling(page, "Brand").alias("brand"), H.label_sibling(page, "size").alias("size")
    )


@query("next_data", "SELECT s_suppkey, s_name AS name, s_acctbal AS balance FROM supplier")
def next_data(t):
    body = F.to_json(F.struct(F.struct(F.struct(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")).alias("pageProps")).alias("props")))
    page = F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), body, F.lit("</script>"))
    v = F.try_parse_json(E.next_json(F.col("html")))
    return t.supplier.select("s_suppkey", page.alias("html")).select("s_suppkey", v.alias("v")).select(
        "s_suppkey", E.field(F.col("v"), "$.props.pageProps.name").alias("name"),
        E.field(F.col("v"), "$.props.pageProps.balance", "double").alias("balance"),
    )


@query("deep_products", "SELECT s_suppkey, 'P' || CAST(s_suppkey AS VARCHAR) AS sku, s_name AS title FROM supplier")
def deep_products(t):
    item = F.struct(F.concat(F.lit("P"), F.col("s_suppkey")).alias("sku"), F.col("s_name").alias("title"))
    empty = F.array().cast("array<int>")
    body = F.to_json(F.struct(F.struct(empty.alias("products"), F.array(F.struct(F.struct(F.array(item).alias("products")).alias("data"))).alias("queries")).alias("props")))
    found = E.find_list(F.col("j"), "products")
    rows = t.supplier.select("s_suppkey", body.alias("j")).select(
        "s_suppkey", F.explode(F.from_json(found, "array<struct<sku:string,title:string>>")).alias("p")
    )
    return rows.select("s_suppkey", "p.sku", "p.title")


@query("apollo_entity", """
SELECT p_partkey, p_name AS title, s_name AS author, p_type AS body, 'https://img.example/' || p_brand AS image
FROM part LEFT JOIN supplier ON s_suppkey = p_size""")
def apollo_entity(t):
    q = lambda name, value: F.concat(F.lit(f'"{name}":'), F.to_json(F.array(value)))
    text = lambda value: F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")
    rows = t.part.join(t.supplier, F.col("s_suppkey") == F.col("p_size"), "left")
    user = F.concat(F.lit('"User:1":{"__typename":"User","name":'), F.coalesce(text(F.col("s_name")), F.lit("null")), F.lit("},"))
    article = F.concat(
        F.lit('"Article:9":{"__typename":"LocalNewsArticle","title":'), text(F.col("p_name")), F.lit(',"creator":{"__ref":"User:1"},"body({})":'),
        text(F.col("p_type")), F.lit(","), q("imageUrls({})", F.concat(F.lit("https://img.example/"), F.col("p_brand"))), F.lit("}"),
    )
    page = F.concat(F.lit('<script id="__NEXT_DATA__">{"props":{"pageProps":{"apolloState":{'), user, article, F.lit("}}}}</script>"))
    cache = rows.select("p_partkey", E.apollo_cache(page).alias("c")).select(
        "p_partkey", "c", E.apollo_entity(F.col("c"), "LocalNewsArticle").alias("e")
    )
    e = F.col("e")
    return cache.select(
        "p_partkey", E.field(e, "$.title").alias("title"), E.field(E.apollo_ref(F.col("c"), e, "$.creator"), "$.name").alias("author"),
        E.field(E.by_prefix(e, "body"), "$").alias("body"), E.field(E.by_prefix(e, "imageUrls"), "$[0]").alias("image"),
    )


@query("embedded_state", "SELECT p_partkey, p_name AS name, p_retailprice AS mrp, '} {' AS odd FROM part")
def embedded_state(t):
    body = F.to_json(F.struct(F.struct(F.col("p_name").alias("name"), F.struct(F.col("p_retailprice").alias("mrp")).alias("price"), F.lit("} {").alias("odd")).alias("pdpData")))
    page = F.concat(F.lit("<script>var a = {}; window.__state = "), body, F.lit("; var b = {'x': 1};</script>"))
    rows = t.part.select("p_partkey", page.alias("html")).select(
        "p_partkey", F.try_parse_json(E.embedded_state(F.col("html"), "window.__state =")).alias("v")
    )
    v = F.col("v")
    return rows.select(
        "p_partkey", E.field(v, "$.pdpData.name").alias("name"), E.field(v, "$.pdpData.price.mrp", "double").alias("mrp"),
        E.field(v, "$.pdpData.odd").alias("odd"),
    )


@query("coalesce_chain", """
SELECT doc_id, coalesce(nullif(trim(CASE WHEN lang = 'en' THEN source ELSE '' END), ''), nullif(trim(CASE WHEN lang = 'de' THEN ' ' || lang ELSE '  ' END), ''), 'none') AS picked
FROM documents""")
def coalesce_chain(t):
    lang = F.col("lang")
    return t.documents.select("doc_id", K.first_non_empty(
        F.when(lang == "en", F.col("source")).otherwise(""), F.when(lang == "de", F.concat(F.lit(" "), lang)).otherwise("  "), F.lit("none")
    ).alias("picked"))


# ---- the whole flow --------------------------------------------------------------------------

@query("crawl_records", f"""
SELECT 'media_crawl' AS project, CASE WHEN contains(url, '.org') THEN 'org' ELSE 'net' END AS site, 's1' AS schedule_id, url AS page_url, page_id,
       nullif(trim({sql_unescape(sql_tag('h1'))}), '') AS article_title, nullif(trim({sql_unescape(sql_tag('title'))}), '') AS head_title
FROM pages WHERE NOT ({BLOCKED}) AND NOT contains(html, '<html lang="de"') AND (contains(url, '.org') OR contains(url, '.net'))""")
def crawl_records(t):
    """Seeds, frontier, change check, extraction. German pages were crawled before and are unchanged."""
    pages = t.spread("pages")
    site = F.when(F.contains("url", F.lit(".org")), "org").otherwise("net")
    seeds = pages.filter(F.contains("url", F.lit(".org")) | F.contains("url", F.lit(".net"))).select(
        F.lit("media_crawl").alias("project"), site.alias("site"), F.lit("s1").alias("schedule_id"), "url"
    )
    config = t.spark.createDataFrame(
        [("media_crawl", s, level, "seed_only") for s in ("org", "net") for level in (1, 2)],
        "project string, site string, level int, method string",
    )
    german = pages.filter(F.contains("html", F.lit('<html lang="de"'))).select("url", F.md5(F.encode("html", "UTF-8")).alias("hash"))
    rules = {"page": [r for r in PAGE_RULES["page"] if r.field in ("article_title", "head_title")]}
    out = records_of_crawl(seeds, pages, config, ["seed_only"], F.lit("page"), german, rules)
    return out.select("project", "site", "schedule_id", "page_url", "page_id", "article_title", "head_title")


@query("character_references", """
SELECT p_partkey, 'Café ' || p_name || ' ’s ½ & < &lt; 😀 &nosuch; 100 % A' AS heading FROM part""")
def character_references(t):
    """Named, decimal and hexadecimal references, each decoded once; unknown names stay."""
    html = F.concat(
        F.lit("<h1>Caf&eacute;&nbsp;"), F.col("p_name"), F.lit(" &#8217;s &frac12; &amp; &lt; &amp;lt; &#x1F600; &nosuch; 100 % &#65;</h1>"))
    return t.part.select("p_partkey", H.h1(html).alias("heading"))
