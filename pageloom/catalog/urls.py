"""URL columns, link filters and page-list generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import query
from pageloom.functions import pagination as P, urls as U

PARTS = {
    "scheme": r"^([A-Za-z][A-Za-z0-9+.\-]*):",
    "host": r"^[a-z]+://([^/?#]*)",
    "path": r"^[a-z]+://[^/?#]*([^?#]*)",
    "query": r"\?([^#]*)",
    "fragment": r"#(.*)$",
}


def part(name: str, c: str = "url") -> str:
    return f"nullif(regexp_extract({c}, '{PARTS[name]}', 1), '')"


DOMAIN = f"regexp_replace({part('host')}, '^www\\.', '')"
SEGMENTS = f"list_filter(string_split(coalesce({part('path')}, ''), '/'), lambda s: s <> '')"
PRODUCT_LINK = "'https://shop.example/' || replace(p_name, ' ', '-') || '/dp/' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '/ref=sr_1?th=1&psc=1'"


def product_link():
    return F.concat(
        F.lit("https://shop.example/"), F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("/dp/"),
        F.lpad(F.col("p_partkey").cast("string"), 10, "0"), F.lit("/ref=sr_1?th=1&psc=1"),
    )


@query("split_url_key", "SELECT page_id, url, CAST(page_id + 1 AS INTEGER) AS rank FROM pages")
def split_url_key(t):
    key = U.make_url_key(F.col("url"), F.col("page_id") + 1)
    return t.pages.select("page_id", U.split_url_key(key).alias("k")).select("page_id", "k.url", "k.rank")


@query("url_parts", "SELECT page_id, " + ", ".join(f"{part(p)} AS {p}" for p in PARTS) + " FROM pages")
def url_parts(t):
    return t.pages.select("page_id", U.url_parts(F.col("url")).alias("p")).select("page_id", "p.*")


@query("url_domain", f"SELECT page_id, {DOMAIN} AS domain FROM pages")
def url_domain(t):
    return t.pages.select("page_id", U.domain(F.col("url")).alias("domain"))


REFERENCES = ["", "mailto:a@b.example", "//cdn.example/x.js", "/top/./x", "?q=1", "#frag", "item.html", "../up", "./same/", "../../../far?x=1#y"]
_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)"
_PATH = f"coalesce({part('path')}, '')"
_FOLDER = f"coalesce(nullif(regexp_extract({_PATH}, '^(.*/)', 1), ''), '/')"
_UP = f"coalesce(nullif(regexp_replace({_FOLDER}, '[^/]+/$', ''), ''), '/')"


@query("resolve_url", f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE pos
  WHEN 0 THEN url WHEN 1 THEN 'mailto:a@b.example' WHEN 2 THEN {part('scheme')} || '://cdn.example/x.js'
  WHEN 3 THEN {_ORIGIN} || '/top/x' WHEN 4 THEN {_ORIGIN} || {_PATH} || '?q=1'
  WHEN 5 THEN regexp_replace(url, '#.*$', '') || '#frag' WHEN 6 THEN {_ORIGIN} || {_FOLDER} || 'item.html'
  WHEN 7 THEN {_ORIGIN} || {_UP} || 'up' WHEN 8 THEN {_ORIGIN} || {_FOLDER} || 'same/'
  ELSE {_ORIGIN} || '/far?x=1#y' END AS link
FROM pages, (SELECT unnest(generate_series(0, 9)) AS pos)""")
def resolve_url(t):
    refs = F.array(*[F.lit(r) for r in REFERENCES])
    return t.pages.select("page_id", "url", F.posexplode(refs).alias("pos", "href")).select(
        "page_id", "pos", U.resolve_url(F.col("url"), F.col("href")).alias("link")
    )


@query("canonical_url", "SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages")
def canonical_url(t):
    return t.pages.select("page_id", U.canonical_url(F.col("url")).alias("canonical"))


@query("canonical_product_url", """
SELECT p_partkey, 'https://shop.example/' || replace(p_name, ' ', '-') || '/dp/' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '/' AS canonical
FROM part""")
def canonical_product_url(t):
    return t.part.select("p_partkey", U.canonical_url(product_link(), "product").alias("canonical"))


@query("product_code", f"""
SELECT page_id, CASE WHEN regexp_matches(url, '/en/[^/]') THEN regexp_extract(rtrim(url, '/'), '/en/([^/]*)', 1) END AS code,
       nullif(regexp_extract(rtrim(url, '/'), '/([0-9]+)$', 1), '') AS category_code,
       nullif(regexp_extract(replace({part('path')}, '.html', ''), '/([0-9]+)', 1), '') AS id
FROM pages""")
def product_code(t):
    c = F.col("url")
    dashed = F.concat(F.lit("https://x.example/a-"), F.regexp_extract(U.url_part(c, "path"), r"/(\d+)", 1), F.lit("/?a=1"))
    return t.pages.select(
        "page_id", U.product_code(c, "en").alias("code"), U.category_code(c, "missing").alias("category_code"),
        U.trailing_id(dashed).alias("id"),
    )


@query("page_number", "SELECT page_id, coalesce(TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS INTEGER), 1) AS page FROM pages")
def page_number(t):
    return t.pages.select("page_id", U.page_number(F.col("url")).alias("page"))


@query("on_domain", f"SELECT page_id, contains({part('host')}, 'example.org') AS in_host, contains(url, 'example.org/en') AS in_url FROM pages")
def on_domain(t):
    c = F.col("url")
    return t.pages.select(
        "page_id", U.on_domain(c, "example.org").alias("in_host"), U.on_domain(c, "example.org/en", "url").alias("in_url")
    )


@query("include_patterns", "SELECT page_id, url FROM pages WHERE contains(url, '/en/') OR contains(url, '/de/')")
def include_patterns(t):
    return t.pages.filter(U.has_any(F.col("url"), ["/en/", "/de/"])).select("page_id", "url")


@query("not_section", f"""
SELECT page_id, {SEGMENTS}[1] NOT IN ('fr', 'es', 'tag') AND len({SEGMENTS}) >= 2 AS keep FROM pages""")
def not_section(t):
    return t.pages.select("page_id", U.not_section(F.col("url"), ["fr", "es", "tag"]).alias("keep"))


@query("url_shapes", f"""
SELECT page_id, regexp_matches({part('path')}, '[0-9]/*$') AND len({SEGMENTS}) >= 2 AS digit_tail,
       regexp_matches({part('path')}, '^/[a-z]+/[0-9]+') AS numeric_second, regexp_matches({part('path')}, '/en/[0-9]*[13579][/]*$') AS odd_page,
       contains({part('path')}, '/dp/') AS product_path, ends_with({part('path')}, '/buy') AS ends_buy
FROM pages""")
def url_shapes(t):
    c = F.col("url")
    numeric = F.regexp_replace(c, r"/(\d+).*$", "/$1/x")
    dashed = F.regexp_replace(c, r"/en/\d*[13579](/?)(?=[?#]|$)", "/en/x-p7")
    return t.pages.select(
        "page_id", U.shape(c, "digit_tail").alias("digit_tail"), U.shape(numeric, "numeric_second").alias("numeric_second"),
        U.shape(dashed, "dash_p_id").alias("odd_page"), U.shape(c, "product_path").alias("product_path"),
        U.shape(c, "ends_buy").alias("ends_buy"),
    )


@query("url_keywords", "SELECT page_id, regexp_matches(lower(url), 'pills|spam|ththan') AS hit FROM pages")
def url_keywords(t):
    return t.pages.select("page_id", U.has_keyword(F.col("url"), ["pills", "spam", "ththan"]).alias("hit"))


@query("slugify", """
SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_name || '!'), '[^a-z0-9]+', '-', 'g'), '-') AS dash,
       lower(regexp_replace(trim(regexp_replace(p_brand || ' ' || p_name || '!', '[^a-zA-Z0-9\\s-]', '', 'g')), '\\s+', '-', 'g')) AS words
FROM part""")
def slugify(t):
    text = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit("!"))
    return t.part.select("p_partkey", U.slugify(text).alias("dash"), U.slugify(text, "words").alias("words"))


@query("item_url", """
SELECT p_partkey, 'https://shop.example/' || replace(p_name, ' ', '-') ||
       CASE WHEN p_size > 25 THEN '/p/' || p_brand ELSE '/' || CAST(p_partkey AS VARCHAR) END AS item,
       'https://news.example/' || replace(p_name, ' ', '-') || '/features/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS VARCHAR) AS article
FROM part""")
def item_url(t):
    sku = F.when(F.col("p_size") > 25, F.col("p_brand"))
    uid = F.col("p_partkey").cast("string")
    name = F.col("p_name")
    return t.part.select(
        "p_partkey", U.item_url(F.lit("https://shop.example"), U.slugify(name), sku, uid).alias("item"),
        U.article_url(F.lit("https://news.example"), name, F.lit(""), name, uid).alias("article"),
    )


@query("url_hash", "SELECT page_id, md5(url) AS url_md5, md5(url || '|{''rank'': ' || CAST(page_id AS VARCHAR) || '}') AS key_md5 FROM pages")
def url_hash(t):
    c = F.col("url")
    return t.pages.select(
        "page_id", U.uniq_id(c).alias("url_md5"), U.uniq_id(c, F.col("page_id"), compat=True).alias("key_md5")
    )


@query("valid_name", """
SELECT p_partkey, regexp_matches(p_name, '^[a-zA-Z0-9_-]+$') AS raw, regexp_matches(replace(p_name, ' ', '_'), '^[a-zA-Z0-9_-]+$') AS fixed
FROM part""")
def valid_name(t):
    c = F.col("p_name")
    return t.part.select(
        "p_partkey", U.valid_name(c).alias("raw"), U.valid_name(F.replace(c, F.lit(" "), F.lit("_"))).alias("fixed")
    )


@query("drop_tracking", """
SELECT page_id, regexp_replace(url, '[?#].*$', '') || CASE WHEN contains(url, 'page=') THEN '?page=' || regexp_extract(url, 'page=([^&#]*)', 1) ELSE '' END AS clean
FROM pages""")
def drop_tracking(t):
    return t.pages.select("page_id", U.drop_tracking(F.col("url"), ["page"]).alias("clean"))


@query("hash_shard", f"""
SELECT page_id, {DOMAIN} AS domain, CAST((('0x' || md5({DOMAIN}))::UHUGEINT) % 97 AS INTEGER) AS shard FROM pages""")
def hash_shard(t):
    d = U.domain(F.col("url"))
    return t.pages.select("page_id", d.alias("domain"), U.hash_shard(d, 97).alias("shard"))


# ---- page-list generators -------------------------------------------------------------------

def _pages_sql(expr: str, lo: str, hi: str, table: str = "pages", keys: str = "page_id") -> str:
    return f"""
SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY i) AS INTEGER) AS page_pos, {expr} AS page_url
FROM (SELECT *, unnest(generate_series({lo}, {hi})) AS i FROM {table})"""


_BASE = "rtrim(url, '/')"


@query("wordpress_pages", _pages_sql(f"{_BASE} || '/page/' || CAST(i AS VARCHAR) || '/'", "2", "11"))
def wordpress_pages(t):
    return P.paginate(t.pages, "url", "wordpress").select("page_id", "page_pos", "page_url")


_SET_PAGE = """CASE WHEN contains(url, 'page=') THEN regexp_replace(url, 'page=[^&#]*', 'page=' || CAST(i AS VARCHAR))
  ELSE regexp_replace(url, '#.*$', '') || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=' || CAST(i AS VARCHAR)
       || regexp_extract(url, '(#.*)$', 1) END"""


@query("querystring_pages", _pages_sql(_SET_PAGE, "2", "9"))
def querystring_pages(t):
    return P.paginate(t.pages, "url", "querystring", start=2, count=8).select("page_id", "page_pos", "page_url")


@query("shopify_pages", _pages_sql(_SET_PAGE, "1", "10"))
def shopify_pages(t):
    return P.paginate(t.pages, "url", "shopify").select("page_id", "page_pos", "page_url")


@query("path_number_pages", _pages_sql(f"{_BASE} || '/' || CAST(i AS VARCHAR) || '/'", "1", "10"))
def path_number_pages(t):
    return P.paginate(t.pages, "url", "path_number").select("page_id", "page_pos", "page_url")


@query("append_pages", _pages_sql("url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'p=' || CAST(i AS VARCHAR)", "2", "11"))
def append_pages(t):
    return P.paginate(t.pages, "url", "append", param="p").select("page_id", "page_pos", "page_url")


@query("counted_pages", """
WITH n AS (SELECT o_orderkey, CAST(ceil(o_totalprice / 1000 / 12) AS INTEGER) AS pages, 'https://shop.example/c' || CAST(o_custkey AS VARCHAR) AS url FROM orders)
SELECT o_orderkey, CAST(i AS INTEGER) AS page_pos, url || '?page=' || CAST(i AS VARCHAR) AS page_url
FROM (SELECT *, unnest(generate_series(1, pages - 1)) AS i FROM n WHERE pages > 1)
UNION ALL SELECT o_orderkey, 1, url FROM n WHERE pages <= 1""")
def counted_pages(t):
    seeds = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("items"),
                            F.concat(F.lit("https://shop.example/c"), F.col("o_custkey").cast("string")).alias("url"))
    return P.paginate(seeds, "url", "counted", items=F.col("items")).select("o_orderkey", "page_pos", "page_url")


@query("labelled_pages", """
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS page_pos, 'https://shop.example/s?k=' || p_type || '&page=' || CAST(i AS VARCHAR) AS page_url
FROM (SELECT *, unnest(generate_series(2, CASE WHEN p_size > 40 THEN p_partkey % 20 + 2 ELSE p_size END)) AS i FROM part)""")
def labelled_pages(t):
    labels = F.when(F.col("p_size") > 40, F.array(F.lit("Next"))).otherwise(
        F.array(F.lit("1"), F.concat(F.lit(" "), F.col("p_size").cast("string")), F.lit("Next"))
    )
    seeds = t.part.select("p_partkey", labels.alias("labels"), F.concat(F.lit("https://shop.example/s?k="), F.col("p_type")).alias("url"))
    return P.paginate(seeds, "url", "labelled", labels=F.col("labels"), unlabelled=F.col("p_partkey") % 20 + 2).select("p_partkey", "page_pos", "page_url")


@query("next_pages", """
WITH s AS (SELECT page_id, url, TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS INTEGER) AS here, contains(url, '#top') AS has_next FROM pages),
g AS (SELECT *, unnest(generate_series(1, CASE WHEN has_next THEN 1 ELSE page_id % 15 + 1 END)) AS i FROM s)
SELECT page_id, CAST(i AS INTEGER) AS page_pos, CASE WHEN has_next THEN url || '-next'
  WHEN here IS NOT NULL THEN regexp_replace(url, 'page=[0-9]+', 'page=' || CAST(here + i AS VARCHAR))
  ELSE url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 'page=' || CAST(i + 1 AS VARCHAR) END AS page_url
FROM g""")
def next_pages(t):
    link = F.when(F.contains("url", F.lit("#top")), F.concat(F.col("url"), F.lit("-next")))
    return P.paginate(t.pages, "url", "next", next_link=link, ahead=F.col("page_id") % 15 + 1).select("page_id", "page_pos", "page_url")


@query("api_pages", """
SELECT page_id, CAST(i + 1 AS INTEGER) AS page_pos,
  'https://api.example/browse?fields=SITE&currentPage=' || CAST(i AS VARCHAR) || '&pageSize=45&format=json&query=%3Arelevance&fnl=' || regexp_extract(url, '/([0-9]+)/?$', 1) AS page_url
FROM (SELECT *, unnest(generate_series(0, CASE WHEN page_id % 4 = 0 THEN 0 ELSE page_id % 30 END)) AS i FROM pages WHERE regexp_matches(url, '/[0-9]+/?$'))""")
def api_pages(t):
    """As many pages as the payload of the first says; one where it says nothing."""
    payload = F.when(F.col("page_id") % 4 != 0, F.to_json(F.struct(F.struct((F.col("page_id") % 30 + 1).alias("totalNumberOfPages")).alias("pagination")))).otherwise("{}")
    seeds = t.pages.select("page_id", U.category_code(F.col("url")).alias("code"), payload.alias("payload"))
    urls = P.api_pages("https://api.example/browse", F.col("code"), P.total_pages(F.col("payload")))
    return seeds.select("page_id", F.posexplode(urls).alias("p", "page_url")).select(
        "page_id", (F.col("p") + 1).alias("page_pos"), "page_url"
    )


@query("sitemap_shards", _pages_sql(f"CASE WHEN i < 0 THEN url ELSE {_ORIGIN} || '/sitemap/discovery/' || CAST(i AS VARCHAR) || '.xml' END", "-1", "page_id % 9"))
def sitemap_shards(t):
    return P.paginate(t.pages, "url", "sitemap", shards=F.col("page_id") % 9 + 1).select("page_id", "page_pos", "page_url")


@query("category_pages", """
SELECT p_partkey, CAST(i AS INTEGER) AS page_pos, url || CASE WHEN i = 1 THEN '' ELSE '?page=' || CAST(i AS VARCHAR) END AS page_url
FROM (SELECT *, unnest(generate_series(1, CASE WHEN p_size > 10 THEN 8 ELSE 1 END)) AS i
      FROM (SELECT p_partkey, p_size, 'https://news.example/' || p_type || CASE WHEN p_size > 10 THEN '-' || CAST(p_size AS VARCHAR) ELSE '' END AS url FROM part))""")
def category_pages(t):
    tail = F.when(F.col("p_size") > 10, F.concat(F.lit("-"), F.col("p_size").cast("string"))).otherwise("")
    seeds = t.part.select("p_partkey", F.concat(F.lit("https://news.example/"), F.col("p_type"), tail).alias("url"))
    return P.paginate(seeds, "url", "category", last=8).select("p_partkey", "page_pos", "page_url")
