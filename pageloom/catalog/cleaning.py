"""Field cleaning, checked on texts made from table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalog.base import query
from pageloom.functions import cleaning as K

SELL = "CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(12,2))"
LIST = "CAST(l_extendedprice AS DECIMAL(12,2))"
LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate"


def _line():
    return [c.strip() for c in LINE.split(",")]


def _sell():
    return F.round(_list() * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast(K.PRICE)


def _list():
    return F.col("l_extendedprice").cast(K.PRICE)


@query("parse_price", """
SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS plain, CAST(p_retailprice * 1000 AS DOUBLE) AS grouped, CAST(NULL AS DOUBLE) AS absent,
       CAST(replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', '') AS BIGINT) AS digits
FROM part""")
def parse_price(t):
    text = F.col("p_retailprice").cast(K.PRICE).cast("string")
    grouped = F.concat(F.lit("M.R.P.: ₹ "), F.format_number(F.col("p_retailprice") * 1000, 2), F.lit(" only"))
    return t.part.select(
        "p_partkey", K.parse_price(F.concat(F.lit("Rs. "), text)).cast("double").alias("plain"),
        K.parse_price(grouped).cast("double").alias("grouped"), K.parse_price(F.lit("—")).cast("double").alias("absent"),
        K.parse_price_digits(F.concat(F.lit("₹"), text)).alias("digits"),
    )


@query("price_pair", f"""
SELECT {LINE}, CAST(least({SELL}, {LIST}) AS DOUBLE) AS sell, CASE WHEN l_returnflag <> 'N' THEN CAST(greatest({SELL}, {LIST}) AS DOUBLE) END AS list
FROM (SELECT * REPLACE (CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_discount END AS l_discount) FROM lineitem)""")
def price_pair(t):
    sell = F.when(F.col("l_returnflag") == "N", _list()).otherwise(_sell()).cast("string")
    text = F.concat(F.lit("now Rs. "), sell, F.when(F.col("l_returnflag") != "N", F.concat(
        F.lit(" was ₹"), F.format_number("l_extendedprice", 2), F.lit(" or ₹1.00"))).otherwise(""))
    return t.lineitem.select(*_line(), K.price_pair(text).alias("p")).select(
        *_line(), F.col("p.sell").cast("double").alias("sell"), F.col("p.list").cast("double").alias("list")
    )


@query("list_price_from_text", f"""
SELECT {LINE}, CASE WHEN l > s AND l > 99 THEN l END AS found
FROM (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS l, CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT) AS s FROM lineitem)""")
def list_price_from_text(t):
    full, sell = F.floor("l_extendedprice").cast("bigint"), F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint")
    text = F.concat(F.lit("62%"), full.cast("string"), F.lit("₹"), sell.cast("string"))
    return t.lineitem.select(*_line(), K.list_price_from_text(text, sell).alias("found"))


@query("price_fallbacks", f"""
SELECT {LINE}, CAST(coalesce(lp, v, sp) AS DOUBLE) AS list_price, CAST(coalesce(sp, lp, v) AS DOUBLE) AS selling_price
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN {LIST} END AS lp, CASE WHEN l_linestatus = 'F' THEN {SELL} END AS sp,
             CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN CAST(l_quantity AS DECIMAL(12,2)) END AS v FROM lineitem)""")
def price_fallbacks(t):
    variants = F.array(F.lit(0).cast(K.PRICE), F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 25), F.col("l_quantity").cast(K.PRICE)))
    rows = t.lineitem.select(
        *_line(), F.when(F.col("l_returnflag") != "R", _list()).alias("list_price"),
        F.when(F.col("l_linestatus") == "F", _sell()).alias("selling_price"), variants.alias("variants"),
    )
    out = K.with_price_fallbacks(rows, variant_col="variants")
    return out.select(*_line(), F.col("list_price").cast("double").alias("list_price"), F.col("selling_price").cast("double").alias("selling_price"))


@query("discount_pct", f"""
SELECT {LINE}, CASE WHEN sp < lp THEN CAST(round_even((lp - sp) / lp * 100, 0) AS INTEGER) ELSE 0 END AS or_zero,
       CASE WHEN sp < lp THEN CAST(round_even((lp - sp) / lp * 100, 0) AS INTEGER) END AS or_null
FROM (SELECT *, CAST({LIST} AS DOUBLE) AS lp, CAST({SELL} AS DOUBLE) AS sp FROM lineitem)""")
def discount_pct(t):
    return t.lineitem.select(
        *_line(), K.discount_pct(_list(), _sell(), 0).alias("or_zero"), K.discount_pct(_list(), _sell()).alias("or_null")
    )


@query("percent_from_text", "SELECT p_partkey, p_size AS pct, CAST(NULL AS INTEGER) AS absent FROM part")
def percent_from_text(t):
    text = F.concat(F.lit("Save 3 now ("), F.col("p_size").cast("string"), F.lit(" % off)"))
    return t.part.select("p_partkey", K.percent_from_text(text).alias("pct"), K.percent_from_text(F.lit("5 off")).alias("absent"))


@query("parse_rating", "SELECT event_id, round_even(CAST(regexp_extract(CAST(value AS VARCHAR), '([0-9]+(?:\\.[0-9]+)?)', 1) AS DOUBLE), 1) AS rating FROM events")
def parse_rating(t):
    text = F.concat(F.lit("Rated "), F.col("value").cast("string"), F.lit(" out of 500 stars"))
    return t.events.select("event_id", K.parse_rating(text).alias("rating"))


@query("parse_count", "SELECT event_id, CASE WHEN event_id > 0 THEN event_id * 1000 END AS ratings FROM events")
def parse_count(t):
    text = F.concat(F.lit("("), F.format_number(F.col("event_id") * 1000, 0), F.lit(" ratings, 7 reviews)"))
    return t.events.select("event_id", K.parse_count(text).alias("ratings"))


@query("availability", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'in_stock' WHEN 'O' THEN 'out_of_stock' END AS by_code,
       CASE o_orderstatus WHEN 'F' THEN 'in_stock' ELSE 'out_of_stock' END AS by_url FROM orders""")
def availability(t):
    s = F.col("o_orderstatus")
    code = F.when(s == "F", "inStock").when(s == "O", "lowStock").otherwise("")
    url = F.when(s == "F", "https://schema.org/InStock").otherwise("https://schema.org/SoldOut")
    return t.orders.select("o_orderkey", K.availability(code).alias("by_code"), K.availability(url).alias("by_url"))


_CATS = "CASE p_type WHEN 'SMALL' THEN ['Home', 'Women Tops'] WHEN 'LARGE' THEN ['Boys wear'] WHEN 'PROMO' THEN ['Kid', 'Men'] ELSE ['Home'] END"


def _cats():
    t = F.col("p_type")
    return (
        F.when(t == "SMALL", F.array(F.lit("Home"), F.lit("Women Tops"))).when(t == "LARGE", F.array(F.lit("Boys wear")))
        .when(t == "PROMO", F.array(F.lit("Kid"), F.lit("Men"))).otherwise(F.array(F.lit("Home")))
    )


@query("gender", """
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'Women' WHEN 'LARGE' THEN 'Men' WHEN 'PROMO' THEN 'Kids'
  ELSE CASE WHEN p_size > 40 THEN 'Women' WHEN p_size > 30 THEN 'Men' WHEN p_size > 20 THEN 'Kids' END END AS gender FROM part""")
def gender(t):
    size = F.col("p_size")
    name = F.when(size > 40, "Red women dress").when(size > 30, "Men shirt").when(size > 20, "KIDS cap").otherwise(F.lit("cap"))
    return t.part.select("p_partkey", K.gender(_cats(), name).alias("gender"))


@query("category", f"""
SELECT p_partkey, ({_CATS})[1] AS category, CASE WHEN len({_CATS}) >= 2 THEN ({_CATS})[-1] END AS sub_category FROM part""")
def category(t):
    return t.part.select("p_partkey", K.category(_cats()).alias("category"), K.sub_category(_cats()).alias("sub_category"))


@query("available_sizes", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate,
  nullif(concat_ws(', ', CASE WHEN l_returnflag <> 'R' THEN 'S' END, CASE WHEN l_linestatus = 'F' THEN 'M' END), '') AS sizes,
  CAST((l_returnflag <> 'R')::INT + (l_linestatus = 'F')::INT AS INTEGER) AS n
FROM lineitem""")
def available_sizes(t):
    stock = lambda ok: F.when(ok, "inStock").otherwise("outOfStock")
    variants = F.array(
        F.struct(F.lit("S").alias("label"), stock(F.col("l_returnflag") != "R").alias("stock")),
        F.struct(F.lit("").alias("label"), stock(F.lit(True)).alias("stock")),
        F.struct(F.lit("M").alias("label"), stock(F.col("l_linestatus") == "F").alias("stock")),
    )
    sizes = K.available_sizes(variants)
    return t.lineitem.select(*_line(), K.joined(sizes).alias("sizes"), K.sizes_count(sizes).alias("n"))


@query("material", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_size > 25 THEN p_brand ELSE p_name END AS material FROM part""")
def material(t):
    f = lambda name, value: F.struct(name.alias("name"), value.alias("value"))
    plain = F.col("p_type") == "PROMO"
    features = F.array(
        f(F.lit("Fit"), F.lit("Slim")),
        f(F.when((F.col("p_size") > 25) & ~plain, "Fabric type").otherwise("Neck"), F.col("p_brand")),
        f(F.when(plain, "Care").otherwise("Upper MATERIAL"), F.col("p_name")),
    )
    return t.part.select("p_partkey", K.material(features).alias("material"))


def _raw_images():
    return F.concat(
        F.array(F.lit("//cdn.example/a.jpg"), F.lit(""), F.concat(F.lit("/b"), F.col("page_id").cast("string"), F.lit(".jpg")), F.col("url"), F.lit(None).cast("string")),
        F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.concat(F.lit("http://x.example/"), i.cast("string"))),
    )


@query("image_urls_all", """
SELECT page_id, 'https://cdn.example/a.jpg, https://img.example/b' || CAST(page_id AS VARCHAR) || '.jpg, ' || url || ', ' ||
  array_to_string(list_transform(generate_series(1, 9), lambda i: 'http://x.example/' || CAST(i AS VARCHAR)), ', ') AS images
FROM pages""")
def image_urls_all(t):
    return t.pages.select("page_id", K.joined(K.images(_raw_images(), "https://img.example")).alias("images"))


@query("image_urls", """
SELECT page_id, 'https://cdn.example/a.jpg, https://img.example/b' || CAST(page_id AS VARCHAR) || '.jpg, ' || url || ', ' ||
  array_to_string(list_transform(generate_series(1, 5), lambda i: 'http://x.example/' || CAST(i AS VARCHAR)), ', ') AS images, 'https://cdn.example/a.jpg' AS primary_image
FROM pages""")
def image_urls(t):
    """With the limit of eight that a site's rule may give."""
    out = K.images(_raw_images(), "https://img.example", cap=8)
    return t.pages.select("page_id", K.joined(out).alias("images"), K.primary_image(out).alias("primary_image"))


@query("color_from_text", "SELECT p_partkey, split_part(p_name, ' ', 1) AS color FROM part")
def color_from_text(t):
    text = F.concat(F.lit("Fit: slim, Color : "), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)), F.lit(" , Size: M"))
    return t.part.select("p_partkey", K.color_from_text(text).alias("color"))


@query("clean_brand", "SELECT p_partkey, p_brand AS a, p_brand AS b, p_brand || ' Brand: x' AS c FROM part")
def clean_brand(t):
    b = F.col("p_brand")
    return t.part.select(
        "p_partkey", K.clean_brand(F.concat(F.lit(" Visit the "), b)).alias("a"), K.clean_brand(F.concat(F.lit("Brand: "), b)).alias("b"),
        K.clean_brand(F.concat(b, F.lit(" Brand: x"))).alias("c"),
    )


@query("clean_title", """
SELECT p_partkey, p_name AS title, upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
  upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) AS cased FROM part""")
def clean_title(t):
    sep = F.when(F.col("p_size") > 25, " - ").otherwise(" | ")
    return t.part.select(
        "p_partkey", K.clean_title(F.concat(F.col("p_name"), sep, F.lit("just STYLE ")), "Just Style").alias("title"),
        K.title_case(F.col("p_name")).alias("cased"),
    )


@query("authors", """
SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN p_brand WHEN 'SMALL' THEN p_brand || ', ' || p_name WHEN 'LARGE' THEN p_name ELSE NULL END AS author FROM part""")
def authors(t):
    obj = lambda c: F.to_json(F.struct(c.alias("name")))
    brand, name = F.col("p_brand"), F.col("p_name")
    text = (
        F.when(F.col("p_type") == "PROMO", obj(brand))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit("["), obj(brand), F.lit(',{"name":""},'), obj(name), F.lit("]")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit('"'), name, F.lit('"')))
        .otherwise(F.lit('"https://site.example"'))
    )
    rows = t.part.select("p_partkey", F.try_parse_json(text).alias("v"))
    return rows.select("p_partkey", K.authors(F.col("v"), "site.example").alias("author"))


@query("truncate_text", """
SELECT doc_id, CASE WHEN length(text) > 300 THEN left(text, 300) || '…' ELSE text END AS short, left(text, 500) AS head FROM documents""")
def truncate_text(t):
    return t.documents.select("doc_id", K.truncate_text(F.col("text")).alias("short"), F.left("text", F.lit(500)).alias("head"))


@query("placeholder_to_null", "SELECT doc_id, CASE WHEN lang <> 'de' THEN source END AS size FROM documents")
def placeholder_to_null(t):
    text = F.when(F.col("lang") == "de", " loading...").otherwise(F.col("source"))
    return t.documents.select("doc_id", K.placeholder_to_null(text).alias("size"))


@query("join_nonempty", """
SELECT doc_id, CASE WHEN lang = 'es' THEN NULL ELSE concat_ws(', ', CASE WHEN lang = 'en' THEN source END, lang) END AS joined FROM documents""")
def join_nonempty(t):
    lang = F.col("lang")
    arr = F.array(F.when(lang == "en", F.concat(F.lit(" "), F.col("source"))).otherwise("  "), F.when(lang != "es", lang).otherwise(""))
    return t.documents.select("doc_id", K.join_nonempty(arr, ", ").alias("joined"))


_ISO = "strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z')"
_ISO_MS = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')"


@query("parse_timestamp", f"""
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN {_ISO} WHEN 'purchase' THEN {_ISO} ELSE {_ISO_MS} END AS iso FROM events""")
def parse_timestamp(t):
    ts, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "view", F.date_format(ts, "MMM dd, yyyy @ HH:mm:ss.SSS"))
        .when(kind == "click", F.when(F.col("value") > 30, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(kind == "purchase", F.date_format(ts, " yyyy-MM-dd HH:mm:ss "))
        .otherwise(F.date_format(ts, "dd/MM/yyyy"))
    )
    return t.events.select("event_id", K.parse_timestamp_multi(text).alias("iso"))


@query("format_time", """
SELECT event_id, CASE event_type WHEN 'error' THEN '—' WHEN 'view' THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS shown FROM events""")
def format_time(t):
    kind = F.col("event_type")
    text = F.when(kind == "error", "").when(kind == "view", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t.events.select("event_id", K.format_time(text).alias("shown"))


@query("drop_empty", "SELECT doc_id, nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, '') AS lang, source FROM documents")
def drop_empty(t):
    return K.drop_empty(t.documents.select("doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"), "source"))


@query("index_name", "SELECT p_partkey, 'web-' || lower(replace(p_brand || '_' || p_type, '_', '-')) AS index_name FROM part")
def index_name(t):
    return t.part.select("p_partkey", K.index_name(F.concat_ws("_", "p_brand", "p_type"), "web-").alias("index_name"))


@query("rule_set_key", """
SELECT p_partkey, upper(left(a, 1)) || substr(a, 2) || upper(left(b, 1)) || substr(b, 2) || 'MediaCrawl' AS class_key
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part)""")
def rule_set_key(t):
    site = F.replace("p_name", F.lit(" "), F.lit("_"))
    return t.part.select("p_partkey", K.rule_set_key(site, F.lit("media_crawl")).alias("class_key"))


@query("search_text", "SELECT p_partkey FROM part WHERE contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'ring brand#1')")
def search_text(t):
    return K.search_text(t.part, ["p_name", "p_brand", "p_type"], "Ring BRAND#1").select("p_partkey")
