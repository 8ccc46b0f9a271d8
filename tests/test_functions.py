"""Column functions against literals and the standard library."""

from decimal import Decimal
from hashlib import md5
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from pageloom.functions import classify as C, cleaning as K, embedded as E, html as H, pagination as P, urls as U


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "c string").select(fn(F.col("c")).alias("v")).first().v


def many(spark, texts, fn):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string").select("i", fn(F.col("c")).alias("v")).collect()
    return [r.v for r in sorted(rows, key=lambda r: r.i)]


def test_pagination_examples(spark):
    assert one(spark, "https://wwd.com/fashion-news/", P.wordpress_pages)[:2] == [
        "https://wwd.com/fashion-news/page/2/", "https://wwd.com/fashion-news/page/3/"]
    assert one(spark, "https://www.vogue.in/fashion/", P.querystring_pages)[0] == "https://www.vogue.in/fashion/?page=1"
    assert one(spark, "https://www.example.com/collections/women", P.shopify_pages)[9] == "https://www.example.com/collections/women?page=10"
    assert one(spark, "https://a.example/x/", P.path_number_pages)[0] == "https://a.example/x/1/"
    for fn in (P.wordpress_pages, P.shopify_pages, P.path_number_pages):
        assert len(one(spark, "https://a.example/x", fn)) == 10


def test_query_page_keeps_first_value_and_drops_blanks(spark):
    url = "https://a.example/x?b=2&a=1&a=9&blank=&q=x%20y*~#f"
    got = one(spark, url, lambda c: P.querystring_pages(c, "page", 3, 1))
    assert got == ["https://a.example/x?b=2&a=1&q=x+y%2A~&page=3#f"]
    assert one(spark, "https://a.example/?page=7&z=1", lambda c: P.querystring_pages(c, "page", 2, 1)) == ["https://a.example/?page=2&z=1"]


def test_empty_ranges_stay_empty(spark):
    assert one(spark, "https://a.example/x", lambda c: P.counted_pages(c, F.lit(12))) == ["https://a.example/x"]
    assert one(spark, "https://a.example/x", lambda c: P.counted_pages(c, F.lit(25))) == ["https://a.example/x?page=1", "https://a.example/x?page=2"]
    assert one(spark, "u", lambda c: P.labelled_pages(c, F.array(F.lit("1")), 10)) == []


def test_next_pages(spark):
    assert one(spark, "https://a.example/?q=1&page=4&z=2", lambda c: P.next_pages(c, F.lit(None).cast("string"), 10))[0] == "https://a.example/?q=1&page=5&z=2"
    assert one(spark, "https://a.example/", lambda c: P.next_pages(c, F.lit("https://a.example/n"), 10)) == ["https://a.example/n"]


def test_resolve_url_matches_the_standard_library(spark):
    bases = ["https://a.example/b/c/d?q=1#f", "https://a.example/b/c/", "https://a.example/x.html"]
    refs = ["g", "./g", "g/", "/g", "//h.example/g", "?y", "#s", "g?y#s", "../g", "../../g", "../../../g", ".", "..", "./", "../",
            "a/./b/../c", "mailto:x@y.example", "http://z.example/k", "", "/a/../b", "javascript:void(0)"]
    pairs = [(b, r) for b in bases for r in refs]
    rows = spark.createDataFrame(pairs, "b string, r string").select("b", "r", U.resolve_url(F.col("b"), F.col("r")).alias("v")).collect()
    assert {(x.b, x.r): x.v for x in rows} == {(b, r): urljoin(b, r) for b, r in pairs}


def test_url_parts_match_the_standard_library(spark):
    urls = ["https://www.a.example:80/p/x?a=1&b=2#f", "http://b.example", "/only/path?x", "https://c.example/%zz \"q\""]
    for url, v in zip(urls, many(spark, urls, U.url_parts)):
        p = urlparse(url)
        assert (v.scheme or "", v.host or "", v.path or "", v.query or "", v.fragment or "") == (p.scheme, p.netloc, p.path, p.query, p.fragment)


def test_url_key(spark):
    v = one(spark, "https://a.example/p/X|{'rank': 7}", U.split_url_key)
    assert (v.url, v.rank) == ("https://a.example/p/X", 7)
    assert one(spark, "https://a.example/", U.split_url_key).rank is None
    key = one(spark, "https://a.example/", lambda c: U.uniq_id(c, F.lit(3), compat=True))
    assert key == md5(b"https://a.example/|{'rank': 3}").hexdigest()


def test_codes_shapes_and_filters(spark):
    assert one(spark, "https://x.example/denim/p/441218669_10/", U.product_code) == "441218669_10"
    assert one(spark, "https://x.example/men/c/830301001", U.category_code) == "830301001"
    assert one(spark, "https://x.example/men/c/abc", U.category_code) is None
    assert one(spark, "https://x.example/grey-tshirt-P21842492/?a=1", lambda c: U.shape(c, "dash_p_id")) is True
    assert one(spark, "https://x.example/industry-article/123/slug", lambda c: U.shape(c, "numeric_second")) is True
    assert one(spark, "https://x.example/news/story-1234", lambda c: U.shape(c, "digit_tail")) is True
    assert one(spark, "https://x.example/1234", lambda c: U.shape(c, "digit_tail")) is False
    assert one(spark, "https://x.example/tag/story", U.not_section) is False
    assert one(spark, "https://www.x.example/a/dp/B012345678/ref=1?th=1", lambda c: U.canonical_url(c, "product")) == "https://www.x.example/a/dp/B012345678/"
    assert one(spark, "https://x.example/Kurta-Set", U.has_keyword) is True


def test_hash_shard_is_the_whole_md5(spark):
    names = ["a.example", "b.example", "x"]
    for n in (7, 97, 1 << 20):
        assert many(spark, names, lambda c: U.hash_shard(c, n)) == [int(md5(s.encode()).hexdigest(), 16) % n for s in names]


def test_prices(spark):
    texts = ["₹1,099.00", "Rs. 629.10", "M.R.P.: ₹ 999", ": ₹ 1,099", "", "—"]
    assert many(spark, texts, K.parse_price) == [Decimal("1099.00"), Decimal("629.10"), Decimal("999.00"), Decimal("1099.00"), None, None]
    assert one(spark, "₹629.10", K.parse_price_digits) == 62910
    assert one(spark, "62%999₹378", lambda c: K.list_price_from_text(c, F.lit(378))) == 999
    assert one(spark, "62%999₹378", lambda c: K.list_price_from_text(c, F.lit(500))) is None
    assert one(spark, "x" * 40 + "999₹378", lambda c: K.list_price_from_text(c, F.lit(378))) is None
    pair = one(spark, "₹999 Rs. 499.50", K.price_pair)
    assert (pair.sell, pair.list) == (Decimal("499.50"), Decimal("999.00"))


def test_discount_is_half_to_even(spark):
    rows = spark.createDataFrame([(200.0, 195.0), (200.0, 193.0), (100.0, 100.0), (None, 5.0)], "l double, s double")
    assert [r.v for r in rows.select(K.discount_pct(F.col("l"), F.col("s"), 0).alias("v")).collect()] == [2, 4, 0, 0]


def test_ratings_counts_timestamps(spark):
    assert one(spark, "4.1 out of 5 stars", K.parse_rating) == 4.1
    assert many(spark, ["80,888 ratings", "0", "none"], K.parse_count) == [80888, None, None]
    texts = ["Mar 11, 2026 @ 23:26:23.030", "2026-03-11T23:26:23.030", "2026-03-11T23:26:23", "2026-03-11 23:26:23.030", "2026-03-11 23:26:23", "11/03/2026"]
    assert many(spark, texts, K.parse_timestamp_multi) == [
        "2026-03-11T23:26:23.030Z", "2026-03-11T23:26:23.030Z", "2026-03-11T23:26:23.000Z", "2026-03-11T23:26:23.030Z", "2026-03-11T23:26:23.000Z", None]


def test_page_classes(spark):
    long_text = "word " * 200
    df = spark.createDataFrame(
        [(0, 200, long_text), (1, 200, "short"), (2, 403, long_text), (3, 200, long_text + "You are BLOCKED"), (4, 404, ""),
         (5, 200, long_text + "Just a Moment"), (6, None, None)], "i int, s int, h string")
    rows = df.select("i", C.is_blocked(F.col("s"), F.col("h"), 500).alias("b"), C.is_ok(F.col("s"), F.col("h")).alias("ok")).orderBy("i").collect()
    assert [r.b for r in rows] == [False, True, True, True, False, True, False]
    assert [r.ok for r in rows] == [True, True, False, True, False, True, False]
    sample = ["x" * 7990 + "robot check", "Robot Check", "oops! something went wrong"]
    assert many(spark, sample, lambda c: C.is_challenge_page(c, sample=8000)) == [False, True, True]
    assert many(spark, sample, C.is_challenge_page) == [True, True, True]


def test_each_signal_alone_is_found(spark):
    assert all(many(spark, ["~" + s.upper() for s in C.CHALLENGE_SIGNALS], C.is_challenge_page))
    assert all(many(spark, ["word " * 200 + s.upper() for s in C.BLOCK_SIGNALS], lambda c: C.is_blocked(F.lit(200), c, 500)))


def test_html_columns(spark):
    page = "<head><META NAME='description' content='a &amp; b'><title>T</title></head><h1 class=x>Big <b>name</b></h1><article>x<script>no</script> y<!-- z --></article>"
    assert one(spark, page, lambda c: H.meta(c, "description")) == "a & b"
    assert one(spark, page, H.h1) == "Big name"
    assert one(spark, page, H.container_text) == "x y"
    assert one(spark, "<a data-x='1' href='/q?a=1&amp;b=2'>", H.hrefs) == ["/q?a=1&b=2"]
    assert one(spark, '<script>{"mrp" : 1299, "x":1}</script>', lambda c: H.script_value(c, "mrp")) == "1299"


def test_balanced_slice():
    assert E.balanced(' = {"a": "}{", "b": [1, {"c": 2}]}; x') == '{"a": "}{", "b": [1, {"c": 2}]}'
    assert E.balanced("no braces") is None
    assert E.balanced('{"open": 1') is None
