"""Site rule sets on small pages, all in one job."""

from decimal import Decimal

from pageloom.operators import extraction as X
from pageloom.plans.rules import RULE_SETS, rule_set_of

LD = '<script type="application/ld+json">%s</script>'
PRODUCT = LD % '{"@type":"Product","name":"blue shirt","brand":{"name":"Acme"},"sku":"S1","productID":"P1","offers":{"price":"378","highPrice":999,"availability":"http://schema.org/InStock","seller":{"name":"Sel"}},"description":"Color : navy, Fit: slim","aggregateRating":{"ratingValue":"4.26","reviewCount":12}}'
PAGES = {
    "generic_commerce": '<h1 class="pdp-title">Tee</h1><b class="mrp">₹1,299.50</b><b class="selling-price">₹999</b><i class="discount">(23% off)</i>'
                        '<u class="size-button">S</u><u class="size-button"> M </u><p class="description">a<br>b</p><meta name="sku" content="K1">',
    "generic_media": '<h1>Head</h1><meta name="author" content="Ann"><time datetime="2026-01-02">x</time><article><p>one <b>two</b></p></article>',
    "flipkart_com": PRODUCT + '<div class="c">62%999₹378</div>',
    "limeroad_com": PRODUCT + "<span>M.R.P:</span><span>₹ 1,099</span>",
    "myntra_com": '<script>window.__myx = {"pdpData":{"name":"N {x}","mrp":500,"price":{"mrp":800,"discounted":600},"ratings":{"averageRating":4.25,"totalCount":7},"id":55,"baseColour":"Red","brand":{"name":"B"}}};</script>',
    "shoppersstop_com": '<script id="__NEXT_DATA__">{"props":{"pageProps":{"pdpData":{"data":{"products":{"items":[{"name":" Nm ","brand_name":"Br","sku":9,"price_range":{"minimum_price":{"final_price":{"value":70.5},"regular_price":{"value":null}}},"variants":[{"product":{"price_range":{"minimum_price":{"regular_price":{"value":100}}}}}],"rating_summary":4.44,"image":{"url":"u"}}]}}}}}}</script>',
    "amazon_in": '<span id="productTitle"> Big Shirt </span><span id="_price">₹999 <s>M.R.P. ₹1,999</s></span><a id="bylineInfo">Visit the Acme</a>'
                 '<span id="acrCustomerReviewText">80,888 ratings</span><tr><th>ASIN</th><td>B01</td></tr>',
    "business_of_fashion": LD % '{"@type":"NewsArticle","headline":"H","author":[{"name":"A"},{"name":"B"}],"datePublished":"2026-01-01","articleBody":"short"}' + "<article><p>body</p></article>",
    "apollo_media": '<script id="__NEXT_DATA__">{"props":{"pageProps":{"apolloState":{"U:1":{"name":" Ann "},"A:1":{"__typename":"LocalNewsArticle","title":"T","dek":"<b>d</b>","creator":{"__ref":"U:1"},"body({})":"<p>x</p>","imageUrls({})":["i1","i2"],"insertedAt":"2026"}}}}}</script>',
    "just_style_com": '<h1>News - Just Style</h1><div class="article"><p>p</p></div>',
}


def test_all_sets_in_one_job(spark):
    rows = [(i, f"https://x.example/a/p/{i}", html, name) for i, (name, html) in enumerate(PAGES.items())]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string, rule_set string")
    got = {r.rule_set: r for r in X.extract_fields(pages, RULE_SETS).collect()}
    assert all(r.errors == [] for r in got.values())

    g = got["generic_commerce"]
    assert (g.product_name, g.list_price, g.selling_price, g.discount_percentage, g.size, g.description, g.sku) == (
        "Tee", Decimal("1299.50"), Decimal("999.00"), 23, "S, M", "a b", "K1")
    m = got["generic_media"]
    assert (m.article_title, m.author_name, m.post_date, m.article_content, m.image_url) == ("Head", "Ann", "2026-01-02", "one two", None)
    f = got["flipkart_com"]
    assert (f.product_name, f.brand, f.list_price, f.selling_price, f.discount_percentage, f.rating, f.num_reviews) == (
        "blue shirt", "Acme", Decimal("999.00"), Decimal("378.00"), 62, 4.3, 12)
    lr = got["limeroad_com"]
    assert (lr.product_name, lr.list_price, lr.color, lr.seller, lr.sku) == ("Blue Shirt", Decimal("1099.00"), "navy", "Sel", "P1")
    my = got["myntra_com"]
    assert (my.product_name, my.list_price, my.selling_price, my.discount_percentage, my.rating, my.num_reviews, my.sku, my.color) == (
        "N {x}", Decimal("800.00"), Decimal("600.00"), 25, 4.2, 7, "55", "Red")
    ss = got["shoppersstop_com"]
    assert (ss.product_name, ss.brand, ss.sku, ss.list_price, ss.selling_price, ss.rating, ss.image_url) == (
        "Nm", "Br", "9", Decimal("100.00"), Decimal("70.50"), 4.4, "u")
    az = got["amazon_in"]
    assert (az.product_name, az.list_price, az.selling_price, az.discount_percentage, az.brand, az.num_reviews, az.sku) == (
        "Big Shirt", Decimal("1999.00"), Decimal("999.00"), 50, "Acme", 80888, "B01")
    bof = got["business_of_fashion"]
    assert (bof.article_title, bof.author_name, bof.article_content) == ("H", "A, B", "body")
    ap = got["apollo_media"]
    assert (ap.article_title, ap.sub_title, ap.author_name, ap.article_content, ap.image_url) == ("T", "d", "Ann", "x", "i1")
    assert got["just_style_com"].article_title == "News"


def test_rule_order_of_other_fields_does_not_matter(spark):
    pages = spark.createDataFrame([(1, "https://x.example/", PAGES["generic_media"], "s")], "page_id int, url string, html string, rule_set string")
    rules = RULE_SETS["generic_media"]
    a = X.extract_fields(pages, {"s": rules}).first().asDict()
    b = X.extract_fields(pages, {"s": rules[::-1]}).first().asDict()
    assert a == b


def test_rule_set_of():
    assert rule_set_of("commerce_crawl", "zudio_com") == "generic_commerce"
    assert rule_set_of("media_crawl", "bbc_com") == "generic_media"
    assert rule_set_of("commerce_crawl", "max_com") == "folded_commerce"
    assert rule_set_of("media_crawl", "wwd_com") == "wwd_com"


def test_register_rule(spark):
    from pyspark.sql import functions as F

    X.register_rule("mine", X.Rule("name", "column", lambda html, url: F.upper(html)))
    pages = spark.createDataFrame([(1, "u", "x", "mine")], "page_id int, url string, html string, rule_set string")
    assert X.extract_fields(pages, {"mine": X.RULE_SETS.pop("mine")}).first().name == "X"


def test_failures_of_column_rules_are_told_and_counted(spark):
    from pyspark.sql import Observation

    rules = {"a": [
        X.Rule("list_price", "meta", "price", post="price"), X.Rule("list_price", "meta", "other", post="price"), X.Rule("brand", "ldjson", ("$.brand",)),
        X.Rule("color", "next", "$.color"), X.Rule("title", "xpath", "//title/text()")], "b": [X.Rule("title", "meta", "title")]}
    meta = lambda n, v: f'<meta name="{n}" content="{v}">'
    next_data = '<script id="__NEXT_DATA__">{}</script>'
    pages = [
        (1, "a", meta("price", "free") + meta("other", "12.50") + next_data.format('{"color":"red"}')),  # the second candidate has it
        (2, "a", meta("price", "free") + next_data.format("{bad") + '<script type="application/ld+json">{bad</script>'),
        (3, "a", "<title>t</title>"), (4, "a", None), (5, "b", "x"), (6, None, meta("price", "free"))]
    df = spark.createDataFrame([(i, "https://x.example/", h, r) for i, r, h in pages], "page_id int, url string, html string, rule_set string")
    seen = Observation()
    got = {r.page_id: sorted(r.errors) for r in X.extract_fields(df, rules, observation=seen).collect()}
    assert got == {1: [], 2: ["brand: json", "color: json", "list_price: cast"], 3: [], 4: [], 5: [], 6: []}
    assert {(r.rule_set, r.field, r.kind, r.n) for r in X.observed(spark, seen).collect()} == {
        ("a", "list_price", "cast", 1), ("a", "list_price", "empty", 2), ("a", "brand", "json", 1), ("a", "brand", "empty", 3),
        ("a", "color", "json", 1), ("a", "color", "empty", 2), ("a", "title", "empty", 3), ("b", "title", "empty", 1)}
    assert X.extract_fields(df, rules).columns == X.extract_fields(df, rules, observation=Observation()).columns


def test_pages_pass_in_small_arrow_batches(spark):
    """Bounded by rows and bytes: a worker holds several copies of a batch of whole pages."""
    from pageloom.operators import extraction as X

    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.unset(n)
        pages = spark.createDataFrame([(1, "u", "<p>x</p>", "own")], "page_id int, url string, html string, rule_set string")
        assert X.extract_fields(pages, {"own": [X.Rule("content", "xpath", "//p/text()")]}).first()["content"] == "x"
        assert [spark.conf.get(n) for n in names] == ["512", "8m"]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
