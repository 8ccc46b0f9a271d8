"""Rule sets of the supported sites.

Fixed values: the selectors and JSON paths below are what the sites' pages
need. Most sites share one of two generic sets; a custom set lists only the
fields in which it differs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pageloom.functions import cleaning as K
from pageloom.operators.extraction import POSTS, RULE_SETS, Rule

R = Rule
OG_OR_H1 = "//meta[contains(@property,'og:title')]/@content | //h1/text()"
OG_DESCRIPTION = "//meta[contains(@property,'og:description')]/@content | //meta[@name='description']/@content"
OG_IMAGE = "//meta[contains(@property,'og:image')]/@content"
META_AUTHOR = "//meta[contains(@property,'article:author')]/@content | //meta[@name='author']/@content"
PUBLISHED = "//meta[contains(@property,'article:published_time')]/@content"
EXACT_CLASS = "//*[contains(concat(' ', normalize-space(@class), ' '), ' {} ')]//text()"
FOLDED_CLASS = (
    "//span[contains(translate(@class,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'{}')]/text()"
)
ARTICLE_TYPES = ("NewsArticle", "Article")
NEXT_ITEM = "$.props.pageProps.pdpData.data.products.items[0]"

POSTS.update({
    "title_fibre2fashion": lambda c: K.clean_title(c, "Fibre2Fashion"),
    "title_theindustry": lambda c: K.clean_title(c, "TheIndustry.fashion"),
    "title_juststyle": lambda c: K.clean_title(c, "Just Style"),
    "author_fibre2fashion": lambda c: F.when(~F.contains(c, F.lit("fibre2fashion.com")), c),
    "long_body": lambda c: F.when(F.length(c) > 100, c),
})


def _asin(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/dp/([A-Z0-9]{10})", 1), F.lit(""))


def _short_class_texts(page) -> str | None:
    """Texts of at most 30 characters of elements with a class, one to a line."""
    texts = (page.string(n).strip() for n in page.nodes if n.tag and "class" in n.attrs)
    return "\n".join(" ".join(t.split()) for t in texts if t and len(t) <= 30) or None


def _list_price_in_texts() -> Column:
    found = F.transform(
        F.split(F.col("price_texts"), "\n"), lambda t: K.list_price_from_text(t, F.col("selling_price"))
    )
    return F.try_element_at(F.array_compact(found), F.lit(1)).cast(K.PRICE)


def _mrp_container(page) -> str | None:
    """Text of the element around the first text that mentions M.R.P and holds a digit."""
    for n in page.nodes:
        if n.tag is None and "M.R.P" in n.text and n.parent.parent is not None:
            text = page.string(n.parent.parent)
            if any(c.isdigit() for c in text):
                return text
    return None


def _badge_or_zero() -> Column:
    return F.coalesce(F.regexp_extract("savings_badge", r"([0-9]+)", 1).try_cast("int"), F.lit(0))


GENERIC_COMMERCE = [
    R("product_name", "xpath", "//h1[@class='pdp-title']/text() | //h1/text()"),
    R("list_price", "xpath", "//*[contains(@class,'mrp')]//text() | //*[contains(@class,'list-price')]//text()", post="price"),
    R("selling_price", "xpath", "//*[contains(@class,'selling-price')]//text() | //*[contains(@class,'price')]//text()",
      post="price"),
    R("discount_percentage", "xpath", "//*[contains(@class,'discount')]//text()", post="percent"),
    R("size", "xpath", "//*[contains(@class,'size-button')]//text()", take="join", sep=", "),
    R("color", "xpath", "//*[contains(@class,'color')]/@title | //*[contains(@class,'color')]//text()"),
    R("description", "xpath", "//*[contains(@class,'description')]//text()", take="join"),
    R("sku", "xpath", "//*[contains(@class,'sku')]//text() | //meta[@name='sku']/@content"),
]

GENERIC_MEDIA = [
    R("article_title", "xpath", "//meta[@property='og:title']/@content | //h1/text()"),
    R("sub_title", "xpath", "//meta[@property='og:description']/@content | //meta[@name='description']/@content"),
    R("author_name", "xpath",
      "//meta[@property='article:author']/@content | //meta[@name='author']/@content"
      " | //a[@rel='author']/text() | //span[contains(@class,'author')]/text()"),
    R("post_date", "xpath",
      "//meta[@property='article:published_time']/@content | //time/@datetime | //time/text()"),
    R("article_content", "xpath", "//article//p//text() | //div[contains(@class,'article-body')]//p//text()", take="join"),
    R("image_url", "xpath", "//meta[@property='og:image']/@content"),
]

MEDIA_BASE = [
    R("article_title", "xpath", OG_OR_H1),
    R("sub_title", "xpath", OG_DESCRIPTION),
    R("author_name", "xpath", META_AUTHOR),
    R("post_date", "xpath", PUBLISHED + " | //time/@datetime"),
    R("article_content", "xpath", "//article//p//text()", take="join"),
    R("image_url", "xpath", OG_IMAGE),
]


def vary(base: list[Rule], *changes: Rule) -> list[Rule]:
    """A base set with the chains of some fields replaced."""
    changed = {r.field for r in changes}
    return [r for r in base if r.field not in changed] + list(changes)


H1_THEN_OG = (
    R("article_title", "xpath", "//h1/text()"),
    R("article_title", "xpath", "//meta[contains(@property,'og:title')]/@content"),
)
ANY_DATE = R("post_date", "xpath", PUBLISHED + " | //time/@datetime | //time/text()")
LINKED_AUTHOR = R("author_name", "xpath", META_AUTHOR + " | //a[contains(@rel,'author')]/text()")
ARTICLE_OR_DIV = R("article_content", "xpath", "//article//p//text() | //div[contains(@class,'article')]//p//text()",
                   take="join")
LD_PRODUCT = [
    R("product_name", "ldjson", ("$.name",)),
    R("brand", "ldjson", ("$.brand",)),
    R("sku", "ldjson", ("$.sku",)),
    R("selling_price", "ldjson", ("$.offers.price",), post="price"),
]

RULE_SETS.update({
    "generic_commerce": GENERIC_COMMERCE,
    "generic_media": GENERIC_MEDIA,
    "amazon_in": [
        R("product_name", "xpath", "//div[@id='title_feature_div']//h1//text()", take="first_text"),
        R("product_name", "xpath", "//span[@id='productTitle']/text()", take="first_text"),
        R("product_name", "xpath", "//div[@id='title']//h1//text()", take="first_text"),
        R("product_name", "xpath", "//h1[@id='title']//text()", take="first_text"),
        R("list_price", "xpath", "//span[@id='_price'][1]", post="list_of_pair"),
        R("list_price", "xpath", "//span[@class='a-price a-text-price']//span[@class='a-offscreen']/text()", post="price"),
        R("list_price", "xpath", "//td[contains(@class,'a-color-secondary')]//span[@class='a-offscreen']/text()", post="price"),
        R("selling_price", "xpath", "//span[@id='_price'][1]", post="sell_of_pair"),
        R("selling_price", "xpath", "//span[@id='priceblock_ourprice']/text()", post="price"),
        R("selling_price", "xpath", "//span[@id='priceblock_dealprice']/text()", post="price"),
        R("selling_price", "xpath", "//span[contains(@class,'a-price-whole')]/text()", post="price"),
        R("selling_price", "xpath", "//span[contains(@class,'priceToPay')]//span[@class='a-offscreen']/text()", post="price"),
        R("selling_price", "xpath", "//div[@id='corePrice_feature_div']//span[@class='a-offscreen']/text()", post="price"),
        R("discount_percentage", "discount", _badge_or_zero),
        R("savings_badge", "xpath", "//span[contains(@class,'savingsPercentage')]/text()"),
        R("size", "xpath", "//span[contains(@id,'size_name')]//text()", post="no_placeholder"),
        R("size", "xpath", "//span[@id='native_dropdown_selected_size_name']/text()"),
        R("color", "xpath", "//span[contains(@id,'color_name')]//text()", post="no_placeholder"),
        R("color", "xpath", "//span[@id='variation_color_name']//span[@class='selection']/text()"),
        R("description", "xpath", "//div[@id='productDescription']//text()", take="join"),
        R("description", "xpath", "//div[@id='feature-bullets']//li/span[@class='a-list-item']/text()", take="join", sep=" | "),
        R("sku", "xpath", "//th[contains(text(),'ASIN')]/following-sibling::td/text()"),
        R("sku", "column", lambda html, url: _asin(url)),
        R("brand", "xpath", "//tr[th[contains(text(),'Brand')]]/td//text()"),
        R("brand", "xpath", "//a[@id='bylineInfo']/text()", post="brand"),
        R("rating", "xpath", "//i[contains(@class,'a-icon-star')]//span[@class='a-icon-alt']/text()", post="rating"),
        R("num_reviews", "xpath", "//span[@id='acrCustomerReviewText']/text()", post="count"),
        R("num_reviews", "xpath", "//a[@id='acrCustomerReviewLink']/text()", post="count"),
        R("num_reviews", "xpath", "//*[contains(@id,'CustomerReview')]//text()", take="first_text", post="count"),
    ],
    "ajio_com": [
        R("product_id", "url", "product_code"),
        R("product_name", "ldjson", ("$.name",)),
        R("product_name", "meta", "og:title"),
        R("brand", "ldjson", ("$.brand",)),
        R("brand", "xpath", "//a[contains(@class,'brand-name')]/text() | //span[contains(@class,'brand')]/text()"),
        R("list_price", "ldjson", ("$.offers.highPrice",), post="price"),
        R("list_price", "ldjson", ("$.offers.price",), post="price"),
        R("list_price", "xpath", "//span[contains(@class,'prod-cp')]/text() | //span[contains(@class,'prod-mrp')]/text()",
          post="price"),
        R("selling_price", "xpath",
          "//span[contains(@class,'prod-sp')]/text() | //span[contains(@class,'prod-selling-price')]/text()", post="price"),
        R("selling_price", "ldjson", ("$.offers.lowPrice",), post="price"),
        R("selling_price", "ldjson", ("$.offers.price",), post="price"),
        R("selling_price", "field", "list_price"),
        R("discount_percentage", "discount", 0),
        R("category", "meta", "product:category"),
        R("category", "meta", "og:section"),
        R("color", "ldjson", ("$.color",)),
        R("description", "ldjson", ("$.description",)),
        R("description", "meta", "og:description"),
        R("description", "meta", "description"),
        R("rating", "ldjson", ("$.aggregateRating.ratingValue",), post="rating"),
        R("review_count", "ldjson", ("$.aggregateRating.reviewCount",)),
        R("availability", "ldjson", ("$.offers.availability",), post="availability"),
        R("material", "ldjson", ("$.material",)),
        R("primary_image", "ldjson", ("$.image[0]",)),
        R("primary_image", "ldjson", ("$.image",)),
        R("primary_image", "meta", "og:image"),
    ],
    "flipkart_com": [
        *LD_PRODUCT,
        R("product_name", "xpath", "//h1", take="first_text"),
        R("selling_price", "ldjson", ("$.offers[0].price",), post="price"),
        R("price_texts", "python", _short_class_texts),
        R("list_price", "field", _list_price_in_texts),
        R("list_price", "field", "selling_price"),
        R("discount_percentage", "discount", 0),
        R("rating", "ldjson", ("$.aggregateRating.ratingValue",), post="rating"),
        R("num_reviews", "ldjson", ("$.aggregateRating.ratingCount",)),
        R("num_reviews", "ldjson", ("$.aggregateRating.reviewCount",)),
        R("color", "ldjson", ("$.color",)),
        R("description", "xpath", "//div[contains(@class,'_1mXcCf')]//text() | //div[@class='RmoJbe']//text()",
          take="first_text", post="long_text"),
        R("description", "ldjson", ("$.description",)),
    ],
    "limeroad_com": [
        R("product_name", "ldjson", ("$.name",), post="title_case"),
        R("product_name", "xpath", "//h1", take="first_text"),
        R("brand", "ldjson", ("$.brand",)),
        R("selling_price", "ldjson", ("$.offers.price",), post="price"),
        R("list_price", "xpath", "//span[contains(text(),'M.R.P')]/following-sibling::span[1]", post="price"),
        R("list_price", "python", _mrp_container, post="price"),
        R("list_price", "field", "selling_price"),
        R("discount_percentage", "discount", 0),
        R("sku", "ldjson", ("$.productID",)),
        R("color", "ldjson", ("$.description",), post="color"),
        R("seller", "ldjson", ("$.offers.seller.name",)),
        R("description", "ldjson", ("$.description",)),
    ],
    "myntra_com": [
        R("product_name", "state", ("window.__myx =", "$.pdpData.name")),
        R("product_name", "ldjson", ("$.name",)),
        R("brand", "state", ("window.__myx =", "$.pdpData.brand.name")),
        R("brand", "ldjson", ("$.brand.name",)),
        R("list_price", "state", ("window.__myx =", "$.pdpData.price.mrp"), post="price"),
        R("list_price", "state", ("window.__myx =", "$.pdpData.mrp"), post="price"),
        R("list_price", "ldjson", ("$.offers.highPrice",), post="price"),
        R("selling_price", "state", ("window.__myx =", "$.pdpData.price.discounted"), post="price"),
        R("selling_price", "ldjson", ("$.offers.price",), post="price"),
        R("selling_price", "field", "list_price"),
        R("discount_percentage", "discount", None),
        R("rating", "state", ("window.__myx =", "$.pdpData.ratings.averageRating"), post="rating"),
        R("num_reviews", "state", ("window.__myx =", "$.pdpData.ratings.totalCount")),
        R("sku", "state", ("window.__myx =", "$.pdpData.id")),
        R("sku", "ldjson", ("$.sku",)),
        R("color", "state", ("window.__myx =", "$.pdpData.baseColour")),
    ],
    "nykaa_fashion_com": [
        *LD_PRODUCT,
        R("product_name", "xpath", "//h1/text()"),
        R("list_price", "script", "mrp", post="price"),
        R("list_price", "field", "selling_price"),
        R("image_url", "ldjson", ("$.image",)),
        R("image_url", "xpath", OG_IMAGE),
    ],
    "shoppersstop_com": [
        R("product_name", "next", NEXT_ITEM + ".name"),
        R("brand", "next", NEXT_ITEM + ".brand_info"),
        R("brand", "next", NEXT_ITEM + ".brand_name"),
        R("sku", "next", NEXT_ITEM + ".sku"),
        R("list_price", "next", NEXT_ITEM + ".price_range.minimum_price.regular_price.value", post="price"),
        R("list_price", "next", NEXT_ITEM + ".variants[0].product.price_range.minimum_price.regular_price.value", post="price"),
        R("selling_price", "next", NEXT_ITEM + ".price_range.minimum_price.final_price.value", post="price"),
        R("selling_price", "field", "list_price"),
        R("rating", "next", NEXT_ITEM + ".rating_summary", post="rating"),
        R("image_url", "next", NEXT_ITEM + ".additional_images[0].url"),
        R("image_url", "next", NEXT_ITEM + ".image.url"),
    ],
    "styleunion_com": [
        R("product_name", "xpath", "//h1[contains(@class,'product__title')]//text()", take="first_text"),
        R("list_price", "xpath",
          "//div[contains(@class,'product__info')]//span[contains(@class,'regular-price')]//text()"
          " | //div[contains(@class,'product__info')]//span[contains(@class,'compare-at-price')]//text()",
          take="first_text", post="price"),
        R("selling_price", "xpath",
          "//div[contains(@class,'product__info')]//span[contains(@class,'sale-price')]//text()"
          " | //div[contains(@class,'product__info')]//span[contains(@class,'price-item--sale')]//text()",
          take="first_text", post="price"),
        R("selling_price", "field", "list_price"),
        R("discount_percentage", "discount", None),
        R("color", "xpath",
          "//input[contains(@id,'main-product-Color') and @checked]/@value"
          " | //fieldset[contains(@id,'Color')]//input[@checked]/@value"),
        R("color", "xpath", "//input[contains(@id,'main-product-Color')]/@value"),
        R("size", "xpath", "//p[contains(@id,'variantSku')]/span//text()"),
        R("description", "xpath",
          "//div[contains(@class,'rte')]//text() | //div[contains(@class,'product__description')]//text()", take="join"),
        R("sku", "xpath", "//input[contains(@name,'sku_id')]/@value"),
    ],
    "xyxx_com": vary(
        GENERIC_COMMERCE,
        R("list_price", "xpath", EXACT_CLASS.format("product__price--compare"), post="price"),
        R("selling_price", "xpath", EXACT_CLASS.format("product__price"), post="price"),
    ),
    "da_milano_com": vary(
        GENERIC_COMMERCE,
        R("list_price", "xpath",
          "//*[contains(@class,'compare') or contains(@class,'was-price')][contains(@class,'price')]//text()", post="price"),
        R("selling_price", "xpath", EXACT_CLASS.format("product__price"), post="price"),
    ),
    "folded_commerce": [
        R("product_name", "xpath", OG_OR_H1, take="join"),
        R("list_price", "xpath",
          FOLDED_CLASS.format("mrp") + " | //span[contains(@class,'list')]/text() | //span[contains(@class,'old')]/text()",
          post="price"),
        R("selling_price", "xpath", FOLDED_CLASS.format("price") + " | //span[contains(@class,'final')]/text()", post="price"),
        R("selling_price", "field", "list_price"),
    ],
    "apollo_media": vary(
        MEDIA_BASE,
        R("article_title", "apollo", "$.title"),
        R("article_title", "xpath", OG_OR_H1),
        R("sub_title", "apollo", "$.dek", post="strip_html"),
        R("sub_title", "apollo", "$.description", post="strip_html"),
        R("sub_title", "xpath", OG_DESCRIPTION),
        R("author_name", "apollo", "$.creator->$.name"),
        R("author_name", "xpath", META_AUTHOR),
        R("post_date", "apollo", "$.insertedAt"),
        R("post_date", "xpath", "//meta[@name='DC.date.issued']/@content | " + PUBLISHED),
        R("article_content", "apollo", "body*$", post="strip_html"),
        R("article_content", "xpath", "//article//p//text()", take="join"),
        R("image_url", "apollo", "imageUrls*$[0]"),
        R("image_url", "xpath", OG_IMAGE),
    ),
    "business_of_fashion": [
        R("article_title", "ldjson", ("$.headline", *ARTICLE_TYPES)),
        R("article_title", "xpath", OG_OR_H1),
        R("sub_title", "ldjson", ("$.description", *ARTICLE_TYPES)),
        R("sub_title", "xpath", OG_DESCRIPTION),
        R("author_name", "ldjson", ("$.author", *ARTICLE_TYPES)),
        R("author_name", "xpath", "//a[contains(@href,'/author/')]/text() | //a[contains(@href,'/authors/')]/text()"),
        R("post_date", "ldjson", ("$.datePublished", *ARTICLE_TYPES)),
        R("post_date", "xpath", "//time/@datetime | //time/text()"),
        R("article_content", "ldjson", ("$.articleBody", *ARTICLE_TYPES), post="long_body"),
        R("article_content", "xpath", "//article//p/text() | //div[contains(@class,'article-body')]//p/text()", take="join"),
        R("image_url", "xpath", OG_IMAGE),
    ],
    "fibre_2_fashion_com": [
        R("article_title", "ldjson", ("$.headline", *ARTICLE_TYPES, "BlogPosting")),
        R("article_title", "xpath", OG_OR_H1, post="title_fibre2fashion"),
        R("sub_title", "xpath", "//div[contains(@class,'panel-body')]//text()", take="join", post="left_500"),
        R("sub_title", "xpath", OG_DESCRIPTION),
        R("author_name", "ldjson", ("$.author", *ARTICLE_TYPES, "BlogPosting")),
        R("author_name", "xpath", META_AUTHOR, post="author_fibre2fashion"),
        R("post_date", "ldjson", ("$.datePublished", *ARTICLE_TYPES, "BlogPosting")),
        R("post_date", "xpath", PUBLISHED + " | //time/@datetime"),
        R("article_content", "xpath", "//div[contains(@class,'articledetails2024')]//p//text()", take="join"),
        R("image_url", "xpath", OG_IMAGE),
    ],
    "the_industry_fashion_com": vary(
        MEDIA_BASE,
        R("article_title", "xpath", "//h1/text()", post="title_theindustry"),
        R("article_title", "xpath", "//meta[contains(@property,'og:title')]/@content", post="title_theindustry"),
        R("article_content", "xpath", "//div[contains(@class,'story-content')]//p//text()", take="join"),
        R("article_content", "xpath",
          "//div[contains(@class,'entry-content')]//p//text() | //div[contains(@class,'post-content')]//p//text()",
          take="join"),
    ),
    "the_fashion_law_com": vary(
        MEDIA_BASE, *H1_THEN_OG, LINKED_AUTHOR, ANY_DATE,
        R("article_content", "xpath", "//div[contains(@class,'post-content')]//p//text() | //article//p//text()", take="join"),
    ),
    "just_style_com": vary(
        MEDIA_BASE, LINKED_AUTHOR, ANY_DATE, ARTICLE_OR_DIV,
        R("article_title", "xpath", "//h1/text() | //meta[contains(@property,'og:title')]/@content", post="title_juststyle"),
    ),
    "drapers_com": vary(
        MEDIA_BASE, LINKED_AUTHOR, ANY_DATE, ARTICLE_OR_DIV, R("article_title", "xpath", OG_OR_H1, take="join"),
    ),
    "apparel_resources_com": vary(
        MEDIA_BASE, ANY_DATE, ARTICLE_OR_DIV, R("article_title", "xpath", OG_OR_H1, take="join"),
        R("author_name", "xpath",
          "//a[@class='author-url']/text() | //span[contains(@class,'author')]//a/text() | " + META_AUTHOR),
    ),
    "wwd_com": vary(MEDIA_BASE, *H1_THEN_OG, R("post_date", "xpath", PUBLISHED)),
    "vogue_in": vary(
        MEDIA_BASE,
        R("article_title", "xpath", "//meta[contains(@property,'title')]/@content"),
        R("sub_title", "xpath", "//meta[contains(@property,'description')]/@content"),
        R("author_name", "xpath", "//meta[contains(@property,'article:author')]/@content"),
        R("post_date", "xpath", PUBLISHED),
        R("article_content", "xpath", "//div[contains(@class,'article__body')]/div/p/text()[1]", take="join"),
    ),
})

SHARED_SETS = {"tata_cliq_com": "folded_commerce", "max_com": "folded_commerce",
               "fashion_united_in": "apollo_media", "fashion_united_global_com": "apollo_media"}


def rule_set_of(project: str, site: str) -> str:
    """The rule set a site uses; sites without a custom set use their project's generic one."""
    name = SHARED_SETS.get(site, site)
    if name in RULE_SETS:
        return name
    return "generic_media" if project.startswith("media") else "generic_commerce"
