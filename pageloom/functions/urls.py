"""URL columns: splitting, resolving, canonical forms and link filters.

The parts follow the generic URI grammar (RFC 3986, appendix B), so an odd
character in a path yields a value where a strict parser would yield NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

PART_PATTERNS = {
    "scheme": r"^([A-Za-z][A-Za-z0-9+.\-]*):",
    "host": r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)",
    "path": r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)",
    "query": r"^[^?#]*\?([^#]*)",
    "fragment": r"^[^#]*#(.*)$",
}

# Link rules of the supported sites.
SHAPE_PATTERNS = {
    "dash_p_id": r"-p\d+/*$",
    "numeric_second": r"^/*[^/]+/+\d+/+[^/]+",
    "digit_tail": r"^/*[^/]+/+(?:[^/]+/+)*[^/]*\d/*$",
    "product_path": r"/dp/|/gp/product/",
    "ends_buy": r"/buy/*$",
}
SKIP_SEGMENTS = [
    "page", "tag", "author", "category", "search", "feed",
    "topic", "video", "gallery", "photo", "quiz", "newsletter",
]
PRODUCT_PATTERNS = ["/p/", "/product/", "/products/"]
FASHION_KEYWORDS = [
    "fashion", "style", "wear", "outfit", "cloth", "apparel", "dress",
    "ethnic", "saree", "kurta", "kurti", "lehenga", "boutique", "designer",
    "footwear", "bridal", "couture", "sneaker", "jewellery", "jewelry",
    "handbag", "denim",
]


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def url_part(c: Column, part: str) -> Column:
    """One of scheme, host, path, query, fragment; NULL when absent or empty."""
    return _blank_to_null(F.regexp_extract(c, PART_PATTERNS[part], 1))


def url_parts(c: Column) -> Column:
    return F.struct(*[url_part(c, p).alias(p) for p in PART_PATTERNS])


def split_url_key(key: Column) -> Column:
    """`<url>|{'rank': N}` to a struct of url and rank."""
    rank = F.regexp_extract(key, r"\|.*rank'?\D+(\d+)", 1)
    return F.struct(
        F.substring_index(key, "|", 1).alias("url"),
        rank.try_cast("int").alias("rank"),
    )


def make_url_key(url: Column, rank: Column) -> Column:
    return F.concat(url, F.lit("|{'rank': "), rank.cast("string"), F.lit("}"))


def domain(c: Column) -> Column:
    """Host without a leading `www.`."""
    return F.regexp_replace(url_part(c, "host"), r"^www\.", "")


def origin(c: Column) -> Column:
    return F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def remove_dots(path: Column) -> Column:
    """Remove `.` and `..` segments; `..` above the root is dropped."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(kept, "/"), tail)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), joined).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """RFC 3986 reference resolution as one column expression."""
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    base_path = F.regexp_extract(base, PART_PATTERNS["path"], 1)
    folder = F.coalesce(_blank_to_null(F.regexp_extract(base_path, r"^(.*/)", 1)), F.lit("/"))
    no_fragment = F.substring_index(base, "#", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(url_part(base, "scheme"), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin(base), remove_dots(href_path), href_rest))
        .when(href.startswith("?"), F.concat(origin(base), base_path, href))
        .when(href.startswith("#"), F.concat(no_fragment, href))
        .otherwise(F.concat(origin(base), remove_dots(F.concat(folder, href_path)), href_rest))
    )


def canonical_url(c: Column, kind: str = "strip", host: str = r"[^/]+") -> Column:
    """`strip` drops query and fragment; `product` keeps up to `/dp/<10 characters>/`."""
    stripped = F.regexp_extract(c, r"^([^?#]*)", 1)
    if kind == "strip":
        return stripped
    if kind == "product":
        found = F.regexp_extract(c, rf"(https?://{host}(?:/[^/]+)?/dp/[A-Z0-9]{{10}})", 1)
        return F.when(found != "", F.concat(found, F.lit("/"))).otherwise(stripped)
    raise ValueError(f"unknown kind {kind!r}")


def drop_tracking(c: Column, keep: Sequence[str]) -> Column:
    """Keep only the listed query parameters, in their order; the fragment goes."""
    pairs = F.filter(
        F.split(F.coalesce(url_part(c, "query"), F.lit("")), "&"),
        lambda kv: F.substring_index(kv, "=", 1).isin(list(keep)) & (kv != ""),
    )
    query = F.array_join(pairs, "&")
    stripped = canonical_url(c)
    return F.when(query == "", stripped).otherwise(F.concat(stripped, F.lit("?"), query))


def product_code(c: Column, marker: str = "p") -> Column:
    """Path segment after the first `marker` segment."""
    parts = F.split(F.regexp_replace(c, r"/+$", ""), "/")
    at = F.array_position(parts, marker)
    return F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int")))


def category_code(c: Column, marker: str = "c") -> Column:
    """Numeric segment after `marker`, else the last segment; NULL unless all digits."""
    parts = F.split(F.regexp_replace(c, r"/+$", ""), "/")
    at = F.array_position(parts, marker)
    code = F.coalesce(F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int"))), F.element_at(parts, -1))
    return F.when(code.rlike(r"^\d+$"), code)


def trailing_id(c: Column) -> Column:
    """The digits of a path that ends in `-<digits>`."""
    return _blank_to_null(F.regexp_extract(F.substring_index(c, "?", 1), r"-(\d+)/?$", 1))


def page_number(c: Column, param: str = "page") -> Column:
    found = F.regexp_extract(F.coalesce(url_part(c, "query"), F.lit("")), rf"{param}=(\d+)", 1)
    return F.coalesce(found.try_cast("int"), F.lit(1))


def on_domain(c: Column, name: str | Column, where: str = "host") -> Column:
    """Site name contained in the host, or anywhere in the URL."""
    needle = name if isinstance(name, Column) else F.lit(name)
    text = F.coalesce(url_part(c, "host"), F.lit("")) if where == "host" else c
    return F.contains(text, needle)


def has_any(c: Column, patterns: Sequence[str]) -> Column:
    result = F.lit(False)
    for p in patterns:
        result = result | F.contains(c, F.lit(p))
    return result


def has_keyword(c: Column, words: Sequence[str] = FASHION_KEYWORDS) -> Column:
    return has_any(F.lower(c), words)


def path_segments(c: Column) -> Column:
    return F.filter(F.split(F.coalesce(url_part(c, "path"), F.lit("")), "/"), lambda s: s != "")


def not_section(c: Column, stop: Sequence[str] = SKIP_SEGMENTS, min_parts: int = 2) -> Column:
    """At least `min_parts` path segments, the first not in the stop list."""
    parts = path_segments(c)
    first = F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))
    return (F.size(parts) >= min_parts) & ~first.isin(list(stop))


def shape(c: Column, rule: str) -> Column:
    """Test the lower-cased path against a named shape."""
    return F.lower(F.coalesce(url_part(c, "path"), F.lit(""))).rlike(SHAPE_PATTERNS[rule])


def slugify(c: Column, kind: str = "dash") -> Column:
    if kind == "dash":
        return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    if kind == "words":
        kept = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^a-zA-Z0-9\s-]", "")
        slug = F.lower(F.regexp_replace(F.trim(kept), r"\s+", "-"))
        return F.when(slug == "", F.lit("article")).otherwise(slug)
    raise ValueError(f"unknown kind {kind!r}")


def item_url(base: Column, slug: Column, sku: Column, uid: Column) -> Column:
    """`base/slug/p/sku`, or `base/slug/uid` without a SKU."""
    has_sku = sku.isNotNull() & (sku != "")
    return F.when(has_sku, F.concat_ws("/", base, slug, F.lit("p"), sku)).otherwise(F.concat_ws("/", base, slug, uid))


def article_url(base: Column, category: Column, subcategory: Column, title: Column, uid: Column) -> Column:
    slugs = [
        slugify(F.coalesce(_blank_to_null(category), F.lit("centrestage")), "words"),
        slugify(F.coalesce(_blank_to_null(subcategory), F.lit("features")), "words"),
        F.concat(slugify(title, "words"), F.lit("-"), uid.cast("string")),
    ]
    return F.concat_ws("/", base, *slugs)


def url_hash(c: Column) -> Column:
    return F.md5(F.encode(c, "UTF-8"))


def valid_name(c: Column) -> Column:
    return c.rlike(r"^[a-zA-Z0-9_-]+$")


def hash_shard(c: Column, n: int) -> Column:
    """The 128-bit md5 of a name modulo n, word by word so that nothing overflows."""
    if not 0 < n <= 1 << 30:
        raise ValueError("n must be between 1 and 2**30")
    digest = F.md5(F.encode(c, "UTF-8"))
    rest = F.lit(0).cast("bigint")
    for at in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(1 << 32) + word) % F.lit(n)
    return rest.cast("int")


def uniq_id(url: Column, rank: Column | None = None, compat: bool = False) -> Column:
    """md5 of the url; the compat form hashes the whole url key, rank included."""
    if compat:
        if rank is None:
            raise ValueError("the compat form needs the rank")
        return url_hash(make_url_key(url, rank))
    return url_hash(url)
