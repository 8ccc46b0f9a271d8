"""Page-list generators: one seed row to N listing-page rows.

Every generator is an array column, so expansion is a local `explode` with no
shuffle. Bounds are guarded because `sequence` counts down when stop < start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.functions.urls import trailing_id, url_part

_SLOT = "\x01"


def _numbers(start: int | Column, stop: int | Column) -> Column:
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = stop if isinstance(stop, Column) else F.lit(stop)
    lo, hi = lo.cast("int"), hi.cast("int")
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def _fill(template: Column, numbers: Column) -> Column:
    return F.transform(numbers, lambda i: F.replace(template, F.lit(_SLOT), i.cast("string")))


def _encode(c: Column) -> Column:
    # form encoding differs from the standard library's in two characters
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), c)


def _query_template(c: Column, param: str) -> Column:
    """The URL with `param` set to a slot; blank values go, a repeated name keeps its first value."""
    pairs = F.filter(
        F.split(F.coalesce(url_part(c, "query"), F.lit("")), "&"),
        lambda kv: kv.rlike("^[^=]+=."),
    )
    keys = F.array_distinct(F.transform(pairs, lambda kv: _decode(F.substring_index(kv, "=", 1))))
    keys = F.when(F.array_contains(keys, param), keys).otherwise(F.concat(keys, F.array(F.lit(param))))

    def render(k: Column) -> Column:
        mine = F.filter(pairs, lambda kv: _decode(F.substring_index(kv, "=", 1)) == k)
        value = F.regexp_replace(F.coalesce(F.try_element_at(mine, F.lit(1)), F.lit("")), "^[^=]*=", "")
        shown = F.when(k == param, F.lit(_SLOT)).otherwise(_encode(_decode(value)))
        return F.concat(_encode(k), F.lit("="), shown)

    fragment = F.regexp_extract(c, r"^[^#]*(#.*)$", 1)
    head = F.regexp_extract(c, r"^([^?#]*)", 1)
    return F.concat(head, F.lit("?"), F.array_join(F.transform(keys, render), "&"), fragment)


def querystring_pages(c: Column, param: str = "page", start: int = 1, count: int = 10) -> Column:
    return _fill(_query_template(c, param), _numbers(start, start + count - 1))


def shopify_pages(c: Column, count: int = 10) -> Column:
    return querystring_pages(c, "page", 1, count)


def _base(c: Column) -> Column:
    return F.regexp_replace(c, "/+$", "")


def wordpress_pages(c: Column, count: int = 10) -> Column:
    return _fill(F.concat(_base(c), F.lit(f"/page/{_SLOT}/")), _numbers(2, count + 1))


def path_number_pages(c: Column, count: int = 10) -> Column:
    return _fill(F.concat(_base(c), F.lit(f"/{_SLOT}/")), _numbers(1, count))


def append_pages(c: Column, param: str = "page", start: int = 2, count: int | Column = 10) -> Column:
    """Plain append: `&` when the URL already has a `?`."""
    joiner = F.when(F.contains(c, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return _fill(F.concat(c, joiner, F.lit(f"{param}={_SLOT}")), _numbers(start, start + count - 1))


def counted_pages(c: Column, items: Column, per_page: int = 12) -> Column:
    """ceil(items / per_page) pages numbered 1..n-1; the seed alone when there is one page."""
    n = F.ceil(items / F.lit(per_page)).cast("int")
    pages = _fill(F.concat(c, F.lit(f"?page={_SLOT}")), _numbers(1, n - 1))
    return F.when(n > 1, pages).otherwise(F.array(c))


def _bound(n: int | Column) -> Column:
    """A bound of a page list: a number, or a column with one for each row (from the site's row, or what a page says)."""
    return F.lit(n) if isinstance(n, int) else n.cast("int")


def labelled_pages(c: Column, labels: Column, unlabelled: int | Column, cap: int | Column | None = None) -> Column:
    """Pages 2..largest numeric label, or 2..cap if a site's row gives a lower one; 2..`unlabelled` without a numeric label."""
    nums = F.filter(F.transform(labels, lambda s: F.trim(s).try_cast("int")), lambda n: n.isNotNull())
    last = F.coalesce(F.array_max(nums), _bound(unlabelled))
    last = last if cap is None else F.least(last, _bound(cap))
    return _fill(F.concat(c, F.lit(f"&page={_SLOT}")), _numbers(2, last))


def next_pages(c: Column, next_link: Column, ahead: int | Column, cap: int | Column | None = None) -> Column:
    """The next link alone; else `ahead` pages on from `page=c`; else the first `ahead` pages from 2 on. A site's row may give a cap."""
    here = F.regexp_extract(c, r"[?&]page=(\d+)", 1).try_cast("int")
    first = F.regexp_extract(c, r"^(.*?[?&]page=)\d+", 1)
    rest = F.regexp_extract(c, r"^.*?[?&]page=\d+(.*)$", 1)
    onward = _fill(F.concat(first, F.lit(_SLOT), rest), _numbers(here + 1, here + _bound(ahead)))
    urls = (
        F.when(next_link.isNotNull(), F.array(next_link))
        .when(here.isNotNull(), onward)
        .otherwise(append_pages(c, "page", 2, _bound(ahead)))
    )
    return urls if cap is None else F.slice(urls, F.lit(1), _bound(cap))


def api_pages(api_base: str, code: Column, pages: int | Column, size: int = 45) -> Column:
    """Zero-based listing API pages of a category; `pages` is what the first page's payload says (`total_pages`). Unknown: the first page alone."""
    template = F.concat(
        F.lit(f"{api_base}?fields=SITE&currentPage={_SLOT}&pageSize={size}&format=json&query=%3Arelevance&fnl="),
        code,
    )
    return F.when(code.isNotNull(), _fill(template, _numbers(0, F.greatest(F.coalesce(_bound(pages), F.lit(1)), F.lit(1)) - 1)))


def total_pages(payload: Column) -> Column:
    """Number of listing pages that a listing payload names."""
    return F.get_json_object(payload, "$.pagination.totalNumberOfPages").try_cast("int")


def sitemap_shards(c: Column, shards: int | Column) -> Column:
    """The seed, then its numbered sitemap files."""
    root = F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    return F.concat(F.array(c), _fill(F.concat(root, F.lit(f"/sitemap/discovery/{_SLOT}.xml")), _numbers(0, _bound(shards) - 1)))


def category_pages(c: Column, last: int | Column, first: int = 2) -> Column:
    """The seed, then `?page=n` when its path ends in an id."""
    more = _fill(F.concat(c, F.lit(f"?page={_SLOT}")), _numbers(first, _bound(last)))
    return F.when(trailing_id(c).isNull(), F.array(c)).otherwise(F.concat(F.array(c), more))


GENERATORS = {
    "wordpress": wordpress_pages,
    "querystring": querystring_pages,
    "shopify": shopify_pages,
    "path_number": path_number_pages,
    "append": append_pages,
    "counted": counted_pages,
    "labelled": labelled_pages,
    "next": next_pages,
    "api": api_pages,
    "sitemap": sitemap_shards,
    "category": category_pages,
}


def paginate(df: DataFrame, column: str, kind: str, with_seed: bool = False, **options) -> DataFrame:
    """Add `page_pos` (1-based) and `page_url`, one row for each listing page."""
    urls = GENERATORS[kind](F.col(column), **options)
    if with_seed:
        urls = F.concat(F.array(F.col(column)), urls)
    return df.select("*", F.posexplode(urls).alias("page_pos", "page_url")).withColumn("page_pos", F.col("page_pos") + 1)
