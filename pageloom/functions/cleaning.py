"""Cleaning and derivation of record fields: prices, ratings, names, dates, lists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PRICE = "decimal(12,2)"
# The accepted crawl_timestamp formats, in order of trial.
TIMESTAMP_FORMATS = [
    "MMM dd, yyyy '@' HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
]
PLACEHOLDERS = ["Make a size selection", "Make a colour selection", "loading..."]
GENDER_IN_CATEGORY = [("women|girl", "Women"), ("men|boy", "Men"), ("kid|child", "Kids")]
GENDER_IN_NAME = [("women", "Women"), ("men", "Men"), ("kids", "Kids"), ("girls", "Women"), ("boys", "Men")]
CURRENCY_PRICE = r"(?:₹|Rs\.?)\s*([0-9][0-9,]*(?:\.[0-9]+)?)"


def _null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _number(text: Column, as_type: str = PRICE) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast(as_type)


def parse_price(c: Column) -> Column:
    """First number, thousands commas and decimals understood."""
    return _number(F.regexp_extract(c, r"([0-9][0-9,]*(?:\.[0-9]+)?)", 1))


def parse_price_digits(c: Column) -> Column:
    """Compat form: all digits of the text, decimals run together."""
    return F.regexp_replace(c, r"[^0-9]", "").try_cast("bigint")


def price_pair(c: Column) -> Column:
    """(sell, list): the lower and higher of the first two currency prices; one price is the sell price."""
    found = F.transform(F.regexp_extract_all(c, F.lit(CURRENCY_PRICE), F.lit(1)), lambda p: _number(p))
    two = F.slice(found, 1, 2)
    return F.struct(
        F.array_min(two).alias("sell"),
        F.when(F.size(two) > 1, F.array_max(two)).alias("list"),
    )


def list_price_from_text(c: Column, sell: Column, max_len: int = 30) -> Column:
    """List price in a run-together text like `62%999₹378`: 3+ digits, a separator, later the sell price."""
    text = F.trim(c)
    pattern = r"(?s)([0-9]{3,})[^0-9]+(.*)$"
    found = F.regexp_extract(text, pattern, 1).try_cast("bigint")
    rest = F.regexp_extract(text, pattern, 2)
    sell_text = sell.cast("bigint").cast("string")
    return F.when((F.length(text) <= max_len) & F.contains(rest, sell_text) & (found > sell), found)


def with_price_fallbacks(df: DataFrame, list_col: str = "list_price", sell_col: str = "selling_price",
                         variant_col: str | None = None) -> DataFrame:
    """list from the first variant with a price, then list from sell and sell from list."""
    list_price = F.col(list_col)
    if variant_col:
        priced = F.filter(F.col(variant_col), lambda v: v.isNotNull() & (v > 0))
        list_price = F.coalesce(list_price, F.try_element_at(priced, F.lit(1)))
    full_list = F.coalesce(list_price, F.col(sell_col))
    full_sell = F.coalesce(F.col(sell_col), list_price)
    return df.withColumns({list_col: full_list, sell_col: full_sell})


def discount_pct(list_price: Column, sell: Column, default: int | None = None) -> Column:
    """Half-to-even whole percent when list > sell, else the site's default."""
    lp, sp = list_price.cast("double"), sell.cast("double")
    pct = F.bround((lp - sp) / F.nullif(lp, F.lit(0.0)) * 100, 0).cast("int")
    return F.when((lp > sp) & (sp > 0), pct).otherwise(F.lit(default).cast("int"))


def percent_from_text(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]+)\s*%", 1).try_cast("int")


def parse_rating(c: Column) -> Column:
    """First number of the text to one decimal."""
    return F.bround(F.regexp_extract(c, r"([0-9]+(?:\.[0-9]+)?)", 1).try_cast("double"), 1)


def parse_count(c: Column) -> Column:
    """First whole number, NULL unless positive."""
    n = _number(F.regexp_extract(c, r"([0-9][0-9,]*)", 1), "bigint")
    return F.when(n > 0, n)


def availability(code: Column) -> Column:
    """Stock code or schema.org URL to in_stock / out_of_stock."""
    return F.when(F.coalesce(code, F.lit("")) == "", F.lit(None).cast("string")).when(
        (F.lower(code) == "instock") | F.contains(code, F.lit("InStock")), "in_stock"
    ).otherwise("out_of_stock")


def _gender_of(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    result = F.lit(None).cast("string")
    for pattern, value in reversed(rules):
        result = F.when(text.rlike(pattern), value).otherwise(result)
    return result


def gender(categories: Column, name: Column) -> Column:
    """First category that names a gender, else the product name; women are tested before men."""
    hits = F.filter(
        F.transform(categories, lambda s: _gender_of(F.lower(s), GENDER_IN_CATEGORY)), lambda g: g.isNotNull()
    )
    return F.coalesce(F.try_element_at(hits, F.lit(1)), _gender_of(F.lower(name), GENDER_IN_NAME))


def category(categories: Column) -> Column:
    return _null_if_blank(F.try_element_at(categories, F.lit(1)))


def sub_category(categories: Column) -> Column:
    return F.when(F.size(categories) >= 2, _null_if_blank(F.try_element_at(categories, F.lit(-1))))


def available_sizes(variants: Column) -> Column:
    """Labels of variants {label, stock} that are not out of stock."""
    kept = F.filter(variants, lambda v: (F.coalesce(v["stock"], F.lit("")) != "outOfStock") & (v["label"] != ""))
    return F.transform(kept, lambda v: v["label"])


def joined(arr: Column, sep: str = ", ") -> Column:
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def sizes_count(arr: Column) -> Column:
    return F.coalesce(F.greatest(F.size(arr), F.lit(0)), F.lit(0))


def material(features: Column) -> Column:
    """Value of the first feature {name, value} about fabric, material or composition."""
    hits = F.filter(
        features,
        lambda f: F.lower(f["name"]).rlike("fabric|material|composition") & f["value"].isNotNull(),
    )
    return _null_if_blank(F.try_element_at(hits, F.lit(1))["value"])


def images(urls: Column, base: str, cap: int | None = None) -> Column:
    """Non-blank image URLs made absolute; the first `cap` of them where a site's rule gives one."""
    absolute = F.transform(
        F.filter(urls, lambda u: F.coalesce(u, F.lit("")) != ""),
        lambda u: F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u))
        .when(~F.startswith(u, F.lit("http")), F.concat(F.lit(base), u))
        .otherwise(u),
    )
    return absolute if cap is None else F.slice(absolute, 1, cap)


def primary_image(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def color_from_text(c: Column) -> Column:
    return _null_if_blank(F.trim(F.regexp_extract(c, r"(?i)color\s*:\s*([^,]+)", 1)))


def clean_brand(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(c), "^Visit the ", ""), "^Brand: ", "")


def clean_title(c: Column, suffix: str) -> Column:
    """Drop a trailing ` - Site` or ` | Site`."""
    return F.trim(F.regexp_replace(c, rf"(?i)\s*[-|]\s*{re.escape(suffix)}\s*$", ""))


def title_case(c: Column) -> Column:
    return F.initcap(c)


def authors(v: Column, site_domain: str | None = None) -> Column:
    """Author names from VARIANT text, object or list of objects; a bare site name is no author."""
    as_list = F.try_variant_get(v, "$", "array<variant>")
    as_map = F.try_variant_get(v, "$", "map<string,variant>")
    listed = F.array_join(
        F.filter(
            F.transform(as_list, lambda a: F.try_variant_get(a, "$.name", "string")),
            lambda n: F.coalesce(n, F.lit("")) != "",
        ),
        ", ",
    )
    text = (
        F.when(as_list.isNotNull(), listed)
        .when(as_map.isNotNull(), F.try_variant_get(v, "$.name", "string"))
        .otherwise(F.try_variant_get(v, "$", "string"))
    )
    text = _null_if_blank(F.trim(text))
    return F.when(~F.contains(text, F.lit(site_domain)), text) if site_domain else text


def truncate_text(c: Column, n: int = 300, mark: str = "…") -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(mark))).otherwise(c)


def placeholder_to_null(c: Column, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    return F.when(~F.trim(c).isin(list(placeholders)), c)


def join_nonempty(arr: Column, sep: str = " ") -> Column:
    """Trimmed non-blank items joined; NULL when none is left."""
    kept = F.filter(F.transform(arr, lambda s: F.trim(s)), lambda s: s != "")
    return F.when(F.size(kept) > 0, F.array_join(kept, sep))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[_null_if_blank(F.trim(c)) for c in cols])


def parse_timestamp(c: Column) -> Column:
    """First of five formats that fits, as a zone-less timestamp."""
    text = F.trim(c)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in TIMESTAMP_FORMATS]
    return F.coalesce(*tries)


def parse_timestamp_multi(c: Column) -> Column:
    """ISO text with milliseconds and a `Z`; NULL when no format fits."""
    return F.date_format(parse_timestamp(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def crawl_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "MMM dd, yyyy @ HH:mm:ss.SSS")


def format_time(c: Column) -> Column:
    """ISO text for display; blank shows as a dash, other text as it is."""
    parsed = F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("—")).otherwise(F.coalesce(parsed, c))


def drop_empty(df: DataFrame) -> DataFrame:
    """'' to NULL in every text column."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({n: _null_if_blank(F.col(n)) for n in text})


def index_name(project: Column, prefix: str = "") -> Column:
    return F.lower(F.replace(F.concat(F.lit(prefix), project), F.lit("_"), F.lit("-")))


def rule_set_key(site: Column, project: Column) -> Column:
    """`my_site` + `my_project` to `MySiteMyProject`."""
    parts = F.split(F.concat_ws("_", site, project), "_")
    return F.array_join(F.transform(parts, lambda s: F.concat(F.upper(F.left(s, F.lit(1))), F.substr(s, F.lit(2)))), "")


def search_text(df: DataFrame, cols: Sequence[str], query: str) -> DataFrame:
    """Rows whose listed columns contain the query, case folded."""
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in cols]))
    return df.filter(F.contains(text, F.lit(query.lower())))
