"""HTML field columns that need no tree: titles, metas, links, plain text.

They stay in the JVM. Selectors that need real tree structure are in
`pageloom.operators.dom`.
"""

from __future__ import annotations

import re
from functools import cache
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

# The value of a quoted or bare href, with its opening quote, is the only group; hidden blocks are matched so that what is in them is not.
LINK_PATTERN = r"""(?is)<(?:!--.*?--|script\b.*?</script|style\b.*?</style)>|<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*|'[^']*|[^\s"'>]+)"""
REFERENCE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
HIDDEN_PATTERN = r"(?is)<(?:!--.*?--|script\b.*?</script|style\b.*?</style)>"


def _null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


@cache
def _names() -> dict[str, str]:
    """Characters of the named references; a no-break space becomes a space, as everywhere here."""
    return {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}


def _character(reference: Column) -> Column:
    """Character of a reference without its & and ;, or the reference itself if it stands for none."""
    number = F.when(F.startswith(reference, F.lit("#x")) | F.startswith(reference, F.lit("#X")), F.conv(F.substr(reference, F.lit(3)), 16, 10)).when(
        F.startswith(reference, F.lit("#")), F.substr(reference, F.lit(2))).try_cast("bigint")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    coded = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    names = F.create_map(*[F.lit(x) for pair in sorted(_names().items()) for x in pair])
    named = F.when(~F.startswith(reference, F.lit("#")), F.try_element_at(names, reference))
    return F.coalesce(coded, named, F.concat(F.lit("&"), reference, F.lit(";")))


def unescape_html(c: Column) -> Column:
    """Numeric and named character references, each decoded once; texts without an & are left alone."""
    references = F.concat(F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1)), F.array(F.lit("")))
    decoded = F.zip_with(F.split(c, REFERENCE), references, lambda text, ref: F.concat(text, F.when(ref == "", F.lit("")).otherwise(_character(ref))))
    return F.when(F.contains(c, F.lit("&")), F.array_join(decoded, "")).otherwise(c)


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_html(c: Column) -> Column:
    """Tags to spaces, runs of white space to one space."""
    return collapse_space(F.regexp_replace(c, r"<[^>]+>", " "))


def visible_text(c: Column) -> Column:
    return unescape_html(strip_html(F.regexp_replace(c, HIDDEN_PATTERN, " ")))


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first `tag`."""
    body = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return _null_if_blank(unescape_html(strip_html(body)))


def title(html: Column) -> Column:
    return tag_text(html, "title")


def h1(html: Column) -> Column:
    return tag_text(html, "h1")


def _nested(html: Column, tag: str, first: bool) -> Column:
    """Outermost `tag` elements as struct<open, body, close>, in page order (only the first, if that is all that is wanted).

    The page is cut at the tag's own tags; a fold over these counts the depth, so an element ends at the closing tag that belongs to it. Comments, scripts and
    styles count as text. An element that is not closed goes to the end of the page; closing tags without an element are text.
    """
    pattern = rf"(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)>|</?{tag}(?![-\w])[^>]*>"
    tags, texts = F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), F.split(html, pattern)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("start"), none.alias("found"))
    is_own = lambda t: ~F.rlike(t, F.lit(r"(?is)^<(?:!--|script\b|style\b)"))

    def step(s: Column, t: Column) -> Column:
        closes = F.startswith(t, F.lit("</"))
        depth = F.when(~is_own(t), s["depth"]).when(closes, F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"] + 1)
        at = s["at"] + 1
        ends = (s["depth"] == 1) & (depth == 0)
        done = F.array(F.struct(s["start"].alias("start"), at.alias("stop")))
        return F.struct(
            at.alias("at"), depth.alias("depth"), F.when((s["depth"] == 0) & (depth == 1), at).otherwise(s["start"]).alias("start"),
            F.when(ends & (F.size(s["found"]) == 0 if first else F.lit(True)), F.concat(s["found"], done)).otherwise(s["found"]).alias("found"))

    def finish(s: Column) -> Column:
        unclosed = F.array(F.struct(s["start"].alias("start"), F.lit(None).cast("int").alias("stop")))
        return F.when((s["depth"] > 0) & (F.size(s["found"]) == 0 if first else F.lit(True)), F.concat(s["found"], unclosed)).otherwise(s["found"])

    def element(e: Column) -> Column:
        # text number k (from 1) stands before tag number k; an element of tags i to j holds texts i + 1 to j and the tags between
        stop = F.coalesce(e["stop"], F.size(tags) + 1)
        inner = F.zip_with(
            F.slice(texts, e["start"] + 1, stop - e["start"]),
            F.concat(F.slice(tags, e["start"] + 1, F.greatest(stop - e["start"] - 1, F.lit(0))), F.array(F.lit(""))), lambda x, t: F.concat(x, t))
        return F.struct(
            F.element_at(tags, e["start"]).alias("open"), F.array_join(inner, "").alias("body"),
            F.coalesce(F.try_element_at(tags, e["stop"]), F.lit("")).alias("close"))

    # most pages lack most tags, and the fold costs nothing there
    return F.when(F.size(tags) > 0, F.transform(F.aggregate(tags, state, step, finish), element))


def container_text(html: Column, tag: str = "article") -> Column:
    """Visible text inside the first `tag`, with all that is nested in it, text nodes joined by a space."""
    return _null_if_blank(visible_text(F.try_element_at(_nested(html, tag, True), F.lit(1))["body"]))


def meta(html: Column, name: str) -> Column:
    """First non-blank content of a meta tag with this property or name."""
    quoted = re.escape(name)
    pattern = (
        rf"""(?is)<meta\b(?=[^>]*\b(?:property|name)\s*=\s*["']{quoted}["'])"""
        r"""[^>]*?\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    )
    double = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    single = F.regexp_extract_all(html, F.lit(pattern), F.lit(2))
    found = F.transform(
        F.arrays_zip(double.alias("d"), single.alias("s")),
        lambda p: F.trim(unescape_html(F.concat(p["d"], p["s"]))),
    )
    return F.try_element_at(F.filter(found, lambda v: v != ""), F.lit(1))


def text_with_class(html: Column, token: str, mode: str = "contains") -> Column:
    """Leading text of the first element whose class contains, equals or has `token`."""
    quoted = re.escape(token)
    value = {
        "contains": rf"[^\"']*{quoted}[^\"']*",
        "equals": quoted,
        "token": rf"(?:[^\"']*\s)?{quoted}(?:\s[^\"']*)?",
        "folded": rf"(?i:[^\"']*{quoted}[^\"']*)",
    }[mode]
    pattern = rf"""(?s)<[A-Za-z][^>]*?\sclass\s*=\s*["']{value}["'][^>]*>([^<]*)"""
    return _null_if_blank(F.trim(unescape_html(F.regexp_extract(html, pattern, 1))))


def label_sibling(html: Column, label: str, label_tag: str = "th", value_tag: str = "td") -> Column:
    """Value cell that follows a label cell."""
    pattern = (
        rf"(?is)<{label_tag}\b[^>]*>[^<]*{re.escape(label)}[^<]*</{label_tag}>\s*"
        rf"<{value_tag}\b[^>]*>(.*?)</{value_tag}>"
    )
    return _null_if_blank(unescape_html(strip_html(F.regexp_extract(html, pattern, 1))))


def script_value(html: Column, key: str) -> Column:
    """Number after `"key":`, `key=` or `key(` in an inline script."""
    pattern = rf"""["']?\b{re.escape(key)}["']?\s*[:=(]\s*["']?([0-9][0-9.]*)"""
    return _null_if_blank(F.regexp_extract(html, pattern, 1))


def hrefs(html: Column) -> Column:
    """All `a/@href` values in page order, quoted or bare; none of comments, scripts and styles."""
    found = F.filter(F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(1)), lambda v: v != "")
    plain = F.transform(found, lambda v: F.when(F.startswith(v, F.lit('"')) | F.startswith(v, F.lit("'")), F.substring(v, 2, 1 << 30)).otherwise(v))
    # references are rare in links, so most pages' links are not looked through for them
    return F.when(F.exists(plain, lambda v: F.contains(v, F.lit("&"))), F.transform(plain, unescape_html)).otherwise(plain)


# Elements that cannot stand in an element of their own kind.
FLAT = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "a", "button", "option", "title")


def sections(html: Column, tag: str = "p") -> Column:
    """The outermost `tag` elements, each with all that is nested in it, as HTML. An element that cannot nest ends at the first closing tag."""
    if tag.lower() in FLAT:
        return F.regexp_extract_all(html, F.lit(rf"(?is)(<{tag}\b[^>]*>.*?</{tag}>)"), F.lit(1))
    parts = F.transform(_nested(html, tag, False), lambda e: F.concat(e["open"], e["body"], e["close"]))
    return F.coalesce(parts, F.array().cast("array<string>"))


def sitemap_locs(xml: Column) -> Column:
    found = F.regexp_extract_all(xml, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    return F.transform(found, unescape_html)
