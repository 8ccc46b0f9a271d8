"""JSON carried inside pages: schema.org blocks, framework state, entity caches.

A page's JSON is parsed once into a VARIANT and the fields are projected from
it. Only two steps are beyond SQL and use an Arrow function: slicing a balanced
bracket pair, and searching a tree for a key.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_LD = r"""(?is)<script\b[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""
_NEXT = r"""(?is)<script\b[^>]*id\s*=\s*["']__NEXT_DATA__["'][^>]*>(.*?)</script>"""


def ld_blocks(html: Column) -> Column:
    """All schema.org objects of a page in order; list blocks are flattened, bad JSON skipped."""
    bodies = F.regexp_extract_all(html, F.lit(_LD), F.lit(1))
    parsed = F.filter(F.transform(bodies, lambda b: F.try_parse_json(F.trim(b))), lambda v: v.isNotNull())
    return F.flatten(
        F.transform(parsed, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)))
    )


def ld_json(html: Column, types: Sequence[str] = ("Product", "product")) -> Column:
    """The first object of a wanted type, as VARIANT."""
    wanted = F.filter(ld_blocks(html), lambda v: F.try_variant_get(v, '$["@type"]', "string").isin(list(types)))
    return F.try_element_at(wanted, F.lit(1))


def ld_broken(html: Column) -> Column:
    """Whether a page has a schema.org block that is not JSON."""
    return F.exists(F.regexp_extract_all(html, F.lit(_LD), F.lit(1)), lambda b: F.try_parse_json(F.trim(b)).isNull())


def field(v: Column, path: str, as_type: str = "string") -> Column:
    return F.try_variant_get(v, path, as_type)


def name_or_text(v: Column, path: str) -> Column:
    """A value that is an object with a name, or plain text."""
    return F.coalesce(field(v, f"{path}.name"), F.when(~_is_container(v, path), field(v, path)))


def _is_container(v: Column, path: str) -> Column:
    return F.coalesce(
        F.try_variant_get(v, path, "map<string,variant>").isNotNull()
        | F.try_variant_get(v, path, "array<variant>").isNotNull(),
        F.lit(False),
    )


def next_json(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, _NEXT, 1), F.lit(""))


def next_data(html: Column, path: str, as_type: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json(next_json(html)), path, as_type)


def apollo_cache(html: Column) -> Column:
    """The entity cache as a map in document order."""
    state = F.get_json_object(next_json(html), "$.props.pageProps.apolloState")
    return F.from_json(state, "map<string,variant>")


def apollo_entity(cache: Column, typename: str) -> Column:
    """The first cache entry of a type."""
    entries = F.filter(
        F.map_entries(cache), lambda e: F.try_variant_get(e["value"], "$.__typename", "string") == typename
    )
    return F.try_element_at(entries, F.lit(1))["value"]


def apollo_ref(cache: Column, entity: Column, path: str) -> Column:
    """Follow `path.__ref` inside the same cache."""
    return F.try_element_at(cache, F.try_variant_get(entity, f"{path}.__ref", "string"))


def by_prefix(entity: Column, prefix: str) -> Column:
    """The value of the first key with a prefix."""
    entries = F.map_entries(F.try_variant_get(entity, "$", "map<string,variant>"))
    return F.try_element_at(F.filter(entries, lambda e: F.startswith(e["key"], F.lit(prefix))), F.lit(1))["value"]


_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]]', re.S)


def balanced(text: str | None) -> str | None:
    """The leading bracketed value of `text`; brackets inside strings do not count."""
    if not text:
        return None
    depth, start = 0, None
    for m in _TOKEN.finditer(text):
        token = m.group()
        if token in ("{", "["):
            start = m.start() if start is None else start
            depth += 1
        elif token in ("}", "]"):
            depth -= 1
            if depth == 0 and start is not None:
                return text[start : m.end()]
    return None


@F.pandas_udf(T.StringType())
def _balanced_udf(s: pd.Series) -> pd.Series:
    return s.map(balanced)


def embedded_state(html: Column, marker: str) -> Column:
    """JSON text of the `{}` or `[]` value after a marker. Pages without the marker are not sent to Python."""
    at = F.instr(html, marker)
    rest = F.when(at > 0, F.substr(html, at + F.lit(len(marker))))
    return _balanced_udf(rest)


def _find_list(root, key: str, limit: int | None):
    """Depth first, a node's own list before those of its children; no recursion, so any depth that parses is searched."""
    todo = [(root, 0)]
    while todo:
        node, depth = todo.pop()
        if isinstance(node, dict):
            hit = node.get(key)
            if isinstance(hit, list) and hit:
                return hit
        children = list(node.values() if isinstance(node, dict) else node)
        if limit is None or depth < limit:
            todo.extend((c, depth + 1) for c in reversed(children) if isinstance(c, (dict, list)))
    return None


def find_list(json_text: Column, key: str = "products", max_depth: int | None = None) -> Column:
    """The first non-empty list under `key` anywhere in a JSON text (down to `max_depth`, if given), as JSON text."""

    def search(text: str | None) -> str | None:
        if not text or f'"{key}"' not in text:
            return None
        try:
            hit = _find_list(json.loads(text), key, max_depth)
        except (ValueError, TypeError, RecursionError):
            return None
        return json.dumps(hit, ensure_ascii=False) if hit else None

    @F.pandas_udf(T.StringType())
    def search_udf(s: pd.Series) -> pd.Series:
        return s.map(search)

    return search_udf(F.when(F.contains(json_text, F.lit(f'"{key}"')), json_text))
