"""A page as a flat list of nodes in document order, with a small path-selector subset.

Used inside an Arrow function by `pageloom.operators.extraction`, one parse per
page for all rules. Selectors: `//a`, `/a`, `*`, `@x`, `text()`, unions with `|`
(in document order), `following-sibling::`, and predicates on attributes, text,
child elements and position.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from functools import lru_cache
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
}
# an opening tag closes an open element of these names, up to the scope element
IMPLIED = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    **{tag: ({"p"}, {"table", "td", "li", "div", "article", "section"}) for tag in BLOCK},
}


class Node:
    __slots__ = ("i", "end", "parent", "tag", "attrs", "text")

    def __init__(self, i, parent, tag=None, attrs=None, text=None):
        self.i, self.end, self.parent, self.tag, self.attrs, self.text = i, i, parent, tag, attrs, text


class Page(HTMLParser):
    """Never raises on broken HTML; unclosed elements end with their parent."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        root = Node(0, None, "#root", {})
        self.nodes, self.open, self.by_tag = [root], [root], defaultdict(list)
        self.feed(html)
        self.close()
        self._close_down_to(0)

    def _close_down_to(self, depth: int) -> None:
        last = len(self.nodes) - 1
        while len(self.open) > depth:
            self.open.pop().end = last

    def _add(self, **kw) -> Node:
        node = Node(len(self.nodes), self.open[-1], **kw)
        self.nodes.append(node)
        return node

    def handle_starttag(self, tag, attrs):
        closes, scope = IMPLIED.get(tag, ((), ()))
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].tag
            if name in closes:
                self._close_down_to(depth)
                break
            if name in scope:
                break
        node = self._add(tag=tag, attrs={k: v or "" for k, v in attrs})
        self.by_tag[tag].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self._close_down_to(depth)
                break

    def handle_data(self, data):
        self._add(text=data)

    def within(self, node: Node, test: str) -> list[Node]:
        """Descendants that pass a node test."""
        if test in ("*", "text()"):
            want_text = test == "text()"
            return [n for n in self.nodes[node.i + 1 : node.end + 1] if (n.tag is None) == want_text]
        same = self.by_tag.get(test, [])
        at = [n.i for n in same] if node.i else None
        return same if at is None else same[bisect_right(at, node.i) : bisect_right(at, node.end)]

    def children(self, node: Node, test: str) -> list[Node]:
        return [n for n in self.within(node, test) if n.parent is node]

    def siblings_after(self, node: Node, test: str) -> list[Node]:
        return [n for n in self.within(node.parent, test) if n.parent is node.parent and n.i > node.end]

    def string(self, node: Node) -> str:
        return "".join(n.text for n in self.nodes[node.i : node.end + 1] if n.tag is None)

    def select(self, path: str) -> list[str]:
        """String values in document order: text, attribute value, or all text of an element."""
        hits: dict[int, str] = {}
        for steps in compile_path(path):
            for node, value in self._walk(steps):
                hits.setdefault(node.i, value)
        return [hits[i] for i in sorted(hits)]

    def _walk(self, steps):
        current = [self.nodes[0]]
        for axis, test, predicates in steps:
            if axis == "attr":
                owners = current if not predicates else [d for n in current for d in self.within(n, "*")]
                return [(n, n.attrs[test]) for n in owners if n.attrs and test in n.attrs]
            move = {"desc": self.within, "child": self.children, "sib": self.siblings_after}[axis]
            found: dict[int, Node] = {}
            for node in current:
                kept = move(node, test)
                for p in predicates:
                    kept = [n for k, n in enumerate(kept, 1) if p(self, n, k)]
                found.update((n.i, n) for n in kept)
            current = [found[i] for i in sorted(found)]
        return [(n, n.text if n.tag is None else self.string(n)) for n in current]


_STEP = re.compile(r"(//|/)(following-sibling::)?(@?[\w-]+(?:\(\))?|\*)")


def _split(text: str, separators: str) -> list[str]:
    """Split on separators outside brackets, parentheses and quotes."""
    parts, depth, quote, start, i = [], 0, "", 0, 0
    sep = re.compile(separators)
    while i < len(text):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "[(":
            depth += 1
        elif c in "])":
            depth -= 1
        elif depth == 0 and (m := sep.match(text, i)):
            parts.append(text[start:i])
            i = start = m.end()
            continue
        i += 1
    return [p.strip() for p in [*parts, text[start:]]]


@lru_cache(maxsize=4096)
def compile_path(path: str):
    return [_compile_one(p) for p in _split(path, r"\|")]


def _compile_one(path: str):
    steps, at = [], 0
    while at < len(path):
        m = _STEP.match(path, at)
        if not m:
            raise ValueError(f"unsupported selector {path!r} at {at}")
        slash, sibling, test = m.groups()
        at = m.end()
        predicates = []
        while at < len(path) and path[at] == "[":
            end = _bracket_end(path, at)
            predicates.append(_predicate(path[at + 1 : end]))
            at = end + 1
        if test.startswith("@"):
            steps.append(("attr", test[1:], slash == "//"))
        else:
            steps.append(("sib" if sibling else "desc" if slash == "//" else "child", test, predicates))
    return steps


def _bracket_end(text: str, at: int) -> int:
    depth, quote = 0, ""
    for i in range(at, len(text)):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError(f"unclosed bracket in {text!r}")


def _value(text: str):
    """A function (page, node) -> string or None for an operand."""
    if text[0] in "'\"":
        return lambda page, n, s=text[1:-1]: s
    if text.startswith("@"):
        return lambda page, n, a=text[1:]: n.attrs.get(a)
    if text == ".":
        return lambda page, n: page.string(n)
    if text == "text()":
        return lambda page, n: next((c.text for c in page.children(n, "text()")), None)
    name, args = re.fullmatch(r"([\w-]+)\((.*)\)", text, re.S).groups()
    inner = [_value(a) for a in _split(args, ",")]
    if name == "translate":
        return lambda page, n: (inner[0](page, n) or "").translate(str.maketrans(inner[1](page, n), inner[2](page, n)))
    if name == "normalize-space":
        return lambda page, n: " ".join((inner[0](page, n) or "").split())
    if name == "concat":
        return lambda page, n: "".join(f(page, n) or "" for f in inner)
    raise ValueError(f"unsupported function {name!r}")


def _predicate(text: str):
    """A function (page, node, position) -> bool."""
    text = text.strip()
    for word, combine in ((r"\s+or\s+", any), (r"\s+and\s+", all)):
        parts = _split(text, word)
        if len(parts) > 1:
            tests = [_predicate(p) for p in parts]
            return lambda page, n, k: combine(t(page, n, k) for t in tests)
    if text.isdigit():
        return lambda page, n, k: k == int(text)
    if m := re.fullmatch(r"not\((.*)\)", text, re.S):
        test = _predicate(m.group(1))
        return lambda page, n, k: not test(page, n, k)
    if m := re.fullmatch(r"string-length\((.*)\)\s*>\s*(\d+)", text):
        value, least = _value(m.group(1)), int(m.group(2))
        return lambda page, n, k: len(value(page, n) or "") > least
    if m := re.fullmatch(r"(contains|starts-with)\((.*)\)", text, re.S):
        left, right = (_value(a) for a in _split(m.group(2), ","))
        if m.group(1) == "contains":
            return lambda page, n, k: right(page, n) in (left(page, n) or "")
        return lambda page, n, k: (left(page, n) or "").startswith(right(page, n))
    sides = _split(text, "=")
    if len(sides) == 2:
        left, right = _value(sides[0]), _value(sides[1])
        return lambda page, n, k: left(page, n) == right(page, n)
    if text.startswith("@"):
        return lambda page, n, k: text[1:] in n.attrs
    if m := re.fullmatch(r"([\w-]+)(?:\[(.*)\])?", text, re.S):
        test = _predicate(m.group(2)) if m.group(2) else None
        return lambda page, n, k: any(
            test is None or test(page, c, j) for j, c in enumerate(page.children(n, m.group(1)), 1)
        )
    raise ValueError(f"unsupported predicate {text!r}")


_CSS = re.compile(r"([\w-]+|\*)?((?:[.#][\w-]+|\[[^\]]+\])*)")


def css_to_path(selector: str) -> str:
    """`tag.class#id[attr="v"]` with descendant and `>` steps; a trailing `::text` or `::attr(x)` is kept."""
    body, _, tail = selector.partition("::")
    path, link = "", "//"
    for token in body.replace(">", " > ").split():
        if token == ">":
            link = "/"
            continue
        tag, marks = _CSS.fullmatch(token).groups()
        path += link + (tag or "*")
        for mark in re.findall(r"[.#][\w-]+|\[[^\]]+\]", marks):
            if mark[0] == ".":
                path += f"[contains(concat(' ', normalize-space(@class), ' '), ' {mark[1:]} ')]"
            elif mark[0] == "#":
                path += f"[@id='{mark[1:]}']"
            else:
                path += f"[@{mark[1:-1]}]"
        link = "//"
    if tail == "text":
        return path + "/text()"
    if m := re.fullmatch(r"attr\(([\w-]+)\)", tail):
        return path + f"/@{m.group(1)}"
    return path
