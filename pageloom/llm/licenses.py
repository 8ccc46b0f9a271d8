"""License scans: signature rules behind a keyword prefilter on the unwrapped text; priority and containment settle overlaps."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from pageloom.llm.base import id_and_text, per_text

# Phrases whose words count wherever they stand one after the other, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# label: (SPDX-like ids, patterns of the full name, pattern of its address)
FAMILIES: dict[str, tuple[str, str, str]] = {
    "mit": (r"mit", r"mit|expat|x11", r"opensource\.org/licenses/mit"),
    "mit-0": (r"mit-0", r"mit no[- ]attribution", r"opensource\.org/licenses/mit-0"),
    "apache": (r"apache-(?:1\.[01]|2\.0)", r"apache(?: software)?", r"apache\.org/licenses"),
    "gpl": (r"gpl-[23]\.0(?:-only|-or-later|\+)?", r"gnu general public|gnu gpl|gpl", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    "lgpl": (r"lgpl-[23]\.[01](?:-only|-or-later|\+)?", r"gnu (?:lesser|library) general public|lgpl", r"gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    "agpl": (r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu affero general public|affero general public|agpl", r"gnu\.org/licenses/agpl"),
    "gfdl": (r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu free documentation|gfdl", r"gnu\.org/licenses/fdl"),
    "bsd-2-clause": (r"bsd-2-clause", r"bsd 2-clause|simplified bsd|freebsd", r"opensource\.org/licenses/bsd-2-clause"),
    "bsd-3-clause": (r"bsd-3-clause", r"bsd 3-clause|new bsd|modified bsd", r"opensource\.org/licenses/bsd-3-clause"),
    "bsd-4-clause": (r"bsd-4-clause", r"bsd 4-clause|original bsd", r"spdx\.org/licenses/bsd-4-clause"),
    "bsd": (r"bsd", r"bsd|berkeley software distribution", r"opensource\.org/licenses/bsd-license"),
    "0bsd": (r"0bsd", r"zero[- ]clause bsd|bsd zero[- ]clause", r"opensource\.org/licenses/0bsd"),
    "mpl": (r"mpl-(?:1\.[01]|2\.0)", r"mozilla public|mpl", r"mozilla\.org/(?:en-us/)?mpl"),
    "epl": (r"epl-[12]\.0", r"eclipse public|epl", r"eclipse\.org/legal/epl"),
    "eupl": (r"eupl-1\.[12]", r"european union public|eupl", r"joinup\.ec\.europa\.eu/\S*eupl"),
    "cddl": (r"cddl-1\.[01]", r"common development and distribution|cddl", r"opensource\.org/licenses/cddl"),
    "cpl": (r"cpl-1\.0", r"common public", r"opensource\.org/licenses/cpl"),
    "isc": (r"isc", r"isc|internet systems consortium", r"opensource\.org/licenses/isc"),
    "zlib": (r"zlib", r"zlib|zlib/libpng", r"opensource\.org/licenses/zlib"),
    "libpng": (r"libpng(?:-2\.0)?", r"libpng|png reference library", r"libpng\.org/\S*license"),
    "boost": (r"bsl-1\.0", r"boost software", r"boost\.org/license"),
    "unlicense": (r"unlicense", r"unlicense", r"unlicense\.org"),
    "wtfpl": (r"wtfpl", r"do what the f\w+ you want to public|wtfpl", r"wtfpl\.net"),
    "artistic": (r"artistic-[12]\.0", r"artistic|perl artistic", r"opensource\.org/licenses/artistic"),
    "ofl": (r"ofl-1\.[01]", r"sil open font|open font", r"scripts\.sil\.org/ofl"),
    "psf": (r"psf-2\.0|python-2\.0", r"python software foundation|psf", r"docs\.python\.org/\S*license"),
    "php": (r"php-3\.0[1]?", r"php", r"php\.net/license"),
    "ruby": (r"ruby", r"ruby", r"ruby-lang\.org/\S*license"),
    "postgresql": (r"postgresql", r"postgresql", r"postgresql\.org/about/licen[cs]e"),
    "openssl": (r"openssl", r"openssl", r"openssl\.org/source/license"),
    "ncsa": (r"ncsa", r"university of illinois/ncsa|ncsa open source", r"opensource\.org/licenses/ncsa"),
    "ms-pl": (r"ms-pl", r"microsoft public", r"opensource\.org/licenses/ms-pl"),
    "ms-rl": (r"ms-rl", r"microsoft reciprocal", r"opensource\.org/licenses/ms-rl"),
    "osl": (r"osl-[123]\.[01]", r"open software", r"opensource\.org/licenses/osl"),
    "afl": (r"afl-[123]\.[01]", r"academic free", r"opensource\.org/licenses/afl"),
    "upl": (r"upl-1\.0", r"universal permissive", r"opensource\.org/licenses/upl"),
    "zpl": (r"zpl-[12]\.[01]", r"zope public", r"zope\.org/\S*zpl"),
    "ipl": (r"ipl-1\.0", r"ibm public", r"opensource\.org/licenses/ibmpl"),
    "qpl": (r"qpl-1\.0", r"q public", r"opensource\.org/licenses/qtpl"),
    "vim": (r"vim", r"vim", r"vimhelp\.org/\S*license"),
    "curl": (r"curl", r"curl", r"curl\.se/docs/copyright"),
    "odbl": (r"odbl-1\.0", r"open database|odbl", r"opendatacommons\.org/licenses/odbl"),
    "odc-by": (r"odc-by-1\.0", r"open data commons attribution", r"opendatacommons\.org/licenses/by"),
    "pddl": (r"pddl-1\.0", r"public domain dedication and", r"opendatacommons\.org/licenses/pddl"),
    "cc0": (r"cc0-1\.0", r"cc0|creative commons zero", r"creativecommons\.org/publicdomain/zero"),
    "cc-by": (r"cc-by-[1234]\.[05]", r"creative commons attribution|cc[- ]by", r"creativecommons\.org/licenses/by/"),
    "cc-by-sa": (r"cc-by-sa-[1234]\.[05]", r"creative commons attribution[- ]share[- ]?alike|cc[- ]by-sa", r"creativecommons\.org/licenses/by-sa/"),
    "cc-by-nd": (r"cc-by-nd-[1234]\.[05]", r"creative commons attribution[- ]no[- ]?deriv\w*(?: works)?|cc[- ]by-nd", r"creativecommons\.org/licenses/by-nd/"),
    "cc-by-nc": (r"cc-by-nc-[1234]\.[05]", r"creative commons attribution[- ]non[- ]?commercial|cc[- ]by-nc", r"creativecommons\.org/licenses/by-nc/"),
    "cc-by-nc-sa": (r"cc-by-nc-sa-[1234]\.[05]", r"creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike|cc[- ]by-nc-sa", r"creativecommons\.org/licenses/by-nc-sa/"),
    "cc-by-nc-nd": (r"cc-by-nc-nd-[1234]\.[05]", r"creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?deriv\w*(?: works)?|cc[- ]by-nc-nd", r"creativecommons\.org/licenses/by-nc-nd/"),
    "open-rail": (r"(?:bigscience-)?openrail(?:\+\+|-m)?", r"(?:bigscience )?open rail|openrail", r"huggingface\.co/\S*openrail"),
    "sspl": (r"sspl-1\.0", r"server side public|sspl", r"mongodb\.com/licensing/server-side"),
    "elastic": (r"elastic-2\.0", r"elastic", r"elastic\.co/licensing"),
    "busl": (r"busl-1\.1", r"business source|bsl 1\.1", r"mariadb\.com/bsl"),
}

# Sentences of the texts themselves: label, keyword, pattern.
SENTENCES = (
    ("mit", "permission is hereby granted", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("mit", "sublicense", r"use, copy, modify, merge, publish, distribute, sublicense"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms"),
    ("bsd-3-clause", "neither the name", r"neither the names? of .{1,120}? nor the names? of (?:(?:its|their|any|the|other) )*contributors"),
    ("isc", "permission to use", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose"),
    ("gpl", "free software", r"this (?:program|library|file) is free software[:;,] you can redistribute it"),
    ("gpl", "free software foundation", r"as published by the free software foundation"),
    ("apache", "except in compliance", r"you may not use this (?:file|work) except in compliance with the license"),
    ("mpl", "source code form", r"this source code form is subject to the terms"),
    ("zlib", "as-is", r"this software is provided .?as-is.?, without any express or implied warranty"),
    ("unlicense", "public domain", r"free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("all-rights-reserved", "rights reserved", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    *(("proprietary", f"not be {done}", rf"(?:may|must) not be {done}") for done in ("copied", "redistributed", "reproduced")),
)

RAREST = {max(phrase.split(), key=len).encode() for phrase in PHRASES}
WORD_SPACE = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
LOWER_AZ = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: str
    priority: int  # the higher wins where detections overlap


VERBS = ("licensed", "licenced", "released", "distributed", "available", "published")
SPDX = "spdx-license-identifier"
OF = r"(?:the |an? )?(?:terms (?:and conditions )?of )?(?:the |an? )?"  # what may stand between `under` and a name
END = r"\b(?![-\w]|\.\w)"


def signatures() -> tuple[Signature, ...]:
    """All rules: for each family its tag, its name in a licensing phrase, its bare name, and its address; then sentences.

    They are matched against the unwrapped text, where a space stands for any run of white space and comment marks.
    """
    out = []
    for label, (tag, name, address) in FAMILIES.items():
        named = rf"(?:{name})\b(?: public)?"
        # a version, and for Creative Commons the country it was adapted to, may stand before `license`
        before = r"(?:,? (?:version |v\.? ?)?\d(?:\.\d)?" + (r"(?: [a-z]+){0,3}?" if label.startswith("cc") else "") + ")?"
        after = r"(?:,? (?:version |v\.? ?){}\d(?:\.\d)?)?"
        out.append(Signature(label, SPDX, rf"{SPDX}:[\s(]*(?:{tag}){END}", 90))
        for verb in VERBS:
            out.append(Signature(
                label, f"{verb} under", rf"{verb} under {OF}{named}(?:{before} (?:public )?licen[cs]e{after.format('?')}|{after.format('?')})", 70))
        out.append(Signature(label, "licen", rf"\b{named}{before} (?:public )?licen[cs]e{after.format('')}", 60))
        out.append(Signature(label, "licen", rf"\blicen[cs]e:\s*(?:{tag}|{name}){END}", 65))
        out.append(Signature(label, "://", rf"https?://(?:www\.)?{address}", 80))
    out.extend(Signature(label, keyword, pattern, 50) for label, keyword, pattern in SENTENCES)
    return tuple(out)


# What a line may begin with, and end with after white space, where it is part of a comment.
LEAD = re.compile(r"(?:[\s#*/;!%>|+-]++|<!--|::|\.\\\"|(?:@?rem|dnl)(?=\s))*+")
TAIL = "#*/;|\\-+!%"
RUN = re.compile(r"\s{2,}|[^\S ]")


def unwrapped(text: str) -> tuple[str, list[int], list[int]]:
    """The text as one line: comment marks at the edges of lines go, a run of white space is one space.

    Also the places where its pieces begin, in the new text and in the old one.
    """
    parts, new, old, at, line_start = [], [], [], 0, 0

    def put(piece: str, place: int) -> None:
        nonlocal at
        parts.append(piece)
        new.append(at)
        old.append(place)
        at += len(piece)

    for line in text.splitlines(keepends=True):
        body = line.rstrip()
        bare = body.rstrip(TAIL)
        if bare != body and bare[-1:].isspace():
            body = bare.rstrip()
        start = LEAD.match(body).end()
        if start < len(body):
            if parts:
                put(" ", old[-1] + len(parts[-1]))
            for run in RUN.finditer(body, start):
                put(body[start:run.start()] + " ", line_start + start)
                start = run.end()
            put(body[start:], line_start + start)
        line_start += len(line)
    return "".join(parts), new, old


HEAD = re.compile(rf"(?:({SPDX})|\blicen[cs]e):[\s(]*")
ID = re.compile(r"[a-z0-9][\w.+-]*(?::[\w.+-]+)?")
OPERATOR = re.compile(r"[\s)]*(?:(?<=[\s)])(and|or|with)(?=[\s(])|/)[\s(]*")


@lru_cache(4096)
def labels_of_id(name: str) -> tuple[str, ...]:
    name = name.rstrip(".")
    return tuple(label for label, (tag, full, _) in FAMILIES.items() if any(re.fullmatch(f"{tag}|{full}", n) for n in {name, name.rstrip("+")}))


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int


def settle(found: list[Detection]) -> list[Detection]:
    """The detections that stay; no two of them touch.

    In rounds: of what is left, those that lie in no longer one are settled by priority, then length, start and label; all that touches one that stays goes. So a detection
    inside a longer one comes back when the longer one itself gives way, and the result does not depend on the order of the rules.
    """
    rest, kept = list(dict.fromkeys(found)), []
    while rest:
        outer, reach, since = [], -1, -1
        for d in sorted(rest, key=lambda d: (d.start, -d.end)):
            if d.end > reach:
                reach, since = d.end, d.start
                outer.append(d)
            elif d.end == reach and d.start == since:
                outer.append(d)
        starts, stops = [], []
        for d in sorted(outer, key=lambda d: (-d.priority, d.start - d.end, d.start, d.label)):
            at = bisect_right(stops, d.start)
            if at == len(starts) or d.end <= starts[at]:
                starts.insert(at, d.start)
                stops.insert(at, d.end)
                kept.append(d)
        at = [bisect_right(stops, d.start) for d in rest]
        rest = [d for d, k in zip(rest, at, strict=True) if k == len(starts) or d.end <= starts[k]]
    return sorted(kept, key=lambda d: (d.start, d.end, d.label))


def further_ids(text: str) -> Iterator[Detection]:
    """The ids of all SPDX expressions after the first, which a rule finds; exceptions (after `with`) are no licenses."""
    at = 0
    while head := HEAD.search(text, at):
        at, operator = head.end(), None
        while m := ID.match(text, at):
            if operator and operator[1] != "with":
                for label in labels_of_id(m[0]):
                    yield Detection(m.start(), m.start() + len(m[0].rstrip(".")), label, 90 if head[1] else 65)
            operator = OPERATOR.match(text, m.end())
            if not operator:
                break
            at = operator.end()


class Scanner:
    """Rules grouped by keyword; a text is only searched with the patterns whose keywords it holds."""

    def __init__(self, rules: tuple[Signature, ...]):
        self.by_keyword: dict[str, list[tuple[re.Pattern, Signature]]] = {}
        for rule in rules:
            self.by_keyword.setdefault(rule.keyword, []).append((re.compile(rule.pattern), rule))
        self.keywords, self.words = ahocorasick.Automaton(), ahocorasick.Automaton()
        for k in self.by_keyword:
            self.keywords.add_word(k, k)
            word = max(k.split(), key=len)  # no line break parts a word, so texts without it need not be unwrapped
            self.words.add_word(word, word)
        self.keywords.make_automaton()
        self.words.make_automaton()

    def detections(self, lowered: str) -> list[Detection]:
        """Patterns run on the neighbourhood of their keyword in the unwrapped text, joined where they touch; places are those of `lowered`."""
        if next(self.words.iter(lowered), None) is None:
            return []
        text, new, old = unwrapped(lowered)
        at: dict[str, list[int]] = {}
        for end, keyword in self.keywords.iter(text):
            at.setdefault(keyword, []).append(end)
        found = set()
        for keyword, ends in at.items():
            for start, stop in self._windows(text, ends, keyword):
                for pattern, rule in self.by_keyword[keyword]:
                    for m in pattern.finditer(text, start, stop):
                        found.add(Detection(m.start(), m.end(), rule.label, rule.priority))
        if "licen" in at or SPDX in at:
            found.update(further_ids(text))

        def place(k: int) -> int:
            piece = bisect_right(new, k) - 1
            return old[piece] + k - new[piece]

        return settle_all([Detection(place(d.start), place(d.end - 1) + 1, d.label, d.priority) for d in found])

    @staticmethod
    def _windows(text: str, ends: list[int], keyword: str, reach: int = 400) -> list[tuple[int, int]]:
        """What a pattern can match around a keyword: `reach` characters to either side, as all that patterns hold but addresses is shorter, and to the end of an address."""
        out: list[list[int]] = []
        for end in ends:
            start, stop = max(0, end - len(keyword) - reach), min(len(text), end + reach)
            start = text.rfind(" ", 0, start) + 1 if start and text[start - 1] != " " else start
            if stop < len(text) and text[stop] != " ":
                blank = text.find(" ", stop)
                stop = len(text) if blank < 0 else min(len(text), blank + reach)
            if out and start <= out[-1][1]:
                out[-1][1] = max(out[-1][1], stop)
            else:
                out.append([start, stop])
        return [(a, b) for a, b in out]


def settle_all(found: list[Detection]) -> list[Detection]:
    """`settle` by clusters of touching detections, so that a text with very many of them takes linear time."""
    out, cluster, reach = [], [], -1
    for d in sorted(found, key=lambda d: (d.start, d.end, d.label)):
        if cluster and d.start >= reach:
            out.extend(settle(cluster))
            cluster = []
        cluster.append(d)
        reach = max(reach, d.end) if len(cluster) > 1 else d.end
    return out + settle(cluster)


@cache
def scanner() -> Scanner:
    return Scanner(signatures())


def phrase_places(joined: bytes, phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(number of the first word, label) of all places; `joined` has the words between single spaces, and one at either end."""
    hits = []
    for phrase, label in phrases.items():
        needle, at = b" " + phrase.encode() + b" ", -1
        while (at := joined.find(needle, at + 1)) >= 0:
            hits.append((at, label))
    out, last, words = [], 0, 0
    for at, label in sorted(hits):  # count the spaces between one hit and the next only
        words += joined.count(b" ", last, at)
        last = at
        out.append((words, label))
    return out


def scan_text(text: str | None) -> dict:
    raw = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_AZ)
    words = raw.translate(WORD_SPACE).split()
    out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
    places = []
    if any(word in raw for word in RAREST):
        places = phrase_places(b" " + b" ".join(words) + b" ")
        if places:
            out |= {"n_base": len(places), "first_word": places[0][0], "last_word": places[-1][0],
                    "base_labels": ",".join(sorted({label for _, label in places}))}
    found = scanner().detections(raw.decode("utf-8", "surrogatepass"))
    labels = {label for _, label in places} | {d.label for d in found}
    if labels:
        best = max([60] * bool(places) + [d.priority for d in found])
        out |= {"labels": ",".join(sorted(labels)), "score": best / 100, "spans": [(d.start, d.end, d.label) for d in found]}
    return out


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<start: long, end: long, label: string>>"
)
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))


def _columns() -> Callable[[list, list], dict]:
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]

    def step(ids: list, texts: list) -> dict:
        rows = [scan_text(t) for t in texts]
        names = list(rows[0]) if rows else []
        return {"doc_id": pa.array(ids, pa.int64())} | {
            name: pa.array([
                [{"start": a, "end": b, "label": c} for a, b, c in r[name]] if name == "spans" else r[name] for r in rows
            ], kind) for name, kind in zip(names, types, strict=True)}

    return step


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: words, places of the base phrases, labels, score, and the spans the rules settled on.

    Text is lower-cased in A-Z only. Null and empty texts have no words, no labels (empty strings) and score 0; places are null where
    there are none. The score is the priority of the best detection over 100. Notices may be wrapped, indented and set in comments, and all ids
    of an SPDX expression count. Repeated rows are scanned each for itself; an empty table gives no rows; other columns are ignored.
    Spans count characters.
    """
    return per_text(id_and_text(docs), _columns, SCHEMA)
