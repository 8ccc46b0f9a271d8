"""Base phrases against a plain search; overlaps; odd texts."""

import random
import re
import textwrap

from pageloom.llm import licenses as L


def plain(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words) - len(p) + 1) if words[k:k + len(p)] == p]
    at = [k for k, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def texts():
    rng = random.Random(9)
    parts = ["MIT", "License", "mit license", "Apache", "General", "Public", "general-public\nLICENSE", "GPL", "é", "the", "x9", "—", "licensed under", "İ"]
    odd = [None, "", "mit license mit license", "MITLicense", "mit\x00license", "Äpache license apache license", "general public licence", "license " * 5000,
           "general public license " * 3000, "mit license" + "x" * 100_000]
    return odd + [rng.choice(["", "\n"]).join(rng.choice(parts) + rng.choice([" ", ", ", "_", "\t"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]


def test_base_columns(spark):
    rows = texts()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate([*rows, *rows[:3]])], "doc_id long, text string, labels string, n_words int")
    got = L.scan(df).collect()
    assert len(got) == len(rows) + 3
    for r in got:
        t = [*rows, *rows[:3]][r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain(t), t and t[:200]
        labels = r["labels"].split(",") if r["labels"] else []
        assert labels == sorted(set(labels)) and set(filter(None, r["base_labels"].split(","))) <= set(labels)
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert L.scan(df.filter("false")).count() == 0


def labels(text):
    return L.scan_text(text)["labels"]


def test_signatures():
    assert len(L.signatures()) > 200
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert labels("Licensed under CC BY-NC-SA 4.0.") == "cc-by-nc-sa"
    assert labels("Licensed under the Apache License, Version 2.0") == "apache"
    assert labels("under the GNU Lesser General Public License v2.1") == "gpl,lgpl"  # the base phrase stands in it
    assert labels("see https://opensource.org/licenses/MIT for more") == "mit"
    assert labels("Redistribution and use in source and binary forms, with or without") == "bsd"
    assert labels("All rights reserved.") == "all-rights-reserved"
    assert labels("a driver's license, an apache helicopter") == ""


def plain_settle(found):
    rest, kept = set(found), []
    while rest:
        inside = lambda d: any(o.start <= d.start and d.end <= o.end and o.end - o.start > d.end - d.start for o in rest)
        outer = sorted((d for d in rest if not inside(d)), key=lambda d: (-d.priority, d.start - d.end, d.start, d.label))
        touches = lambda d: any(k.start < d.end and d.start < k.end for k in kept)
        for d in outer:
            if not touches(d):
                kept.append(d)
        rest = {d for d in rest if not touches(d)}
    return sorted(kept, key=lambda d: (d.start, d.end, d.label))


def test_settling_against_the_rules():
    """A plain fixpoint: what goes touches one that stays."""
    rng = random.Random(2)
    for _ in range(600):
        found = list({L.Detection(a, a + rng.randint(1, 12), rng.choice("abc"), rng.choice([50, 60, 70])) for a in rng.choices(range(rng.choice([15, 60])), k=rng.randint(0, 20))})
        kept = L.settle_all(list(found))
        assert kept == L.settle_all(found[::-1]) == plain_settle(found)
        assert all(a.end <= b.start for a, b in zip(kept, kept[1:], strict=False))
        for d in set(found) - set(kept):
            assert any(k.start < d.end and d.start < k.end for k in kept)
    a, b, c = L.Detection(20, 40, "a", 90), L.Detection(0, 30, "b", 50), L.Detection(2, 12, "c", 60)
    assert L.settle([a, b, c]) == [c, a]


def test_long_addresses():
    for n in (1, 60, 450, 5000):
        assert labels("http://joinup.ec.europa.eu/" + "x" * n + "eupl") == labels("http://joinup.ec.europa.eu/xeupl") != ""
        assert labels("y" * n + " licensed under the mit license") == "mit"


def test_prefilter_finds_what_all_patterns_find():
    scanner = L.scanner()
    pool = ["licensed under the mit license", "gpl license version 3", "spdx-license-identifier: isc", "http://unlicense.org", "all rights reserved", "x " * 300,
            "copyright (c) 2020", "neither the name of foo nor the names of its contributors"]
    rng = random.Random(3)
    for _ in range(40):
        text = " ".join(rng.choices(pool, k=6))
        want = {L.Detection(m.start(), m.end(), r.label, r.priority) for ps in scanner.by_keyword.values() for p, r in ps for m in p.finditer(text)}
        assert scanner.detections(text) == L.settle_all(list(want))


BSD3 = """Copyright (c) 2019, Foo Inc.
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software."""
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."
APACHE = "You may not use this file except in compliance with the License."
ZLIB = "This software is provided 'as-is', without any express or implied warranty."
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
CC = "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."


def test_wrapped_notices_give_what_one_line_gives():
    for text, label in ((BSD3, "bsd-3-clause"), (GPL, "gpl"), (MIT, "mit"), (ISC, "isc"), (APACHE, "apache"), (ZLIB, "zlib"), (MPL, "mpl"), (CC, "cc-by-sa")):
        line = " ".join(text.split())
        want = L.scan_text(line)
        spans = [(d[2], line.lower()[d[0]:d[1]]) for d in want["spans"]]
        assert label in want["labels"].split(",")
        for width in (1, 20, 33, 47, 60, 78):
            for lead, tail in (("", ""), ("    ", ""), ("# ", ""), (" * ", ""), ("// ", ""), ("> ", ""), (";; ", ""), ("dnl ", ""), ("/* ", "  */")):
                for newline in ("\n", "\r\n", "\n\n"):
                    lines = textwrap.wrap(line, width, break_long_words=False, break_on_hyphens=False)
                    wrapped = newline.join(lead + x + tail for x in lines)
                    got = L.scan_text(wrapped)
                    assert (got["labels"], got["score"]) == (want["labels"], want["score"]), wrapped
                    own = [(d[2], L.unwrapped(wrapped.lower()[d[0]:d[1]])[0]) for d in got["spans"]]
                    assert own == spans, wrapped


def test_words_of_a_notice_need_their_order():
    assert labels("use in source\nredistribution and binary forms") == ""
    assert labels("# it is a license\n# mit students like") == ""


def test_spdx_expressions():
    for text, want in (
        ("Apache-2.0 OR MIT", "apache,mit"), ("(GPL-2.0-only OR BSD-3-Clause)", "bsd-3-clause,gpl"), ("((MIT AND ISC) OR (Zlib\n * AND 0BSD))", "0bsd,isc,mit,zlib"),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR EPL-2.0.", "epl,gpl"), ("LicenseRef-Own OR MPL-2.0", "mpl"), ("MIT.", "mit"), ("MIT/Apache-2.0", "apache,mit"),
        ("MIT WITH ISC", "mit"), ("MIT, and ISC is a body", "mit"), (" OR ".join(["LGPL-2.1+"] * 200 + ["ISC"]), "isc,lgpl"),
    ):
        assert labels("// SPDX-License-Identifier: " + text) == want, text
    assert labels("License: MIT OR Apache-2.0") == "apache,mit"


def test_names_with_articles_and_versions():
    for text, want in (
        (CC, "cc-by-sa"), ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
        ("licensed under the Creative Commons Attribution-NonCommercial-NoDerivs 3.0 United States License", "cc-by-nc-nd"),
        ("Creative Commons Attribution-Share Alike 3.0 Unported license", "cc-by-sa"), ("the GPL v2 license", "gpl"), ("an Apache 2.0 license", "apache"),
        ("Released under an MIT licence", "mit"), ("Distributed under GPL v3", "gpl"), ("Must not be copied.", "proprietary"), ("License: MIT.", "mit"),
    ):
        assert labels(text) == want, text
