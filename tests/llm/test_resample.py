"""Importance resampling against a plain version of the same rules."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from pageloom.llm import resample
from pageloom.llm.resample import Settings, SlotTable, resample as draw

ODD = [
    None, "", "   ", "One two  THREE one-two", "é É ÀB z z", "tab\tnew\nline", "a" * 70 + " " + "a" * 69 + "b " + "a" * 70, "日本 語 x9 " * 9,
    "the cat sat on the mat and the dog sat on the log while a bird sang to the moon and the sun went down", "x " * 40,
]


def plain(docs, target, s):
    def grams(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [" ".join(words[i:i + n]) for n in range(s.shortest, s.longest + 1) for i in range(len(words) - n + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % s.buckets
    own, wanted = (Counter(bucket(g) for _, t in rows for g in grams(t)[1]) for rows in (docs, target))
    own_all, wanted_all = own.total() + s.buckets, wanted.total() + s.buckets
    out, may = [], []
    for row, (doc_id, text) in enumerate(docs):
        n, found = grams(text)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * own_all / ((own[b] + 1) * wanted_all))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n, len(found), weight, score, None])
        if n >= s.least_words:
            may.append((-score, doc_id is None, doc_id or 0, row))
    for rank, (*_, row) in enumerate(sorted(may)[:len(may) * s.percent // 100], 1):
        out[row][5] = rank
    return sorted(map(str, out))


def both(spark, docs, target, settings):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, bucket string, weight int")
    got = draw(frame.repartition(3), spark.createDataFrame([(t, 7) for _, t in target], "text string, score int"), settings)
    rows = got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()
    assert sorted(str(list(r)) for r in rows) == plain(docs, target, settings)


@pytest.mark.parametrize("settings", [
    Settings(), Settings(buckets=7, percent=50, least_words=3), Settings(1, 3, 50, 5, 2, 30), Settings(2, 2, 100, 1, 1, 100)])
def test_against_plain(spark, settings):
    docs = [*enumerate(ODD), (None, ODD[8]), (3, ODD[3]), (3, ODD[3]), *((100 + i, f"word{i % 5} " * (i + 10) + ODD[8]) for i in range(40))]
    both(spark, docs, [(0, "the bird and the moon"), (1, None), (2, "word3 word3")], settings)


def test_empty_tables(spark):
    both(spark, [], [(0, "a b")], Settings())
    both(spark, [(1, "a b c " * 9)], [], Settings(percent=100))


def test_parts_of_a_long_text():
    words = [f"w{i % 977}" for i in range(5000)]
    text = " ".join(words).encode()
    old, resample.words_of.__defaults__ = resample.words_of.__defaults__, (100,)
    try:
        for low, high in ((1, 1), (2, 3), (1, 4)):
            found = [g for _, grams in resample.features(text, low, high) for g in grams]
            assert Counter(found) == Counter(" ".join(words[i:i + n]).encode() for n in range(low, high + 1) for i in range(len(words) - n + 1))
    finally:
        resample.words_of.__defaults__ = old
    giant = b"a" * (3 << 20)
    assert [g for _, grams in resample.features(giant + b" b", 1, 1) for g in grams] == [giant, b"b"]


def test_equal_keys_are_settled_by_bytes(monkeypatch):
    rng = np.random.default_rng(1)
    grams = [b"x" * int(n) + bytes([97 + int(c)]) + b"y" * int(m) for n, c, m in rng.integers(0, [40, 4, 60], (3000, 3))]
    for digest in (xxhash.xxh64_intdigest, lambda g: len(g), lambda g: 5 if len(g) < 30 else 1 << 63):
        monkeypatch.setattr(resample.xxhash, "xxh64_intdigest", digest)
        table = SlotTable(grams, 1000)
        assert {int(s): g for s, g in zip(table.slot, grams, strict=True)} == {int(s): grams[i] for i, s in enumerate(table.slot)}
        assert len(table.used) == len(set(grams)) == len(set(table.slot.tolist()))
        want = Counter(grams)
        assert all(table.count[s] == want[g] and table.bucket[s] == zlib.crc32(g) % 1000 for s, g in zip(table.slot, grams, strict=True))


def test_ranks_over_ranges(spark):
    scored = spark.range(1000).selectExpr("id doc_id", "id % 7 score").repartition(13)
    got = {r["doc_id"]: r["rank"] for r in resample.ranked(scored, 35).collect()}
    want = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert got == {d: (k + 1 if k < 350 else None) for k, d in enumerate(want)}
