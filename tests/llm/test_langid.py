"""Code lengths against a plain context tree; accuracy on held-out documents; odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pageloom.llm import langid as L

FOLDER = "/root/testdata/sf0.01"


def plain_bits(training, text):
    """Bits of each text's bytes by method C over contexts of at most three bytes that were seen twice."""
    seen = defaultdict(Counter)
    for t in training:
        b = b"\n\n\n" + t.lower().encode()
        for k in range(3, len(b)):
            for order in range(4):
                seen[b[k - order:k]][b[k]] += 1

    def bits(context, byte):
        counts = seen.get(context)
        if counts is None or sum(counts.values()) < 2:
            return bits(context[1:], byte) if context else 8.0
        total, kinds = sum(counts.values()), len(counts)
        if byte in counts:
            return -math.log2(counts[byte] / (total + kinds))
        return -math.log2(kinds / (total + kinds)) + (bits(context[1:], byte) if context else 8.0)

    b = b"\n\n\n" + text.lower().encode()
    return sum(bits(b[k - 3:k], b[k]) for k in range(3, len(b)))


def counts_of(texts):
    codes, n = np.unique(np.concatenate([L.four_grams(t) for t in texts]), return_counts=True)
    return codes, n.astype(float)


def test_code_lengths_are_exact():
    rng = random.Random(1)
    training = {"xx": ["the cat sat on the mat. " * 3, "Été là-bas"], "yy": ["der hund und die katze ", "ß"], "zz": ["a"]}
    texts = ["the hund sat", "", "ÉÉÉ 日本 the", "zzz", "a", "the cat sat on the mat. " * 40] + [
        "".join(rng.choices("abcdeth \nßé", k=rng.randint(1, 400))) for _ in range(40)]
    scorer = L.Scorer({k: counts_of(v) for k, v in training.items()}, pairs=30)
    for step in (1 << 20, 50):  # whole groups, and windows of one text
        got = scorer.code_lengths(texts, step)
        for k, t in enumerate(texts):
            assert got[k, -1] == len(t.lower().encode())
            for m, lang in enumerate(("xx", "yy", "zz")):
                assert got[k, m] == pytest.approx(plain_bits(training[lang], t), rel=1e-4, abs=1e-3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_held_out_accuracy(spark, documents):
    from pageloom.llm.queries import QUERIES

    lang = {r["doc_id"]: (r["lang"], r["text"]) for r in documents.collect()}
    rows = QUERIES["op8_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]][0]]
    assert len(held) > 200
    assert sum(r["lang_pred"] == lang[r["doc_id"]][0] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    """A language that only held-out, unlabelled or idless documents have is never predicted."""
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 4 == 2]
    rows = [(k, "zzz qqq zzz", "zz") for k in ids] + [(None, "zzz qqq", "zz"), (1, "the and of", None)]
    others = [k for k in range(200) if k not in ids and k != 1]
    rows += [(k, "the cat and the dog of the house", "en") for k in others[:60]] + [(k, "der hund und die katze", "de") for k in others[60:]]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    counts = L.train(docs)
    assert sorted(counts) == ["de", "en"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (None, "the dog"), (5, "der hund " * 200_000), (5, "und")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in L.identify(odd, counts).collect()))
    assert got == [(0, "en", True), (1, "und", False), (2, "und", False), (3, "und", False), (5, "de", True), (5, "de", True)]
    assert L.train(docs.filter("false")) == {}
    assert {r["lang_pred"] for r in L.identify(odd, {}).collect()} == {"und"}
    kept = L.keep_known(docs.unionAll(docs.limit(0)), counts, max_bits_per_byte=4.0)
    assert kept.columns == docs.columns and {r["lang"] for r in kept.collect()} == {"en", "de", None}


def test_sample_is_bounded(documents):
    few, more = L.train(documents, 5), L.train(documents, 50)
    assert all(few[k][1].sum() < more[k][1].sum() for k in few)
