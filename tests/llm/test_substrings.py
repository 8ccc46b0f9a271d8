"""Substring dedup against a plain table of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from pageloom.llm import substrings
from pageloom.llm.substrings import Settings, without_repeats

LARGE = 1 << 62


def plain(docs, size):
    """Words left of each row, in the rows' order."""
    least, texts = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    ids = [LARGE if d is None else d for d, _ in docs]
    for d, words in zip(ids, texts, strict=True):
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            least[key] = min(least.get(key, LARGE), d)
    out = []
    for d, words in zip(ids, texts, strict=True):
        gone = set()
        for i in range(len(words) - size + 1):
            if least[tuple(words[i:i + size])] < d:
                gone.update(range(i, i + size))
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def check(spark, docs, settings, parts=3):
    frame = spark.createDataFrame([(d, t, 1, "p") for d, t in docs], "doc_id long, text string, row int, part string")
    got = without_repeats(frame.repartition(parts), settings).collect()
    want = [(d, *row) for (d, _), row in zip(docs, plain(docs, settings.words), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["n_removed"] == sum(x["stop"] - x["start"] for x in r["removed"]) for r in got)
    return got


def corpus(seed, n, vocabulary, longest=60):
    """Texts that share passages, whole and in part, copies and repeats within themselves."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [rng.choices(words, k=rng.randint(5, 30)) for _ in range(6)]
    out = []
    for d in range(n):
        text = []
        while len(text) < rng.randint(0, longest):
            p = rng.choice(passages)
            lo = rng.randint(0, len(p) // 2)
            text += p[lo:] if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 12))
        out.append((d, rng.choice([" ", "\n", "  \t"]).join(text)))
        if rng.random() < 0.15:
            out.append((rng.choice([d, d + 1000, None]), out[rng.randrange(len(out))][1]))
    return out


@pytest.mark.parametrize("settings, vocabulary", [(Settings(8, 3), 40), (Settings(8, 8), 4), (Settings(5, 1), 3), (Settings(12, 4), 2000)])
def test_against_plain(spark, settings, vocabulary):
    docs = corpus(vocabulary, 60, vocabulary)
    got = check(spark, docs, settings)
    assert any(0 < r["n_removed"] < r["n_words"] for r in got)


def test_odd_rows(spark):
    base = " ".join(f"x{i}" for i in range(60))
    docs = [
        (5, base), (5, base), (None, base), (None, base), (7, None), (8, ""), (9, " \n\t "), (10, "one"), (2, "y " * 120), (3, "y " * 49), (4, "y " * 50),
        (11, base.replace("x30", "X30")), (12, "é   " + base + "\u0085 tail"), (13, "long " + "z" * 200_000), (-1, "lead " + base)]
    check(spark, docs, Settings())


def test_empty(spark):
    assert check(spark, [], Settings()) == []


def test_parts_of_a_long_text(spark, monkeypatch):
    docs = corpus(5, 20, 50, 400)
    for size, most in ((40, 10), (1000, 100)):
        monkeypatch.setattr(substrings.words_of, "__defaults__", (size,))
        monkeypatch.setattr(substrings._slices, "__defaults__", (most,))
        s = Settings(8, 3)
        for text in (t.encode() for _, t in docs):
            assert [w for part in substrings.words_of(text) for w in part] == text.split()
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"text": pa.array([t.encode() for _, t in docs])})
        seen = []
        for rows, firsts, sizes, words in substrings._slices(batch, s):
            at = 0
            for row, first, n in zip(rows, firsts, sizes, strict=True):
                seen += [(row, first + i, tuple(words[at + i:at + i + 8])) for i in range(n - 7)]
                at += n
        want = [(row, i, tuple(t.encode().split()[i:i + 8])) for row, (_, t) in enumerate(docs) for i in range(len(t.split()) - 7)]
        assert seen == want


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(2)
    words = [b"v%d" % i for i in rng.integers(0, 6, 3000)]
    hasher, s = substrings.Hasher(), Settings(10, 3)
    hasher.load(words)
    first, count, a, _ = substrings.winnowed(hasher, len(words), np.full(len(words), len(words)), s)
    chosen = {}
    for f, c, x in zip(first.tolist(), count.tolist(), a.tolist(), strict=True):
        for i in range(f, f + c):
            assert chosen.setdefault(tuple(words[i:i + 10]), x) == x
    assert count.sum() == len(words) - 9


def test_query(spark):
    from pageloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    want = [(d, n, gone, hashlib.sha256(text.encode()).hexdigest()) for (d, _), (n, gone, text) in zip(docs, plain(docs, 50), strict=True)]
    got = QUERIES["op13_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == want and sum(r[2] for r in want) > 0
