"""Links, classes and counts against all pairs compared one by one."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from pageloom.llm import jaccard as J
from pageloom.llm.components import components


def brute_force(rows, size=5, threshold=Fraction(4, 5)):
    """(doc_id, class, links) for (doc_id, text) rows."""
    sets = []
    for _, text in rows:
        w = J.WORDS.findall((text or "").lower())
        sets.append(frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else None)
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    links[i] += 1
                    links[j] += 1
                    label[root(i)] = root(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least.setdefault(root(k), []).append(doc_id)
    first = {r: min((d for d in ids if d is not None), default=None) for r, ids in least.items()}
    return Counter((rows[k][0], first[root(k)], links[k]) for k in range(len(rows)))


def corpus(rng, groups=6, members=25):
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(300)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(20, 200))
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
    rows += [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(60)]
    rows += ["one two", "One, two!", "one two three", "", None, "...", "word " * 3000, "word " * 3001, rows[0], rows[0].upper()]
    rng.shuffle(rows)
    return [(k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 7])
def test_against_all_pairs(spark, block):
    rows = corpus(random.Random(block))
    rows += [(None, rows[3][1]), (None, None), (rows[5][0], rows[5][1]), (rows[6][0], "something else of its own kind here")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, n int")
    got = J.near_copies(docs, J.Settings(block=block)).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == brute_force(rows)


def test_no_rows_and_no_links(spark):
    docs = spark.createDataFrame([(1, "alone here"), (2, None)], "doc_id long, text string")
    assert J.near_copies(docs.filter("false")).count() == 0
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["copies"]) for r in J.near_copies(docs).collect()}
    assert got == {1: (1, 0, 1), 2: (2, 0, 1)}
    assert J.keep_one(docs).count() == 2


def test_keep_one(spark):
    rows = [(5, "a b c d e f g"), (3, "A b c, d e f g!"), (3, "A b c, d e f g!"), (None, "a b c d e f g"), (9, None), (9, None), (8, ""), (7, "other text")]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, _hash long")
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [(3, "A b c, d e f g!"), (7, "other text"), (8, ""), (9, ""), (9, "")]


def test_common_shingles_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, hi, 60).astype(np.uint64)) for hi in [70] * 30 + [400] * 30 + [5000] * 20]
    a, b = np.triu_indices(len(sets), 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)]
    assert J.common_shingles(sets, a, b).tolist() == want
    few = rng.permutation(len(a))[:100]
    assert J.common_shingles(sets, a[few], b[few]).tolist() == [want[k] for k in few]


def test_pruning_keeps_what_may_reach_the_threshold():
    least = J.least_matches(Fraction(4, 5), 1e-6)
    assert least == sorted(least) and all(0 < m < n for m, (_, n) in zip(least[1:], J.CHUNKS[1:], strict=True))
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, (1, J.HASHES)).astype(np.uint16)
    signatures = np.where(rng.random((2000, J.HASHES)) < 0.8, base, rng.integers(0, 1 << 16, (2000, J.HASHES))).astype(np.uint16)
    all_rows = np.concatenate([base, signatures])
    kept = J.prune(all_rows, np.zeros(2000, np.int64), np.arange(1, 2001), least)
    assert len(kept) == 2000
    assert len(J.prune(rng.integers(0, 1 << 16, (50, J.HASHES)).astype(np.uint16), np.arange(25), np.arange(25, 50), least)) == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (200, 200)] + [(300, k) for k in range(301, 340)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, **{k: 300 for k in range(300, 340)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
