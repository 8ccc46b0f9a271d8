"""Piece hits and Myers' distance against the full edit matrix."""

import random

import pytest

from pageloom.llm import decontaminate as D


def matrix(pattern, text):
    """Least distance of the pattern to any part of the text, and the first end where it is reached."""
    row, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for at, c in enumerate(text):
        new = [0]
        for k, p in enumerate(pattern):
            new.append(min(row[k] + (p != c), row[k + 1] + 1, new[k] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], at + 1)
    return best


def edited(rng, text, n):
    out = list(text)
    for _ in range(min(n, len(out) - 1)):
        k = rng.randrange(len(out))
        what = rng.choice("idr")
        if what == "i":
            out.insert(k, rng.choice("abcde "))
        elif what == "d":
            del out[k]
        else:
            out[k] = rng.choice("xyz")
    return "".join(out)


def test_myers_against_matrix():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 60))) + edited(rng, pattern, rng.randint(0, 6)) + "".join(rng.choices("abc", k=20))
        masks = {}
        for k, c in enumerate(pattern):
            masks[c] = masks.get(c, 0) | (1 << k)
        want = matrix(pattern, text)
        errors = min(rng.randint(0, 12), len(pattern) - 1)
        assert D.myers(masks, len(pattern), text, errors) == (want if want[0] <= errors else None)


def test_every_passage_within_the_budget_is_found():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(200)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(3, 60)))) for k in range(8)]
    matcher = D.Matcher(items, 0.05, 16)
    for _ in range(50):
        k = rng.randrange(8)
        item = D.normal(items[k][1])
        passage = edited(rng, item, rng.randint(0, 8))
        text = D.normal(" ".join(rng.choices(words, k=40)) + " " + passage + " " + " ".join(rng.choices(words, k=40)))
        got = {i: (d, end) for i, d, end in matcher.find(text)}
        for i, t in items:
            t = D.normal(t)
            distance, _ = matrix(t, text)
            assert (distance <= D.budget(len(t), 0.05, 16)) == (i in got)
            if i in got:
                assert got[i][0] == distance


@pytest.fixture(scope="module")
def bench(spark):
    long = "the quick brown fox jumps over the lazy dog while seventeen small birds watch from the old stone wall " * 2
    rows = [(1, long, "x"), (2, None, "x"), (3, "", "x"), (4, "short one", "x"), (None, "an item without an id but with some words", "x"), (6, long, "y")]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string"), D.normal(long)


def test_documents(spark, bench):
    items, long = bench
    texts = [
        f"before {long} after", f"before {long.upper()}\n after", f"x {long[:50]}zz{long[52:]} y", f"half {long[:90]}", None, "", "a short  ONE.",
        "has an item without an id but with some words inside", f"before {long} after", "clean text of no interest", "w" * 200_000 + " " + long,
    ]
    docs = spark.createDataFrame([(k if k != 8 else 0, t, 1.5) for k, t in enumerate(texts)], "doc_id long, text string, item_id double")
    got = sorted(((r["doc_id"], r["item_id"] or -1, r["distance"]) for r in D.contaminated(docs, items).collect()))
    assert got == sorted([
        (0, 1, 0), (0, 6, 0), (1, 1, 0), (1, 6, 0), (2, 1, 2), (2, 6, 2), (6, 4, 0), (7, -1, 0), (0, 1, 0), (0, 6, 0), (10, 1, 0), (10, 6, 0)])
    small = D.contaminated(docs, items, block_chars=60)
    assert sorted(((r["doc_id"], r["item_id"] or -1, r["distance"]) for r in small.collect())) == got
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 9]
    assert D.contaminated(docs.filter("false"), items).count() == 0
    assert D.contaminated(docs, items.filter("false")).count() == 0
    assert D.keep_clean(docs, items.filter("false")).count() == len(texts)


def test_query_finds_all_exact_passages(spark):
    from pageloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: D.normal(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r["item_id"]: D.normal(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    rows = QUERIES["op9_decontamination"](spark, folder).collect()
    assert want and {(r["doc_id"], r["item_id"]) for r in rows if r["distance"] == 0} == want
    for r in rows:
        assert matrix(items[r["item_id"]], docs[r["doc_id"]])[0] == r["distance"]


def test_changed_and_cut_items_of_the_benchmark_are_found(spark):
    import inspect

    rate, piece = (inspect.signature(D.contaminated).parameters[n].default for n in ("rate", "piece"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert all(D.budget(len(D.normal(t)), rate, piece) == int(rate * len(D.normal(t))) for _, t in items)
    matcher = D.Matcher(items, rate, piece)

    def share(change):
        found = 0
        for item_id, text in items:
            passage = D.normal("some words before " + " ".join(change(D.normal(text).split())) + " and some after")
            got = {i: d for i, d, _ in matcher.find(passage)}
            distance = matrix(D.normal(text), passage)[0]
            assert got.get(item_id) == (distance if distance <= D.budget(len(D.normal(text)), rate, piece) else None)
            found += item_id in got
        return found / len(items)

    assert share(lambda words: ["xyz" if k % 20 == 10 else w for k, w in enumerate(words)]) >= 0.95
    assert share(lambda words: words[:len(words) - max(1, len(words) // 10)]) >= 0.9
