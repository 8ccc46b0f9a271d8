"""Counts and verdicts against a plain loop."""

import random
import re

from pageloom.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k:k + 5]), []).append(k)
    covered = {p + d for places in windows.values() if len(places) > 1 for p in places for d in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(8)
    out = [None, "", " ", "\n\n", "a", "one two three four five", "🙂 ünï|<>#*$%& x", "same line\nsame line\n same line", "a\x0bb\x0cc\rd\te", "w " * 20_000]
    for _ in range(120):
        n = rng.choice([5, 12, 60, 300])
        words = [rng.choice(["the", "of", "x1", "und", "zwölf", "<b>", "|", "STOP!!", "lorem", "ipsum"]) for _ in range(n)]
        if rng.random() < 0.4:
            words = words[:rng.randint(5, n)] * rng.randint(1, 3)
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t", "  "]) for w in words))
    return out


def test_counts(spark):
    rows = texts()
    df = spark.createDataFrame([(k, t, 1, True) for k, t in enumerate(rows)], "doc_id long, text string, n_words int, kept boolean")
    got = {r["doc_id"]: r for r in quality.quality_rules(df).collect()}
    assert len(got) == len(rows)
    for k, t in enumerate(rows):
        r, want = got[k], plain(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, t
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"]) and r["kept"] == (not r["base_failed"] and not r["broken"])


def test_keep_good_keeps_columns_and_repeated_rows(spark):
    good = "the quick brown fox and the lazy dog are in the garden with you today"
    rows = [(1, good, "a", 3), (1, good, "a", 3), (None, good, "b", 4), (2, None, "c", 5), (3, "### $$$ %%% " * 9, "d", 6), (4, "too short", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `kept` string, `odd.name` int")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"] or 0, r["kept"], r["odd.name"]) for r in kept.collect())) == [(0, "b", 4), (1, "a", 3), (1, "a", 3)]
    assert quality.keep_good(df.filter("false")).count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame([(1, "x" * 30 + " and the of in on at to we " * 3)], "doc_id long, text string")
    assert quality.quality_rules(df, thresholds=()).first()["broken"] == []
    strict = (quality.Threshold("long_words", "word_chars", "n_words", percent_max=10),)
    assert quality.quality_rules(df, thresholds=strict).first()["broken"] == ["long_words"]
