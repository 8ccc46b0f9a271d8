"""Totals after batches of changes against a recount of what is left."""

import random
from collections import Counter

import pytest

from pageloom.llm.base import scratch
from pageloom.llm.rollups import CHANGE, TokenRollup


def recount(batches):
    state = {}
    for changes in batches:
        best = {}
        for kind, doc_id, version, source, lang, n, seq in changes:
            if kind not in ("insert", "delete", "revise"):
                continue
            key = (doc_id, version)
            rank = (seq if seq is not None else -1, kind, n or 0, source or "", lang or "")
            if key not in best or rank > best[key][0]:
                best[key] = (rank, kind, source, lang, n or 0)
        for key, (_, kind, source, lang, n) in best.items():
            if kind == "insert" or (kind == "revise" and key in state):
                state[key] = (source, lang, n)
            elif kind == "delete":
                state.pop(key, None)
    docs, tokens = Counter(), Counter()
    for (_, version), (source, lang, n) in state.items():
        docs[source, lang, version] += 1
        tokens[source, lang, version] += n
    return {k: (docs[k], tokens[k]) for k in docs}


def got(rollup):
    return {(r["source"], r["lang"], r["version"]): (r["documents"], r["tokens"]) for r in rollup.totals().collect()}


def test_random_batches(spark):
    rng = random.Random(4)
    batches = [[
        (rng.choice(["insert", "insert", "delete", "revise", "odd", None]), rng.choice([None, *range(12)]), rng.choice(["v1", "v2", None]),
         rng.choice(["a", "b", None]), rng.choice(["en", "de", None]), rng.choice([None, 0, 5, 17]), rng.choice([0, 1, 2, None]))
        for _ in range(40)] for _ in range(4)]
    rollup = TokenRollup(spark, scratch(spark, "test"))
    assert got(rollup) == {}
    for number, changes in enumerate(batches, 1):
        df = spark.createDataFrame([(*c, "x") for c in changes * 2], f"{CHANGE}, tokens string")
        assert rollup.apply(df, number) is True
        assert rollup.apply(df, number) is False
        assert got(rollup) == recount(batches[:number])
        assert rollup.state().count() == sum(d for d, _ in got(rollup).values())
    with pytest.raises(ValueError):
        rollup.apply(spark.createDataFrame([], CHANGE), 0)
    assert rollup.apply(spark.createDataFrame([], CHANGE), 9) and got(rollup) == recount(batches)


def test_a_batch_that_broke_off_counts_once(spark, monkeypatch):
    """Everything is written but the commit; the batch is sent again."""
    rollup = TokenRollup(spark, scratch(spark, "test"))
    df = spark.createDataFrame([("insert", k, "v1", "s", "en", 10, 0) for k in range(5)], CHANGE)
    with monkeypatch.context() as m:
        m.setattr("pageloom.llm.rollups.put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            rollup.apply(df, 1)
    assert got(rollup) == {}
    assert rollup.apply(df, 1)
    assert got(rollup) == {("s", "en", "v1"): (5, 50)}
