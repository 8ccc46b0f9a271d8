"""Each stage against a plain version of what it is to do, on its own input; odd documents through all of them."""

import public_tokenizers
import pytest
from test_decontaminate import matrix
from test_jaccard import brute_force
from test_quality import plain as quality_counts
from tokenizers import Tokenizer

import corpus_pipeline
from pageloom.llm import decontaminate
from pageloom.llm.base import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], FOLDER), "step"))
    return [{r["doc_id"]: r for r in df.collect()} for df in out], out


def test_columns_and_order(steps):
    rows, frames = steps
    assert [df.columns for df in frames[1:-1]] == [frames[0].columns] * 4
    for before, after in zip(rows, rows[1:], strict=False):
        assert set(after) <= set(before) and after


def test_quality(steps):
    before, after = steps[0][0], steps[0][1]
    for doc_id, r in before.items():
        n, _, _, _, repeated = quality_counts(r["text"])
        if n < 10 or 100 * repeated > 20 * n:
            assert doc_id not in after
    assert len(after) > 0.6 * len(before)


def test_language_keeps_clean_documents(steps):
    assert len(steps[0][2]) >= 0.99 * len(steps[0][1])


def test_one_of_each_group_stays(steps):
    before, after = steps[0][2], steps[0][3]
    assert set(after) == {c for _, c, _ in brute_force([(d, r["text"]) for d, r in before.items()])}


def test_leaks_go(spark, steps):
    before, after = steps[0][3], steps[0][4]
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    exact = {d for d, r in before.items() if any(i in decontaminate.normal(r["text"]) for i in items)}
    gone = set(before) - set(after)
    assert exact <= gone
    for d in gone - exact:
        text = decontaminate.normal(before[d]["text"])
        assert any(matrix(i, text)[0] <= decontaminate.budget(len(i), 0.12, 7) for i in items)


def test_tokens(spark, steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, after = steps[0][4], steps[0][5]
    assert set(before) == set(after)
    for d, r in after.items():
        ids = library.encode(before[d]["text"], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_run(spark, steps):
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect()} == set(steps[0][5])


def test_odd_documents(spark):
    """Nulls, empty and repeated rows, extra columns with clashing names, and no rows at all."""
    text = "the quick brown fox and the lazy dog are in the garden with you today"
    rows = [(k, f"{text} number {k}", "en", "s", 1) for k in range(40)]
    rows += [(None, None, None, None, None), (5, "", "en", "s", 0), (None, f"{text} without an id or a language", None, None, None), (0, f"{text} number 0", "en", "s", 1)]
    docs = spark.createDataFrame(
        [(*r, "x", 2, 3.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, ids string, `key` int, score double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {r[0] for r in rows}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == len(rows)
    none = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, FOLDER)
    assert none.count() == 0
