"""Token files against the tokenizers library, and round trips."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pageloom.llm import binary
from pageloom.llm.base import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  ", "a  b", "a   b", "a \n b", "a \nb", "a\n\n b ", " lead", "trail ", "x\x00y z", "<|endoftext|>", "x <|endoftext|> y", "it's 'quoted' ''",
    "naïve Ünï ²½ 日本語 👩‍👩‍👧", "a  b c   d", "\t\ttabs \t x", "w" * 3000, None, "1234 5,678.9", "\x1c \x1f x",
]


def test_files(spark):
    library = Tokenizer.from_file(PATH)
    rows = [(100 - k, t, 1, "s") for k, t in enumerate(ODD)] + [(None, "no id", 2, "s"), (None, None, 2, "s"), (50, "again", 3, "s"), (50, "again", 3, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, tokens string")
    path = scratch(spark, "test")
    manifest = binary.write_tokens(docs.repartition(3), path, PATH)
    got = sorted(((r["start"], r["doc_id"], list(r["ids"])) for r in binary.read_tokens(spark, path).collect()), key=lambda x: x[0])
    assert len(got) == len(rows) and manifest["tokens"] == sum(len(ids) for _, _, ids in got)
    want = {}
    for doc_id, text, *_ in rows:
        want.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    seen = {}
    at = 0
    for start, doc_id, ids in got:
        assert start == at
        at += len(ids)
        seen.setdefault(doc_id, []).append(ids)
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    keys = [-1 if d is None else d for _, d, _ in got]
    assert keys == sorted(keys)
    assert np.dtype(manifest["dtype"]) == np.uint16
    again = binary.write_tokens(docs.repartition(2), scratch(spark, "test"), PATH)
    assert again["tokens"] == manifest["tokens"]


def test_empty(spark):
    path = scratch(spark, "test")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert binary.write_tokens(docs, path, PATH)["tokens"] == 0
    assert binary.read_tokens(spark, path).count() == 0


def test_query(spark):
    from pageloom.llm.queries import QUERIES

    library, folder = Tokenizer.from_file(PATH), "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op6_token_files"](spark, folder).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = np.array([*library.encode(texts[doc_id], add_special_tokens=False).ids, 0], "<u4")
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(rows) == len(texts)
