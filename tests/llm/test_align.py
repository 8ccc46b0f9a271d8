"""Alignment against a plain version that encodes whole texts and compares every byte offset."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pageloom.llm import align
from pageloom.llm.bpe import byte_characters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "\n", "a  b", " lead", "trail  ", "a\n\nb \n c\n", "\n\n  x", "tab\tsep \t x", "x\x0b\x0cy", "cr\r\nlf;\r\n}", "it's 'quoted' ''",
    "<|endoftext|> x<|endoftext|>", "<s> </s> <unk> <0x41>", "sp▁ace", "▁", "naïve Ünï ²½ 日本語 👩‍👩‍👧 é", "\x00nul \x7f", "w" * 3000, "ab" * 500,
    "!" * 77 + " ...---... " + "=" * 130, "1234 5,678.9  (x) [y]; z|w", " " * 50 + "x" + " " * 33, "nbsp x 　 y", "\u0085 x", "ÀÖØöøÿ éà", "́",
]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), {c: b for b, c in byte_characters().items()}


def whole(library, text):
    """Lists of (id, stop) of both tokenizers, or None."""
    a, b, byte_of = library
    if not text:
        return None
    ids_a, ids_b, want = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text), (" " + text).encode()
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return None
    out = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, row = 0, []
        for i, p in zip(ids, parts, strict=True):
            at += len(p)
            row.append((i, at))
        out.append(row)
    return out


def plain(library, texts):
    cut, holds = [], Counter()
    for text in texts:
        found = whole(library, text)
        groups = []
        if found:
            own, other = found
            common = {s for _, s in own} & {s for _, s in other}
            last = 0
            for stop in sorted(common):
                groups.append(([i for i, s in own if last < s <= stop], [i for i, s in other if last < s <= stop]))
                last = stop
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        holds.update(links.keys())
        cut.append((found, groups, links))
    highest = {}
    for (x, _), n in holds.items():
        highest[x] = max(highest.get(x, 0), n)
    rows = []
    for found, groups, links in cut:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((
            len(found[0]) if found else 0, len(found[1]) if found else 0, len(groups), links.total(),
            sum(n for (x, y), n in links.items() if holds[x, y] == highest[x]), sum(n * holds[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if found else ""))
    return rows


def test_runs_encode_as_whole_texts(library):
    with open(A, "rb") as a, open(B, "rb") as b:
        aligner = align.Aligner(a.read(), b.read())
    assert aligner.common.fullmatch("plain text\n")
    assert not aligner.common.fullmatch("cr\r")
    rng = random.Random(3)
    letters = "aeiou st.,'0159()-_/é\n\t  \x0b\x0c" + "THßö;:!\"{}="
    for _ in range(4000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 40)))
        found = whole(library, text)
        numbers = aligner.numbers([text])[0]
        ids = [";".join(aligner.runs.text[k] for k in numbers)]
        got = [[int(i) for c in ids[0].split(";") for i in c.split("|")[side].split(",")] for side in (0, 1)]
        assert got == [[i for i, _ in side] for side in found], text


def test_against_plain(spark, library, monkeypatch):
    texts = [*ODD, "a  b", "the cat sat", "the cat sat", None, *("the cat " * k + "dog" for k in range(1, 30))]
    frame = spark.createDataFrame([(None if k % 11 == 5 else k // 2, t, k, "p") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, pair string")
    want = Counter((None if k % 11 == 5 else k // 2, *row) for k, row in enumerate(plain(library, texts)))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in align.linked(frame.repartition(3), A, B).select(names).collect()) == want
    small = align.linked
    for n in (1, 50):
        monkeypatch.setattr(align, "BLOCK_LINKS", n)
        assert Counter(tuple(r) for r in small(frame.repartition(2), A, B).select(names).collect()) == want
    cut = {r["doc_id"]: r["groups"] for r in align.groups(frame, A, B).collect() if r["doc_id"] is not None}
    assert cut[2] in ([], cut[2]) and all(g["a"] and g["b"] for groups in cut.values() for g in groups)


def test_empty(spark):
    assert align.linked(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    assert [r["n_a"] for r in align.linked(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).collect()] == [0]


def test_query(spark, library):
    from pageloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    want = [(d, *row) for (d, _), row in zip(docs, plain(library, [t for _, t in docs]), strict=True)]
    got = QUERIES["op11_token_alignment"](spark, folder).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted(map(tuple, got.collect())) == want
