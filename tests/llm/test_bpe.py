"""The automaton against the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pageloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\t ", "Hello, world!", "don't we'll THEY'RE", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "naïve café Ünïcödé",
    "ΣΊΣΥΦΟΣ ΟΔΟΣ.", "é é ́x", "İstanbul ﬁ ß", "日本語 テキスト 한국어", "👩‍👩‍👧 ok", "1234567 3.14 ²½", "a\x1cb \x1f c\x85d\xa0e f",
    "x" * 5000, "ab" * 3000 + " aab", "____ ---- ....", "\x00 nul", "aaaaaaaaaaaaaaa aaaa", "ſ K Å", "​‍ zero",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def mine():
    with open(PATH) as f:
        return bpe.WordTokenizer(json.load(f))


def check(library, mine, text):
    want = library.encode(text, add_special_tokens=False).ids
    ids = mine.encode(text)
    assert list(ids) == want, text[:200]
    assert mine.decode(ids) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, mine, text):
    check(library, mine, text)


def test_random_words(library, mine):
    rng = random.Random(3)
    for alphabet in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "aäeöñçé'", "0123456789.-!?"):
        for _ in range(300):
            check(library, mine, " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(5)))


def test_all_code_points(library, mine):
    """Every character between a letter, a digit and spaces, and next to others of its kind."""
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 500):
        some = points[start:start + 500]
        text = " ".join(f"x{chr(c)}1 a{chr(c)}" for c in some)
        want = library.encode(text, add_special_tokens=False).ids
        if list(mine.encode(text)) != want:
            for c in some:
                check(library, mine, f"x{chr(c)}1 a{chr(c)}")
            check(library, mine, text)


def test_random_mixtures(library, mine):
    rng = random.Random(9)
    points = [c for c in range(0x20000) if not 0xD800 <= c <= 0xDFFF] + [0x301, 0x308, 0x3A3, 0x130, 0x1C89, 0xA7CB, 0x558, 0x10940] * 400
    for _ in range(1500):
        check(library, mine, "".join(chr(rng.choice(points)) if rng.random() < 0.4 else rng.choice("aE é1'. \n") for _ in range(rng.randint(1, 40))))


def brute_force(symbols, ranks):
    """Merge the best pair again and again, all its places from the left."""
    out = list(symbols)
    while True:
        pairs = [(ranks[p], p) for p in zip(out, out[1:], strict=False) if p in ranks]
        if not pairs:
            return out
        _, (a, b) = min(pairs)
        merged, k = [], 0
        while k < len(out):
            both = k + 1 < len(out) and (out[k], out[k + 1]) == (a, b)
            merged.append(a + b if both else out[k])
            k += 1 + both
        out = merged


def test_automaton_against_merging():
    """Small random merge lists, with runs of one symbol and useless merges."""
    rng = random.Random(5)
    for _ in range(150):
        tokens, merges = ["a", "b", "c"], []
        for _ in range(rng.randint(1, 14)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) <= 8:
                merges.append((u, v))
                tokens.append(u + v)
        automaton = bpe.TokenAutomaton({t: k for k, t in enumerate(tokens)}, merges)
        ranks = {m: k for k, m in enumerate(merges)}
        for _ in range(40):
            symbols = rng.choices("abc", weights=[5, 2, 1], k=rng.randint(1, 16))
            ids = automaton.encode(symbols)
            assert automaton.decode(ids) == brute_force(symbols, ranks), (merges, symbols)


def test_one_path_is_accepted():
    automaton = bpe.TokenAutomaton({t: k for k, t in enumerate(["a", "b", "ab", "aa", "aab"])}, [("a", "b"), ("a", "a"), ("a", "ab")])
    with pytest.raises(ValueError):
        automaton.encode(["x"])
    with pytest.raises(ValueError):
        bpe.TokenAutomaton({"a": 0, "aa": 1, "aaa": 2}, [("a", "a"), ("a", "aa"), ("aa", "a")])


def test_documents(spark, library):
    texts = [*ODD, None, "Hello, world!"]
    rows = [(k if k != 3 else None, t, "extra", 7) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else 3, list(r["ids"]), r["decoded"]) for r in bpe.encode(docs, PATH).collect())
    for k, ids, decoded in got:
        assert ids == library.encode(texts[k] or "", add_special_tokens=False).ids
        assert decoded == library.decode(ids, skip_special_tokens=False)
    assert len(got) == len(texts)
    assert bpe.encode(docs.filter("false"), PATH).count() == 0


def test_query(spark):
    from pageloom.llm.queries import QUERIES

    library = Tokenizer.from_file(PATH)
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
