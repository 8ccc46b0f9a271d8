"""Alignment of two tokenizers: texts are cut where tokens of both end, and what stands in one cut is linked."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from pageloom.llm.base import id_and_text, worker_state, written
from pageloom.llm.bpe import byte_characters

SHIFT = 16                  # a pair of ids is one number: A's id, then 16 bits of B's
BLOCK_LINKS = 2_000_000     # links of one block, and what bounds its memory
REMEMBERED = 400_000        # runs of text a worker keeps from block to block


class Runs:
    """Aligned runs of text, numbered; what is known of each stands in flat arrays."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.n_a, self.n_b, self.n_groups, self.n_links = (array("q") for _ in range(4))
        self.stops, self.pairs, self.times = array("q", [0]), array("q"), array("q")


class Aligner:
    """Both tokenizers, and a memory of aligned runs.

    Before white space that follows another character, and between a letter and a sentence mark, no token of either tokenizer goes on. So a text is cut there
    and each distinct run is encoded and aligned once. That holds for texts of common characters, for which A's split pattern is known and B's pieces are looked
    through here. Any other text is one run.
    """

    COMMON = "\t\n\x0b\x0c -~À-ÖØ-öø-ÿ"
    SPACE, LETTER, MARK = "\t\n\x0b\x0c ", "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
    RUN = re.compile(f"[{SPACE}]*[^{SPACE}]*?[{LETTER}](?=[{MARK}])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
    WORD = re.compile(" ?[A-Za-z]+")

    def __init__(self, a: bytes, b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_str(a.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        byte_of = {c: k for k, c in byte_characters().items()}
        self.a_bytes = [bytes(byte_of[c] for c in self.a.id_to_token(i) if c in byte_of) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if len(pieces) > 1 << SHIFT or len(self.a_bytes) > 1 << 17:
            raise ValueError("ids of A must be below 2^17 and of B below 2^16")
        self.a_lengths, self.b_lengths = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        inner = "".join(pieces)
        crossing = re.compile(f"[^▁]▁|[{self.LETTER}][{self.MARK}]|\n")
        self.known = not any(map(crossing.search, pieces)) and self._splits_as_known()
        self.common = re.compile(r"(?!)" if not self.known else
                                 "[" + re.sub("[\t\n\x0b\x0c]", lambda m: "" if m[0] in inner else m[0], self.COMMON) + "]*")
        self.space = byte_characters()[32]
        self.runs = Runs()

    def _splits_as_known(self) -> bool:
        probe = "It's  a\n\n probe, ÀÉ.b?! 12\t x \x0b\x0cy  "
        split = self.a.pre_tokenizer
        whole = [x for x, _ in split.pre_tokenize_str(" " + probe)] if split else []
        parts = [x for run in self.RUN.findall(" " + probe) for x, _ in split.pre_tokenize_str(run)] if split else []
        joined = b"".join(self.b_bytes[i] for i in self.b.encode(probe))
        return self.a.normalizer is None and bool(whole) and whole == parts and joined == (" " + probe).encode()

    def _encoded(self, runs: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of runs of a text. A word is one piece to A, so its model gets it as it is. B puts a space before what it gets (but for nothing): a run's own first space goes, and before any other run stands a
        line break, which like the space before it is a piece of its own."""
        words = [r.replace(" ", self.space) if self.known and self.WORD.fullmatch(r) else None for r in runs]
        others = iter(self.a.encode_batch_fast([r for r, w in zip(runs, words, strict=True) if w is None], add_special_tokens=False))
        a = [next(others).ids if w is None else [t.id for t in self.a.model.tokenize(w)] for w in words]
        b = self.b.encode([r[1:] if r[0] == " " else "\n" + r for r in runs], num_threads=1)
        return a, [(ids or [self.b.piece_to_id("▁")]) if r[0] == " " else ids[2:] for r, ids in zip(runs, b, strict=True)]

    def slices(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        """Where the groups of two encodings of the same bytes end: places in both lists of ids behind which both have reached the same byte."""
        index_a = dict(zip(accumulate([self.a_lengths[i] for i in a]), range(1, len(a) + 1)))
        index_b = dict(zip(accumulate([self.b_lengths[i] for i in b]), range(1, len(b) + 1)))
        return [(index_a[end], index_b[end]) for end in sorted(index_a.keys() & index_b.keys())]

    def _add(self, run: str, a: list[int], b: list[int]) -> int:
        """Align a run and number it; its links as pairs of ids with how often each stands, never one by one."""
        known, data = self.runs, run.encode()
        links: dict[int, int] = {}
        text, n_links = [], 0
        if b"".join([self.a_bytes[i] for i in a]) == data == b"".join([self.b_bytes[i] for i in b]):
            i = j = 0
            for p, q in self.slices(a, b):
                if p - i == q - j == 1:
                    x, y = a[i], b[j]
                    text.append(f"{x}|{y}")
                    links[x << SHIFT | y] = links.get(x << SHIFT | y, 0) + 1
                    n_links += 1
                else:
                    own, other = a[i:p], b[j:q]
                    text.append(",".join(map(str, own)) + "|" + ",".join(map(str, other)))
                    n_links += (p - i) * (q - j)
                    if n_links > 100:
                        counted = [(x, n, y, m) for x, n in Counter(own).items() for y, m in Counter(other).items()]
                    else:
                        counted = [(x, 1, y, 1) for x in own for y in other]
                    for x, n, y, m in counted:
                        links[x << SHIFT | y] = links.get(x << SHIFT | y, 0) + n * m
                i, j = p, q
            known.n_a.append(len(a))
            known.n_b.append(len(b))
        else:
            known.n_a.append(-1)
            known.n_b.append(-1)
        known.n_groups.append(len(text))
        known.n_links.append(n_links)
        known.text.append(";".join(text))
        known.pairs.extend(links)
        known.times.extend(links.values())
        known.stops.append(len(known.pairs))
        return len(known.text) - 1

    def numbers(self, texts: list[str | None]) -> list[list[int]]:
        """The runs of each text, by number; none for null and empty ones. New runs of all texts are encoded together."""
        known = self.runs.number
        cut = [[] if not t else self.RUN.findall(" " + t) if self.common.fullmatch(t) else [" " + t] for t in texts]
        new = list({r: None for runs in cut for r in runs if r not in known})
        if new:
            for run, a, b in zip(new, *self._encoded(new), strict=True):
                known[run] = self._add(run, a, b)
        return [[known[r] for r in runs] for runs in cut]


def aligner_of(a: bytes, b: bytes) -> Aligner:
    return worker_state(("aligner", hash(a), hash(b)), lambda: Aligner(a, b))


def _held(docs: DataFrame, a_file: str, b_file: str):
    """Both vocabulary files for the tasks; they are of fixed size."""
    files = []
    for name in (a_file, b_file):
        with open(name, "rb") as f:
            files.append(f.read())
    return docs.sparkSession.sparkContext.broadcast(tuple(files))


def groups(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """doc_id and groups, array of struct<a: array<int>, b: array<int>>, of every row; empty where `linked` says there are no tokens."""
    held = _held(docs, a_file, b_file)
    ids = pa.list_(pa.int32())
    kind = pa.list_(pa.struct([("a", ids), ("b", ids)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*held.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = batch.slice(start, 64)
                out = []
                for numbers in aligner.numbers(rows.column("text").to_pylist()):
                    bad = any(aligner.runs.n_a[k] < 0 for k in numbers)
                    cuts = [c.split("|") for k in numbers for c in aligner.runs.text[k].split(";")] if not bad else []
                    out.append([{"a": [int(x) for x in a.split(",")], "b": [int(x) for x in b.split(",")]} for a, b in cuts])
                if len(aligner.runs.text) > REMEMBERED:
                    aligner.runs = Runs()
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(out, kind)], names=["doc_id", "groups"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def _block(runs: Runs, ids: list, texts: list[list[int]], block: int) -> Iterator[dict]:
    """Rows of a block: its documents, whose links name places in the sorted list of the block's pairs, and that list."""
    sizes = np.array([len(t) for t in texts], np.int64)
    number = np.concatenate([np.array(t, np.int64) for t in texts]) if texts else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)

    def total(column: array) -> np.ndarray:
        return np.bincount(doc, np.frombuffer(column, np.int64)[number], len(texts)).astype(np.int64) if len(number) else np.zeros(len(texts), np.int64)

    bad = np.zeros(len(texts), bool)
    if len(number):
        bad[doc[np.frombuffer(runs.n_a, np.int64)[number] < 0]] = True
    stops = np.frombuffer(runs.stops, np.int64)
    keep = ~bad[doc]
    first, n = stops[number[keep]], stops[number[keep] + 1] - stops[number[keep]]
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    # One key for (document, pair): a pair of ids takes 33 bits at most, and a block has fewer documents than 2^29.
    key = np.repeat(doc[keep], n) << 34 | np.frombuffer(runs.pairs, np.int64)[at] if len(at) else np.empty(0, np.int64)
    order = np.argsort(key, kind="stable")
    key, times = key[order], (np.frombuffer(runs.times, np.int64)[at] if len(at) else at)[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    key, times = key[new], np.add.reduceat(times, new) if len(new) else times
    pairs, place = np.unique(key & ((1 << 34) - 1), return_inverse=True)
    cuts = np.searchsorted(key, np.arange(1, len(texts)) << 34)
    pack = pa.Codec("zstd", compression_level=1)
    links = []
    for p, t in zip(np.split(place, cuts), np.split(times, cuts), strict=True):
        gaps = np.diff(p, prepend=0).astype("<u4")
        links.append(len(p).to_bytes(4, "little") + pack.compress(gaps.tobytes() + t.astype("<i8").tobytes(), asbytes=True) if len(p) else None)
    digests = [
        hashlib.sha256(";".join([runs.text[k] for k in t]).encode()).hexdigest() if t and not b else "" for t, b in zip(texts, bad, strict=True)]
    yield {
        "block": [block] * len(texts), "doc_id": ids, "n_a": np.where(bad, 0, total(runs.n_a)), "n_b": np.where(bad, 0, total(runs.n_b)),
        "n_groups": np.where(bad, 0, total(runs.n_groups)), "n_links": np.where(bad, 0, total(runs.n_links)), "groups_sha256": digests,
        "links": links, "pair": [None] * len(texts), "docs": [None] * len(texts)}
    for start in range(0, len(pairs), 1 << 16):
        some = pairs[start:start + (1 << 16)]
        none = [None] * len(some)
        yield {"block": [block] * len(some), "doc_id": none, "n_a": none, "n_b": none, "n_groups": none, "n_links": none, "groups_sha256": none,
               "links": none, "pair": some, "docs": np.bincount(place, minlength=len(pairs))[start:start + (1 << 16)]}


SCHEMA = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("links", pa.binary()), ("pair", pa.int64()), ("docs", pa.int64())])
RESULT = pa.schema([SCHEMA.field(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [
    ("n_best", pa.int64()), ("count_sum", pa.int64()), SCHEMA.field("groups_sha256")])


def _valued(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Of each document of a block, its links whose pair is the best of its A id, and the sum of their counts."""
    order = np.argsort(pairs.column("pair").to_numpy())
    count, best = pairs.column("count").to_numpy()[order], pairs.column("best").to_numpy().astype(np.int64)[order]
    unpack = pa.Codec("zstd")
    n_best, count_sum = [], []
    for packed in docs.column("links").to_pylist():
        if packed is None:
            n_best.append(0)
            count_sum.append(0)
            continue
        n = int.from_bytes(packed[:4], "little")
        raw = unpack.decompress(packed[4:], decompressed_size=12 * n, asbytes=True)
        place, times = np.cumsum(np.frombuffer(raw, "<u4", n), dtype=np.int64), np.frombuffer(raw, "<i8", n, 4 * n)
        n_best.append(int(times @ best[place]))
        count_sum.append(int(times @ count[place]))
    return docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"]).append_column(
        "n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column(
        "groups_sha256", docs.column("groups_sha256")).cast(RESULT)


def linked(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Of every row: doc_id, n_a and n_b (tokens), n_groups, n_links, n_best, count_sum and groups_sha256.

    A is a byte-level tokenizer file that encodes space + text, B a sentencepiece model that encodes the text; strings of special
    tokens are plain text. A pair's count is the number of rows that hold it linked; n_best are the links whose count is the highest
    of their A id, ties included; count_sum sums the counts over all links.

    Texts never leave their task: rows go in blocks, each with one list of its distinct pairs. The lists are summed by pair, and the
    counts come back to the block. Null and empty texts, and texts whose tokens do not give back their bytes, have zeros and the digest
    ''. Null doc_ids, rows of one doc_id and equal texts are rows of their own; an empty table gives no rows; other columns are not looked at.
    """
    held = _held(docs, a_file, b_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part, n_blocks = aligner_of(*held.value), TaskContext.get().partitionId(), 0
        ids, texts, links = [], [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            for rows in _block(aligner.runs, ids, texts, part << 32 | n_blocks):
                yield pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in SCHEMA], schema=SCHEMA)
            if len(aligner.runs.text) > REMEMBERED:
                aligner.runs = Runs()

        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                rows = batch.slice(start, 64)
                found = aligner.numbers(rows.column("text").to_pylist())
                ids += rows.column("doc_id").to_pylist()
                texts += found
                links += sum(aligner.runs.n_links[k] for t in found for k in t)
                if links >= BLOCK_LINKS:
                    yield from finished()
                    ids, texts, links, n_blocks = [], [], 0, n_blocks + 1
        if ids:
            yield from finished()

    rows = written(id_and_text(docs).mapInArrow(run, _ddl(SCHEMA)), "aligned")
    pairs = rows.filter("pair IS NOT NULL").select(F.col("block").alias("_block"), "pair", "docs")
    counts = pairs.groupBy("pair").agg(F.sum("docs").alias("count"))
    # The pairs of one A id are as many as B's vocabulary at most.
    of_a = Window.partitionBy(F.shiftright("pair", SHIFT))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(of_a))
    valued = pairs.join(counts, "pair").select("_block", "pair", "count", "best")
    texts = rows.filter("pair IS NULL").drop("pair", "docs")
    return texts.groupBy("block").cogroup(valued.groupBy("_block")).applyInArrow(_valued, _ddl(RESULT))


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'long' if f.type == pa.int64() else f.type}" for f in schema)
