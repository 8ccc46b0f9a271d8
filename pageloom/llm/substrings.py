"""Substring dedup by seed and extend: winnowed anchors that meet in several documents are extended to windows, and repeats of a window or more go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pageloom.llm.base import id_and_text, scratch, written


@dataclass(frozen=True)
class Settings:
    words: int = 50   # of a window: the least length of a repeat
    seed: int = 16    # words of an anchor


LAST = (1 << 63) - 1
SPLIT = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
BASE = 0x9E3779B97F4A7C15


def words_of(text: bytes, size: int = 1 << 21) -> Iterator[list[bytes]]:
    """Words of a text, some hundred thousand at a time."""
    text, start = text.translate(SPLIT), 0
    while start < len(text):
        stop = len(text) if start + size >= len(text) else text.find(b" ", start + size)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].split()
        start = stop


class Hasher:
    """64-bit hashes of words and of runs of words; runs by differences of prefix sums of word hash times power."""

    def __init__(self) -> None:
        self.word: dict[bytes, int] = {}
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def load(self, words: list[bytes]) -> None:
        n = len(words)
        while len(self.power) <= n:
            k, mod = len(self.power), 1 << 64
            self.power = np.concatenate([self.power, self.power * np.uint64(pow(BASE, k, mod))])
            self.inverse = np.concatenate([self.inverse, self.inverse * np.uint64(pow(pow(BASE, -1, mod), k, mod))])
        if len(self.word) > 200_000:
            self.word = {}
        known = self.word
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        own = np.fromiter(map(known.__getitem__, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * self.power[:n], dtype=np.uint64)])

    def runs(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        v = (self.sums[stop] - self.sums[start]) * self.inverse[start]
        v = (v ^ (v >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return v ^ (v >> np.uint64(29))


def winnowed(hasher: Hasher, n: int, stops: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that choose the same anchor: their first window, number, anchor hash and the hash of all their words.

    A window of `words` words chooses the least hash among its runs of `seed` words, the leftmost of equals; this follows from the
    window's words alone, so equal windows choose equal anchors at equal places. `stops` is where the document of each word ends.
    """
    none = np.empty(0, np.int64)
    if n < s.words:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = np.arange(n - s.seed + 1)
    seeds = hasher.runs(at, at + s.seed)
    least, span, width = (seeds & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), 1, s.words - s.seed + 1
    while span < width:
        step = min(span, width - span)
        least, span = np.minimum(least[:-step], least[step:]), span + step
    chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.flatnonzero(np.arange(len(chosen)) + s.words <= stops[:len(chosen)])
    chosen = chosen[window]
    new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)])) if len(window) else none
    first, count = window[new], np.diff(np.append(new, len(window)))
    return first, count, seeds[chosen[new]], hasher.runs(first, first + count + s.words - 1)


def _slices(batch: pa.RecordBatch, s: Settings, most: int = 300_000) -> Iterator[tuple[list[int], list[int], list[int], list[bytes]]]:
    """Parts of texts, `most` words or a little more at a time: row, place of the part's first word in its text, length, all words.

    A part repeats the last words of the part before it, one fewer than a window has, so every window lies in exactly one part.
    """
    rows, firsts, sizes, words = [], [], [], []
    for row, text in enumerate(batch.column("text")):
        tail, place = [], 0
        for part in words_of(text.as_py() or b""):
            part = tail + part
            rows.append(row)
            firsts.append(place)
            sizes.append(len(part))
            words += part
            if len(words) >= most:
                yield rows, firsts, sizes, words
                rows, firsts, sizes, words = [], [], [], []
            keep = min(len(part), s.words - 1)
            tail, place = part[len(part) - keep:], place + len(part) - keep
    if words:
        yield rows, firsts, sizes, words


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def numbered(docs: DataFrame) -> DataFrame:
    """row, part, doc_id, d (doc_id, or the largest number for null) and text, written once and bucketed by part.

    A part is what one task wrote, so the write needs no exchange; spans found for a row come back to its text by (part, row)
    without moving texts.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    name = f"substrings_{uuid.uuid4().hex}"
    row = F.monotonically_increasing_id()
    rows = id_and_text(docs).select(
        row.alias("row"), "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.col("text").cast("binary").alias("text"))
    rows.withColumn("part", F.shiftright("row", 33)).write.format("parquet").option("compression", "zstd").option(
        "path", scratch(spark, "numbered-texts")).bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").saveAsTable(name)
    return spark.table(name)


def anchors(texts: DataFrame, s: Settings) -> DataFrame:
    """row, d, span (first window and their number), a (anchor) and r (all words of the run) of every run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids, d = batch.column("row").to_numpy(), batch.column("d").to_numpy()
            for rows, firsts, sizes, words in _slices(batch, s):
                hasher.load(words)
                stops = np.cumsum(sizes)
                of = np.repeat(np.arange(len(sizes)), sizes)
                first, count, a, r = winnowed(hasher, len(words), stops[of], s)
                piece = of[first]
                row = np.array(rows, np.int64)[piece]
                place = first - (stops - sizes)[piece] + np.array(firsts, np.int64)[piece]
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(ids[row]), "d": pa.array(d[row]), "span": pa.array(place << 16 | count), "a": _signed(a), "r": _signed(r)})

    return texts.select("row", "d", "text").mapInArrow(run, "row long, d long, span long, a long, r long")


def windows(texts: DataFrame, s: Settings) -> DataFrame:
    """row, d, a, w (hash) and at (place) of every window of the rows' `runs`, array of struct<span, a>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            ids, d = batch.column("row").to_numpy(), batch.column("d").to_numpy()
            wanted = []
            for runs in batch.column("runs").to_pylist():
                spans = np.array([x["span"] for x in runs], np.int64)
                first, count = spans >> 16, spans & 0xFFFF
                at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
                order = np.argsort(at)
                wanted.append((at[order], np.repeat(np.array([x["a"] for x in runs], np.int64), count)[order]))
            for rows, firsts, sizes, words in _slices(batch, s):
                hasher.load(words)
                out, begin = [], 0
                for row, place, size in zip(rows, firsts, sizes, strict=True):
                    at, a = wanted[row]
                    lo, hi = np.searchsorted(at, [place, place + max(0, size - s.words + 1)])
                    start = at[lo:hi] - place + begin
                    out.append((np.full(hi - lo, row), at[lo:hi], a[lo:hi], hasher.runs(start, start + s.words)))
                    begin += size
                row, at, a, w = map(np.concatenate, zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(ids[row]), "d": pa.array(d[row]), "a": pa.array(a), "w": _signed(w), "at": pa.array(at)})

    return texts.select("row", "d", "text", "runs").mapInArrow(run, "row long, d long, a long, w long, at long")


def merged(spans: list[int], s: Settings) -> list[tuple[int, int]]:
    """Maximal runs of words, from and to, that the windows of the spans cover."""
    out: list[tuple[int, int]] = []
    for first, count in sorted((x >> 16, x & 0xFFFF) for x in spans):
        stop = first + count + s.words - 1
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((first, stop))
    return out


def kept(texts: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans of words) and kept (the other words, joined by one space) of every row."""
    spans_of = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                rows = batch.slice(start, 128)
                n_words, n_removed, removed, left = [], [], [], []
                for text, spans in zip(rows.column("text"), rows.column("spans").to_pylist(), strict=True):
                    cut = merged(spans or [], s)
                    n, parts = 0, []
                    for words in words_of(text.as_py() or b""):
                        last = 0
                        for lo, hi in cut:
                            lo, hi = max(lo - n, 0), min(hi - n, len(words))
                            if lo < hi:
                                parts += words[last:lo]
                                last = hi
                        parts += words[last:]
                        n += len(words)
                    n_words.append(n)
                    n_removed.append(sum(hi - lo for lo, hi in cut))
                    removed.append([{"start": lo, "stop": hi} for lo, hi in cut])
                    left.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, spans_of),
                     pa.array(left, pa.binary())], names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return texts.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, removed array<struct<start: long, stop: long>>, kept binary").withColumn(
        "kept", F.col("kept").cast("string"))


def without_repeats(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans of words) and kept (text) of every row of docs.

    A word goes if a window of `words` words covers it whose words also stand in a row of smaller doc_id. Seeds are winnowed anchors that
    two rows share. A seed is extended both ways by all words of the windows that chose it; where the whole run stands in a row of smaller
    doc_id, all its windows do. Of the other runs one for each distinct run is looked at window by window. Windows that overlap or touch make one maximal
    repeat. Every step groups by hash with a least doc_id, so no pairs are formed, however many rows share a passage.

    Null and empty texts have no words. Rows without a doc_id count as larger than all others, and, like rows of one doc_id, not as smaller than each
    other. An empty table gives no rows; other columns are not looked at.
    """
    texts = numbered(docs)
    runs = written(anchors(texts, s), "anchors")
    # What is summed by hash is written before it is joined: then both sides of the join are read as they are, and a hot hash is split at run time.
    shared = written(runs.groupBy("a").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo < hi").select("a"), "shared")
    seeded = written(runs.join(shared, "a", "left_semi"), "seeded")
    same = written(seeded.groupBy("a", "r").agg(F.min("d").alias("first"), F.max("d").alias("last")), "same")
    mixed = written(same.groupBy("a").agg((F.min("first") < F.max("first")).alias("mixed")), "mixed")
    known = written(same.join(mixed, "a").filter("first < last OR mixed"), "known")
    placed = written(
        seeded.join(known.select("a", "r", "first", "mixed"), ["a", "r"]).filter("first < d OR mixed").select(
            "row", "span", "a", (F.col("first") < F.col("d")).alias("covered")), "runs")
    part = F.shiftright("row", 33).alias("part")
    open_runs = placed.filter("NOT covered").groupBy("row").agg(F.collect_list(F.struct("span", "a")).alias("runs")).select(part, "row", "runs")
    found = written(windows(texts.join(open_runs.hint("shuffle_hash"), ["part", "row"]), s), "windows")
    firsts = written(found.groupBy("a", "w").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("lo < hi").select("a", "w", "lo"), "firsts")
    single = found.join(firsts, ["a", "w"]).filter("lo < d").select("row", F.shiftleft("at", 16).bitwiseOR(F.lit(1)).alias("span"))
    spans = placed.filter("covered").select("row", "span").unionByName(single).groupBy("row").agg(
        F.collect_list("span").alias("spans")).select(part, "row", "spans")
    return kept(texts.join(spans.hint("shuffle_hash"), ["part", "row"], "left"), s)
