"""Importance resampling toward a target: hashed n-gram buckets, log ratios as gains, a perturbed draw of the best scores."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pageloom.llm.base import small_batches, written


@dataclass(frozen=True)
class Settings:
    shortest: int = 1        # words of a feature, from and to
    longest: int = 1
    buckets: int = 10_000    # bounds what is collected and broadcast
    seed: int = 2024
    least_words: int = 20    # documents with fewer are never drawn
    percent: int = 10        # of the others are drawn


# A-Z become a-z; digits, a-z and all bytes of other characters stay; the rest separates words.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, some hundred thousand at a time, whatever its length."""
    text = text.translate(BYTES)
    start = 0
    while start < len(text):
        stop = len(text) if start + size >= len(text) else text.find(b" ", start + size)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop].split()
        start = stop


def features(text: bytes, shortest: int, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """(number of words, their n-grams) for each part of a text; n-grams across two parts come with the later one."""
    tail: list[bytes] = []
    for words in words_of(text):
        run, old = tail + words, len(tail)
        grams = []
        for n in range(shortest, longest + 1):
            first = max(0, old - n + 1)
            grams += words if n == 1 else [b" ".join(run[i:i + n]) for i in range(first, len(run) - n + 1)]
        yield len(words), grams
        tail = run[max(0, len(run) - longest + 1):]


class SlotTable:
    """The n-grams of one batch in an open-addressed table: places by xxhash64, equal keys settled by comparing bytes.

    `slot` names the place of each occurrence; `used` are the taken places, `bucket` and `count` what stands in them.
    """

    def __init__(self, grams: list[bytes], buckets: int):
        n = len(grams)
        size = 1 << max(4, (2 * n).bit_length())
        self.grams = grams
        self.lengths = np.fromiter(map(len, grams), np.int64, n)
        self.starts = np.cumsum(self.lengths) - self.lengths
        joined = b"".join(grams) + bytes(8)
        self.lanes = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
        keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, n)
        self.slot = np.empty(n, np.int64)
        owner = np.full(size, -1, np.int64)
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        todo = np.arange(n)
        while len(todo):
            free = owner[at] < 0
            owner[at[free]] = todo[free]
            held = owner[at]
            same = keys[held] == keys[todo]
            same[same] = self._equal(held[same], todo[same])
            self.slot[todo[same]] = at[same]
            todo, at = todo[~same], (at[~same] + 1) & (size - 1)
        self.used = np.flatnonzero(owner >= 0)
        self.bucket, self.count = np.zeros(size, np.int64), np.bincount(self.slot, minlength=size)
        self.bucket[self.used] = [zlib.crc32(grams[i]) % buckets for i in owner[self.used].tolist()]

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether n-grams a and b have the same bytes: eight at a time, long ones one by one."""
        equal = (a == b) | (self.lengths[a] == self.lengths[b])
        left = np.flatnonzero(equal & (a != b))
        lengths = self.lengths[a]
        for i in left[lengths[left] > 64].tolist():
            equal[i] = self.grams[a[i]] == self.grams[b[i]]
        left, at = left[lengths[left] <= 64], 0
        while len(left):
            spare = np.clip(at + 8 - lengths[left], 0, 8)
            mask = np.where(spare == 8, 0, np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.minimum(spare, 7)).astype(np.uint64)).astype(np.uint64)
            differ = ((self.lanes[self.starts[a[left]] + at] ^ self.lanes[self.starts[b[left]] + at]) & mask) != 0
            equal[left[differ]] = False
            at += 8
            left = left[~differ & (lengths[left] > at)]
        return equal


def _batches(rows: pa.RecordBatch, settings: Settings, most: int = 1 << 17) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(row of each run, its n-grams' number, all n-grams) for about `most` n-grams at a time; a long text fills several."""
    owners, sizes, grams = [], [], []
    for row, text in enumerate(rows.column("text")):
        for _, found in features(text.as_py() or b"", settings.shortest, settings.longest):
            owners.append(row)
            sizes.append(len(found))
            grams += found
            if len(grams) >= most:
                yield owners, sizes, grams
                owners, sizes, grams = [], [], []
    if grams:
        yield owners, sizes, grams


def _texts(df: DataFrame, *columns) -> DataFrame:
    small_batches(df)
    return df.select(*columns, F.col("text").cast("string").cast("binary").alias("text"))


def bucket_counts(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """bucket and n, how many n-grams of all texts fall into it; a task sends one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for _, _, grams in _batches(batch, settings):
                table = SlotTable(grams, settings.buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(total[held], pa.int64())})

    return _texts(df).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> list[int]:
    """Of each bucket, a thousand times the log ratio of its smoothed shares in target and docs. At most `buckets` rows are collected."""
    own, wanted = [0] * settings.buckets, [0] * settings.buckets
    for into, df in ((own, docs), (wanted, target)):
        for bucket, n in bucket_counts(df, settings).collect():
            into[bucket] = n
    all_own, all_wanted = sum(own) + settings.buckets, sum(wanted) + settings.buckets
    return [math.floor(1000 * math.log((t + 1) * all_own / ((s + 1) * all_wanted))) for s, t in zip(own, wanted, strict=True)]


def weighted(docs: DataFrame, gain: list[int], settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of its features' gains, of every row; texts stay in their tasks."""
    held = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for owners, sizes, grams in _batches(batch, settings):
                table = SlotTable(grams, settings.buckets)
                sums = np.concatenate([[0], np.cumsum(held.value[table.bucket][table.slot])])
                stops = np.cumsum(sizes)
                np.add.at(weight, owners, sums[stops] - sums[stops - sizes])
                np.add.at(n_features, owners, sizes)
            n_words = n_features if settings.shortest == settings.longest == 1 else np.array(
                [sum(map(len, words_of(t.as_py() or b""))) for t in batch.column("text")], np.int64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words), "n_features": pa.array(n_features), "weight": pa.array(weight)})

    return _texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, share: int) -> DataFrame:
    """`rank` 1, 2, 3 … by falling score, then rising doc_id, of the first `share` percent of the rows; null for the others.

    Rows are dealt by ranges of (score, doc_id) and numbered within them; the ranges' sizes, one number each, give the bases.
    """
    spark = scored.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = written(
        scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "resample-order")
    place = F.col("_place")
    sizes = sorted(map(tuple, placed.groupBy(F.shiftright(place, 33)).count().collect()))
    bases, total = [], 0
    for part, n in sizes:
        bases.append((part, total))
        total += n
    base = spark.createDataFrame(bases, "_part long, _base long")
    rank = F.col("_base") + place.bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("_part", F.shiftright(place, 33)).join(base, "_part", "left").withColumn(
        "rank", F.when(rank <= total * share // 100, rank)).drop("_part", "_place", "_base")


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row of docs as doc_id, n_words, n_features, weight, score and rank (null if it is not drawn).

    The score is the weight plus noise that follows from seed and doc_id alone, so a repeated run draws the same documents, and
    documents are drawn without replacement by their importance. Null and empty texts have no features and weight 0; a null doc_id
    has the noise of the empty id and stands behind equal scores; repeated rows are rows of their own. Empty tables: no rows; without
    target texts the gains are those of uniform target buckets. Other columns are not looked at.
    """
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(u)))
    scored = written(
        weighted(docs, gains(docs, target, settings), settings).withColumn("score", (F.col("weight") + noise).cast("long")), "resample-scores")
    may = F.col("n_words") >= settings.least_words
    rest = scored.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.filter(may), settings.percent).unionByName(rest)
