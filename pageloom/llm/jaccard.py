"""Near copies by word shingles: MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pageloom.llm.base import forget_state, quoted, small_batches, written
from pageloom.llm.components import components

WORDS = re.compile(r"\w+")
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
CHUNKS = ((0, 16), (16, 32), (32, 64), (64, 128))  # MinHash values are compared piece by piece
FACTORS = np.random.default_rng(20240607).integers(1 << 40, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Words in a shingle, least similarity, the chance below which a pair is dropped, sets in a block and shingles in it, on average and at most."""

    size: int = 5
    threshold: Fraction = Fraction(4, 5)
    tolerance: float = 1e-6
    block: int = 1024
    block_shingles: int = 300_000


class Shingler:
    """Sets of hashed word shingles; hashes of words are remembered."""

    def __init__(self, size: int):
        self.size, self.words = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text of fewer words is one shingle, a text without words has none."""
        words = WORDS.findall(text.lower()) if text else []
        if not words:
            return np.empty(0, np.uint64)
        if len(self.words) > 400_000:
            self.words.clear()
        known = self.words
        new = {w for w in words if w not in known}
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        h = np.fromiter((known[w] for w in words), np.uint64, len(words))
        n = min(self.size, len(words))
        out = h[:len(h) - n + 1].copy()
        for k in range(1, n):
            out = (out ^ (out >> np.uint64(29))) * MIX + h[k:len(h) - n + 1 + k]
        out ^= out >> np.uint64(32)
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least value of each of the hash functions."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(shingles), 2048):
        low = np.minimum(low, ((shingles[start:start + 2048, None] * FACTORS) >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return low.astype(np.uint16)


def least_matches(threshold: Fraction, tolerance: float) -> list[int]:
    """For each chunk's end n: the least number m of equal values with P(similarity >= threshold | m of n equal) >= tolerance.

    With a uniform prior the similarity given m of n is Beta(m + 1, n - m + 1), whose upper tail is that of a binomial.
    """
    t, out = float(threshold), []
    for _, n in CHUNKS:
        below, m = 0.0, -1
        while m < n and below < tolerance:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def prune(signatures: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int], step: int = 1 << 18) -> np.ndarray:
    """Indices of the pairs that no chunk of values rules out."""
    out = []
    for start in range(0, len(a), step):
        left = np.arange(start, min(len(a), start + step))
        equal = np.zeros(len(left), np.int32)
        for (lo, hi), need in zip(CHUNKS, least, strict=True):
            equal += (signatures[a[left], lo:hi] == signatures[b[left], lo:hi]).sum(axis=1, dtype=np.int32)
            alive = equal >= need
            left, equal = left[alive], equal[alive]
        out.append(left)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_shingles(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact size of the intersection for each pair, met one by one."""
    out = np.empty(len(a), np.int64)
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        out[k] = np.count_nonzero(y[at] == x)
    return out


def overlaps(sets: list[np.ndarray], step: int = 1 << 20) -> np.ndarray:
    """Sizes of the intersections of all sets of a block with each other, for i < j.

    Shingles of many sets are counted by a matrix product, the others by their lists of sets, some at a time: besides the matrix, memory follows the shingles.
    """
    n = len(sets)
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])
    _, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    total = np.zeros((n, n), np.float32)
    dense = np.flatnonzero(counts > 24)
    number = np.full(len(counts), -1)
    number[dense] = np.arange(len(dense))
    own = number[columns]
    for start in range(0, len(dense), 1024):
        here = (own >= start) & (own < start + 1024)
        x = np.zeros((n, min(1024, len(dense) - start)), np.float32)
        x[rows[here], own[here] - start] = 1
        total += x @ x.T
    flat = total.reshape(-1)
    for d in range(2, 25):
        i, j = np.triu_indices(d, 1)
        first = starts[counts == d]
        for k in range(0, len(first), max(1, step // len(i))):
            members = rows[first[k:k + max(1, step // len(i)), None] + np.arange(d)]
            np.add.at(flat, members[:, i].ravel().astype(np.int64) * n + members[:, j].ravel(), np.float32(1))
    return total


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each index's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


SMALL = 48


def group_bounds(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, int)
    return starts, np.diff(np.append(starts, len(group)))


def group_pairs(group: np.ndarray, side: np.ndarray, within: np.ndarray, small: int = SMALL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows in one group, for rows in order of their groups.

    A group is one block (`within`: every pair) or two (pairs with one row of either side). Small groups are met together, one distance
    between rows at a time; the pairs of large ones come in slices, all of one group after the other.
    """
    starts, sizes = group_bounds(group)
    large = np.repeat(sizes > small, sizes)
    for d in range(1, min(small, int(sizes[sizes <= small].max(initial=0)))):
        a = np.flatnonzero((group[:-d] == group[d:]) & ~large[:-d])
        a = a[within[a] | (side[a] != side[a + d])]
        if len(a):
            yield a, a + d
    for start, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        for k in range(0, n, 256):
            i, j = np.nonzero(np.arange(k, min(n, k + 256))[:, None] < np.arange(n)[None, :])
            a, b = start + k + i, start + j
            keep = within[a] | (side[a] != side[b])
            yield a[keep], b[keep]


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables that end where a group ends; rows come in order of `names`. A group is at most two blocks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0))
        if held:
            last = tuple(held[-1].column(n)[-1].as_py() for n in names)
            if last != tuple(batch.column(n)[0].as_py() for n in names):
                yield pa.Table.from_batches(held)
                held = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def numbered(table: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    columns = [table.column(n).to_numpy() for n in names]
    new = np.any([np.concatenate([[True], c[1:] != c[:-1]]) for c in columns], axis=0)
    return np.cumsum(new)


def in_blocks(members: DataFrame, group: str, size: Column, block: int) -> DataFrame:
    """Each row once for each pair of blocks (i, j) of its group that its own block is in: rows of a group of n are sent n / block times.

    All pairs of the group meet in exactly one (group, i, j); none holds more than two blocks, however large the group is.
    """
    n = F.greatest(F.ceil(size / block), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int")
    return (
        members.withColumn("_blocks", n).withColumn("side", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("i", F.least("side", "_other")).withColumn("j", F.greatest("side", "_other")).drop("_blocks", "_other")
        .repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", "key")
    )


def _columns(docs: DataFrame) -> DataFrame:
    small_batches(docs)
    text = F.col(quoted("text")).cast("string")
    return docs.select(F.col(quoted("doc_id")).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))


def marked(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, tie (hash of the text), key (128-bit hash of the shingle set) and signature of each document; the last two are null without words."""
    rows = _columns(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        shingler = Shingler(settings.size)
        for batch in batches:
            keys, signatures = [], []
            for text in batch.column("text"):
                shingles = shingler(text.as_py())
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "tie": batch.column("tie"),
                "key": pa.array(keys, pa.binary()), "signature": pa.array(signatures, pa.binary())})

    return rows.mapInArrow(run, "doc_id long, tie long, key binary, signature binary")


def similar_by_sketch(classes: DataFrame, settings: Settings) -> DataFrame:
    """Edges (a, b) between shingle sets that the sketches hold to be similar: enough of them to join every group, not all its pairs.

    Sets meet where one of 32 bands of four MinHash values is equal; a pair of similarity 0.8 meets with all but a chance of 5e-8.
    """
    width = 2 * ROWS
    buckets = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("signature"), b * width + 1, F.lit(width))))
    rows = classes.select("key", F.explode(buckets).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    met = rows.join(sizes, "bucket").join(classes.select("key", "signature"), "key")
    least, names = least_matches(settings.threshold, settings.tolerance), ("bucket", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for rows in whole_groups(batches, names):
            keys, side = rows.column("key").combine_chunks(), rows.column("side").to_numpy()
            signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
            within = rows.column("i").to_numpy() == rows.column("j").to_numpy()
            label = np.arange(len(keys))
            found_a, found_b = [], []
            for a, b in group_pairs(numbered(rows, names), side, within):
                good = prune(signatures, a, b, least)
                found_a.append(a[good])
                found_b.append(b[good])
            if found_a:
                label = roots(len(keys), np.concatenate(found_a), np.concatenate(found_b))
            moved = np.flatnonzero(label != np.arange(len(keys)))
            yield pa.RecordBatch.from_pydict({"a": keys.take(pa.array(moved)), "b": keys.take(pa.array(label[moved]))})

    return in_blocks(met, "bucket", F.col("n"), settings.block).mapInArrow(run, "a binary, b binary").distinct()


BITS = 1 << 25


def _place() -> Column:
    """Place in the bit map of the document in `doc_id` and `tie`."""
    return F.pmod(F.xxhash64("doc_id", "tie"), F.lit(BITS))


def bit_map(wanted: DataFrame) -> np.ndarray:
    """Which documents (doc_id, tie) may be among the wanted, in a map of fixed size (4 MB), whatever their number.

    It only saves shuffles: an exact join follows for all that it lets through. The fuller it is, the more it lets through.
    """
    filled = wanted.select((_place() + 1).alias("at")).groupBy(F.expr("bitmap_bucket_number(at)").alias("n")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits")).collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for r in filled:  # bucket n holds 32,768 places
        bits[(r["n"] - 1) * 4096:r["n"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def in_map(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def shingle_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(key, shingles) of the wanted sets (doc_id, tie, key), made again from the texts of these documents.

    Texts are not shuffled: the workers find the documents by the bit map, and what it lets through by chance has a key that the join drops.
    """
    held = docs.sparkSession.sparkContext.broadcast(bit_map(wanted))
    rows = _columns(docs).select(_place().alias("place"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        shingler = Shingler(settings.size)
        for batch in batches:
            some = np.flatnonzero(in_map(held.value, batch.column("place").to_numpy()))
            for start in range(0, len(some), 64):
                sets = [s for s in (shingler(batch.column("text")[k].as_py()) for k in some[start:start + 64].tolist()) if len(s)]
                raw = [s.tobytes() for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([xxhash.xxh3_128_digest(r) for r in raw], pa.binary()), "shingles": pa.array(raw, pa.binary())})

    made = rows.mapInArrow(run, "key binary, shingles binary")
    return made.join(wanted.select("key"), "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))


def verified(near: DataFrame, settings: Settings) -> DataFrame:
    """For each set of `near` (group, key, copies, signature, shingles) with a partner: key, links, other.

    `links` adds up the copies of the partners met in one pair of blocks, `other` is a set it is linked with, over others, there.
    """
    sized = near.withColumn("n_shingles", F.octet_length("shingles") / 8)
    groups = written(sized.groupBy("label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles_of_all")), "groups")
    # in blocks of so many sets, or fewer if these are long: either way a block has a bounded number of bytes on average
    sized = sized.drop("n_shingles").join(groups.select("label", F.greatest(
        F.col("n"), F.col("shingles_of_all") * settings.block / settings.block_shingles).alias("n")), "label")
    least, names, t = least_matches(settings.threshold, settings.tolerance), ("number", "i", "j"), settings.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for rows in whole_groups(batches, names):
            keys, side, copies = rows.column("key").combine_chunks(), rows.column("side").to_numpy(), rows.column("copies").to_numpy()
            signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
            within = rows.column("i").to_numpy() == rows.column("j").to_numpy()
            group = numbered(rows, names)
            starts, counts = group_bounds(group)
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for chunk in rows.column("shingles").chunks for s in chunk]
            sizes = np.array([len(s) for s in sets], np.int64)
            links, label = np.zeros(len(sets), np.int64), np.arange(len(sets))
            matrix, matrix_of = None, -1
            for x, y in group_pairs(group, side, within):
                good = prune(signatures, x, y, least)
                a, b = x[good], y[good]
                if len(a) == 0:
                    continue
                at = int(np.searchsorted(starts, a[0], side="right")) - 1
                low, n = int(starts[at]), int(counts[at])
                if n > SMALL and len(a) > 2 * n:
                    # one large group's pairs come together, so its matrix is made once
                    if matrix_of != at:
                        matrix, matrix_of = None, at
                        matrix = overlaps(sets[low:low + n])
                    common = matrix[a - low, b - low].astype(np.int64)
                else:
                    common = common_shingles(sets, a, b)
                real = common * t.denominator >= t.numerator * (sizes[a] + sizes[b] - common)
                a, b = a[real], b[real]
                links += np.bincount(a, copies[b], len(sets)).astype(np.int64) + np.bincount(b, copies[a], len(sets)).astype(np.int64)
                moved = np.flatnonzero(label != np.arange(len(label)))
                label = roots(len(sets), np.concatenate([a, moved]), np.concatenate([b, label[moved]]))
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict({
                "key": keys.take(pa.array(some)), "links": pa.array(links[some]), "other": keys.take(pa.array(label[some]))})

    rows = sized.withColumn("number", F.xxhash64("label"))
    return in_blocks(rows, "number", F.col("n"), settings.block).drop("label", "n").mapInArrow(run, "key binary, links long, other binary")


def near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each document: doc_id, tie, key, label, class_id, copies, n_links.

    Texts are lower-cased runs of letters, digits and underscores, five in a shingle. Documents with the same set of shingles are copies; two
    sets are linked if their Jaccard similarity is at least the threshold, worked out exactly. `class_id` is the least doc_id of all documents that
    links join, `label` the same as a key, `copies` the number of documents with the same set, `n_links` the number of other
    documents that this one is a copy of or linked with.

    Candidates meet in bands of MinHash values; a pair is dropped when, given the values compared so far, the chance that it reaches the threshold is
    below the tolerance. Pairs never leave a task: what comes out of a block are counts and edges that join its members.

    Texts of fewer words than a shingle are one shingle. Null and empty texts and texts without words have no set: they are never
    linked, and their class is their own doc_id. Repeated rows are copies of one another. A null doc_id stays null; a class without any id has a
    null class_id. Other columns are ignored; an empty table gives no rows.
    """
    marks = written(marked(docs, settings), "marks")
    classes = written(marks.filter("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_doc"), F.min(F.struct("doc_id", "tie")).alias("one"),
        F.first("signature").alias("signature")), "classes")
    coarse = components(similar_by_sketch(classes, settings)).withColumnRenamed("node", "key")
    near = written(coarse.join(classes.select("key", "copies", "signature", "one.doc_id", "one.tie"), "key"), "near")
    sets = shingle_sets(docs, near.select("doc_id", "tie", "key"), settings)
    found = written(verified(near.drop("doc_id", "tie").join(sets, "key"), settings), "links")
    linked = components(found.select(F.col("key").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "key")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    grouped = linked.join(links, "key").join(classes.select("key", "first_doc"), "key")
    firsts = grouped.groupBy("label").agg(F.min("first_doc").alias("class_doc"))
    grouped = grouped.join(firsts, "label").select("key", "label", "links", "class_doc")
    known = written(classes.select("key", "copies", "first_doc").join(grouped, "key", "left").select(
        "key", "copies", F.coalesce("label", "key").alias("label"),
        F.when(F.col("links").isNull(), F.col("first_doc")).otherwise(F.col("class_doc")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    return marks.select("doc_id", "tie", "key").join(known, "key", "left").select(
        "doc_id", "tie", "key", "label", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each class, with all its columns: the one with the least doc_id, then the least hash of its text.

    Documents without words are in no class and all stay. Of rows equal in doc_id and text one stays.
    """
    rows = near_copies(docs, settings).filter("label is not null").groupBy("label", "doc_id", "tie").agg(F.count("*").alias("n"))
    rows = written(rows, "rows")
    # written, so that the join deals out both sides and a large group's label can be split
    chosen = written(rows.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("one")), "chosen")
    others = rows.join(chosen, "label").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("tie") == F.col("one.tie")))).select(
            F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    repeated = rows.filter("n > 1").select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"))
    held = docs.sparkSession.sparkContext.broadcast(bit_map(
        others.unionAll(repeated).select(F.col("_id").alias("doc_id"), F.col("_tie").alias("tie"))))
    names = [quoted(c) for c in docs.columns]
    identity = (F.col(quoted("doc_id")).cast("long").alias("doc_id"), F.xxhash64(F.col(quoted("text")).cast("string")).alias("tie"))
    placed = docs.select(F.struct(*names).alias("row"), *identity).select("row", _place().alias("place"))

    def dealt(doubtful: bool) -> DataFrame:
        """The documents that may have to go, or all others; only the former are shuffled."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                some = in_map(held.value, batch.column("place").to_numpy()) == doubtful
                if some.any():
                    yield batch.select(["row"]).filter(pa.array(some))

        rows = placed.mapInArrow(run, placed.select("row").schema)
        return rows.select(*(F.col(f"row.{n}").alias(c) for n, c in zip(names, docs.columns, strict=True)))

    doubtful = dealt(True)
    whole = doubtful.select(F.struct(*names).alias("_row"), identity[0].alias("_doc"), identity[1].alias("_hash"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie"))
    kept = whole.join(others, same, "left_anti")
    if not repeated.isEmpty():
        kept = kept.join(repeated, same, "left_anti").unionAll(
            kept.join(repeated, same, "left_semi").dropDuplicates(["_doc", "_hash"]))
    kept = kept.select(*(F.col(f"_row.{n}").alias(c) for n, c in zip(names, docs.columns, strict=True)))
    return dealt(False).unionAll(kept)
