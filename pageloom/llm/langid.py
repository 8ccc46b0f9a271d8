"""Language identification by partial matching: byte context trees, escape probabilities, exact code lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from pageloom.llm.base import id_and_text, quoted, small_batches, worker_state

ORDER = 3  # bytes of context
PAD = b"\n" * ORDER  # what stands before the first byte of a text
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from; a null id is not held out and not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def four_grams(text: str) -> np.ndarray:
    """For each byte of the lower-cased text, the byte and its context as one number."""
    b = np.frombuffer(PAD + text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


class PpmModel:
    """Frozen counts of one language: contexts of 0 to 3 bytes, escape by method C, order -1 uniform.

    A byte seen n times in a context with N bytes of d kinds costs -log2(n / (N + d)); an unseen one costs
    -log2(d / (N + d)) plus its cost in the context that is one byte shorter. A context is in the tree if it was seen twice.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(ORDER + 1):
            mask = np.uint32(0xFFFFFFFF >> (8 * (ORDER - order)))
            grams, back = np.unique(codes & mask, return_inverse=True)
            n = np.bincount(back, weights=counts, minlength=len(grams))
            contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
            total, kinds = np.bincount(of, weights=n), np.bincount(of).astype(float)
            kept = total >= 2
            seen = kept[of]
            self.levels.append((
                mask, grams[seen], -np.log2(n[seen] / (total + kinds)[of[seen]]),
                contexts[kept], -np.log2(kinds[kept] / (total + kinds)[kept]),
            ))

    def bits(self, codes: np.ndarray) -> np.ndarray:
        cost = np.full(len(codes), 8.0)
        for mask, grams, direct, contexts, escape in self.levels:
            if len(grams) == 0:
                continue
            gram = codes & mask
            context = gram >> np.uint32(8)
            at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
            up = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            cost = np.where(grams[at] == gram, direct[at], np.where(contexts[up] == context, escape[up] + cost, cost))
        return cost


class Scorer:
    """Code lengths of whole texts under all languages at once.

    The cost of a byte depends on four bytes, that is on two pairs of bytes. The costs of common pairs are kept in
    one table (pairs x pairs x languages), filled when first needed; the rest is worked out for each distinct code.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], pairs: int = 1200):
        self.languages = sorted(counts)
        self.models = [PpmModel(*counts[name]) for name in self.languages]
        seen = np.zeros(1 << 16)
        for codes, n in counts.values():
            seen += np.bincount(codes & np.uint32(0xFFFF), weights=n, minlength=1 << 16)
        common = np.argsort(-seen, kind="stable")[:pairs]
        common = common[seen[common] > 0].astype(np.uint32)
        self.pair = np.zeros(1 << 16, np.uint32)
        self.pair[common] = np.arange(1, len(common) + 1)
        self.bytes_of = np.concatenate([np.zeros(1, np.uint32), common])
        self.width = len(common) + 1
        self.cost = np.full((self.width * self.width, len(self.languages)), np.nan, np.float32)

    def _exact(self, codes: np.ndarray) -> np.ndarray:
        return np.stack([m.bits(codes) for m in self.models], axis=1).astype(np.float32)

    def _positions(self, b: np.ndarray) -> np.ndarray:
        """Costs of the bytes from the fourth on."""
        ids = self.pair[(b[:-1].astype(np.uint32) << 8) | b[1:]]
        at = ids[:-2] * np.uint32(self.width) + ids[2:]
        cost = self.cost[at]
        todo = np.flatnonzero(np.isnan(cost[:, 0]))
        if len(todo):
            code = (b[todo].astype(np.uint32) << 24) | (b[todo + 1].astype(np.uint32) << 16) | (b[todo + 2].astype(np.uint32) << 8) | b[todo + 3]
            codes, back = np.unique(code, return_inverse=True)
            exact = self._exact(codes)
            cost[todo] = exact[back]
            first, second = self.pair[codes >> np.uint32(16)], self.pair[codes & np.uint32(0xFFFF)]
            known = (first > 0) & (second > 0)
            self.cost[first[known] * np.uint32(self.width) + second[known]] = exact[known]
        return cost

    def code_lengths(self, texts: list[str], step: int = 1 << 18) -> np.ndarray:
        """Bits of each text (rows) under each language (columns), and in the last column its bytes."""
        out = np.zeros((len(texts), len(self.languages) + 1))
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        out[:, -1] = [len(r) for r in raw]
        group, size = [], 0
        for k, r in enumerate(raw):
            if len(r) > step:  # windows of one long text overlap by the context
                padded = np.frombuffer(PAD + r, np.uint8)
                for start in range(0, len(r), step):
                    out[k, :-1] += self._positions(padded[start:start + step + ORDER]).sum(axis=0, dtype=np.float64)
            elif r:
                group.append(k)
                size += len(r)
            if group and (size > step or k == len(raw) - 1):
                self._group(raw, group, out)
                group, size = [], 0
        if group:
            self._group(raw, group, out)
        return out

    def _group(self, raw: list[bytes], group: list[int], out: np.ndarray) -> None:
        cost = self._positions(np.frombuffer(b"".join(PAD + raw[k] for k in group), np.uint8))
        lengths = np.array([len(raw[k]) for k in group])
        starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
        edges = np.stack([starts, starts + lengths], axis=1).ravel()[:-1]  # bytes of a text, then those of the padding
        out[group, :-1] = np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[::2]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its share of the likelihood (equal priors), and bits a byte; `und` without a letter."""
        names, scores, rates = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        at = [k for k, t in enumerate(texts) if t and LETTER.search(t)] if self.languages else []
        lengths = self.code_lengths([texts[k] for k in at])
        for k, row in zip(at, lengths, strict=True):
            bits = row[:-1]
            best = int(bits.argmin())
            names[k] = self.languages[best]
            scores[k] = float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
            rates[k] = float(bits[best] / row[-1])
        return names, scores, rates


def train(docs: DataFrame, documents_per_language: int = 400) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Counts of bytes in context by language, from about `documents_per_language` labelled documents of each.

    The documents are those whose hashed id is lowest (twice the number at most), never held-out ones; their whole
    texts count. Rows without id, text or language are not learned from. What reaches the driver are counts of distinct four-byte codes.
    """
    rows = docs.select(
        F.col(quoted("doc_id")).cast("long").alias("doc_id"), F.col(quoted("text")).cast("string").alias("text"),
        F.col(quoted("lang")).cast("string").alias("lang"),
    ).filter("doc_id is not null and text is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    place = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    share = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, documents_per_language / n))))
    sample = rows.filter(place < F.element_at(share, F.col("lang"))).select("lang", "text").limit(2 * documents_per_language * len(sizes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(four_grams(text))
            for lang, parts in by_lang.items():
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(codes), pa.string()), "code": codes.astype(np.int64), "n": n.astype(np.int64)})

    counted = sample.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    langs = counted.column("lang").to_numpy()
    codes, n = counted.column("code").to_numpy().astype(np.uint32), counted.column("n").to_numpy().astype(float)
    out = {}
    for lang in sorted(sizes):
        own = np.flatnonzero(langs == lang)
        own = own[np.argsort(codes[own])]
        if len(own):
            out[lang] = (codes[own], n[own])
    return out


def _shared(docs: DataFrame, counts):
    """The counts go to each executor once; they are bounded by the training sample."""
    held = docs.sparkSession.sparkContext.broadcast(counts)
    name = f"{docs.sparkSession.sparkContext.applicationId}-{held._jbroadcast.id()}"
    return lambda: worker_state(("scorer", name), lambda: Scorer(held.value))


def identify(docs: DataFrame, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """One row for each document: doc_id, lang_pred, score, bits_per_byte, from its whole text alone.

    Null texts and texts without a letter give `und` with score 0, as does an empty training table. Equal code lengths give
    the language that comes first by name. Repeated rows are judged each for itself; other columns are ignored.
    """
    scorer = _shared(docs, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, scores, rates = scorer().predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(scores, pa.float64()), "bits_per_byte": pa.array(rates, pa.float64())})

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def keep_known(
    docs: DataFrame, counts: dict[str, tuple[np.ndarray, np.ndarray]], max_bits_per_byte: float = 5.5,
    languages: set[str] | None = None,
) -> DataFrame:
    """The documents in a learned language (of `languages`, if given), with all their columns.

    Rejected are `und` and texts that no model codes in fewer than `max_bits_per_byte`: they are in no language known here.
    """
    small_batches(docs)
    scorer, at = _shared(docs, counts), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, _, rates = scorer().predict(part.column(at).to_pylist())
                yield part.filter(pa.array([
                    n != UNKNOWN and r <= max_bits_per_byte and (languages is None or n in languages)
                    for n, r in zip(names, rates, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
