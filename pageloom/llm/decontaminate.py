"""Benchmark decontamination: items cut into more pieces than errors are allowed, exact hits of enough pieces, Myers' distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageloom.llm.base import id_and_text, quoted, small_batches, worker_state


def normal(text: str | None) -> str:
    """Lower case, one space between words."""
    return " ".join((text or "").lower().split())


def budget(length: int, rate: float, piece: int) -> int:
    """Errors allowed: a share of the length, but so few that no piece is shorter than `piece`."""
    return max(0, min(int(rate * length), length // piece - 1))


def pieces(text: str, number: int) -> list[tuple[int, str]]:
    """So many pieces of nearly equal length, with their places."""
    cuts = [k * len(text) // number for k in range(number + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(masks: dict[str, int], length: int, text: str, errors: int) -> tuple[int, int] | None:
    """Least distance of the pattern to any part of the text, and where that part ends; None if it is over `errors`.

    One column of the edit matrix is two bit vectors of the pattern's length. The first of equal ends counts.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score, best = full, 0, length, None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        if score <= errors and (best is None or score < best[0]):
            best = (score, at + 1)
    return best


class Matcher:
    def __init__(self, items: list[tuple[int | None, str | None]], rate: float, piece: int):
        self.items, self.pieces = [], ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if not text:
                continue
            errors, masks = budget(len(text), rate, piece), {}
            for k, c in enumerate(text):
                masks[c] = masks.get(c, 0) | (1 << k)
            number = max(errors + 1, len(text) // piece)  # each error spoils one piece at most, the others stay as they are
            for offset, part in pieces(text, number):
                at.setdefault(part, []).append((len(self.items), offset + len(part) - 1))
            self.items.append((item_id, len(text), errors, masks, number - errors))
        for part, where in at.items():
            self.pieces.add_word(part, where)
        if at:
            self.pieces.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end of the passage) of every item found in the normal text: its best place, the first of equals."""
        if not self.items:
            return []
        begins: dict[int, list[int]] = {}  # where each item would begin by its hits
        for end, where in self.pieces.iter(text):
            for k, offset in where:
                begins.setdefault(k, []).append(end - offset)
        out = []
        for k, hits in begins.items():
            item_id, size, errors, masks, need = self.items[k]
            if len(hits) < need:
                continue
            hits.sort()
            # The pieces kept by a passage are shifted against one another by `errors` places at most.
            spans: list[list[int]] = []
            for first, last in zip(hits, hits[need - 1:], strict=False):
                if last - first <= errors:
                    start, stop = max(0, first - errors), last + size + errors
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(stop, spans[-1][1])
                    else:
                        spans.append([start, stop])
            best = None
            for start, stop in spans:
                hit = myers(masks, size, text[start:stop], errors)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], start + hit[1])
                if best and best[0] == 0:
                    break
            if best:
                out.append((item_id, *best))
        return sorted(out, key=lambda x: (x[0] is None, x[0], x[1]))


def blocks(benchmark: DataFrame, block_chars: int) -> list[list[tuple[int | None, str | None]]]:
    """The items in blocks of about `block_chars` characters; each is sent to the executors on its own."""
    items = benchmark.select(F.col(quoted("item_id")).cast("long").alias("item_id"), F.col(quoted("text")).cast("string").alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    return [sorted(map(tuple, items.filter(own == k).collect()), key=str) for k in range(n)]


def _shared(df: DataFrame, items: list, rate: float, piece: int):
    held = df.sparkSession.sparkContext.broadcast(items)
    name = f"{df.sparkSession.sparkContext.applicationId}-{held._jbroadcast.id()}"
    return lambda: worker_state(("matcher", name, rate, piece), lambda: Matcher(held.value, rate, piece))


FOUND = "doc_id long, item_id long, distance long, end long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.12, piece: int = 7, block_chars: int = 4_000_000
) -> DataFrame:
    """One row for each document and benchmark item that it holds up to the error budget: doc_id, item_id, distance, end.

    Texts are compared in lower case with single spaces; `end` is a place in that form. An item of n characters may differ by
    `rate * n` edits; only items of less than about 45 characters by fewer, as pieces keep `piece` characters, and the shortest must occur exactly.
    An edit spoils one piece at most, so a passage within the budget holds all others unchanged and nearly in place, and none is missed.

    Null and empty items are in no document, null and empty documents hold no item. Repeated documents give their rows each; items
    with equal texts are all named. Documents are read once for each block of `block_chars` characters of items. Other columns are ignored.
    """

    def scan(items: list) -> DataFrame:
        matcher = _shared(docs, items, rate, piece)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                    rows.extend((doc_id, *hit) for hit in matcher().find(normal(text.as_py())))
                names = ("doc_id", "item_id", "distance", "end")
                yield pa.RecordBatch.from_pydict({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)})

        return id_and_text(docs).mapInArrow(run, FOUND)

    found = [scan(items) for items in blocks(benchmark, block_chars)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], FOUND)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, rate: float = 0.12, piece: int = 7, block_chars: int = 4_000_000
) -> DataFrame:
    """The documents that hold no item, with all their columns; one pass over the documents for each block of items."""
    small_batches(docs)
    at = docs.columns.index("text")

    def without(df: DataFrame, items: list) -> DataFrame:
        matcher = _shared(df, items, rate, piece)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not matcher().find(normal(t.as_py())) for t in batch.column(at)], pa.bool_()))

        return df.mapInArrow(run, df.schema)

    return reduce(without, blocks(benchmark, block_chars), docs)
