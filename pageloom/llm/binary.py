"""Token files: flat unsigned integers, 64-bit document offsets, bases of the parts by prefix sums."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from pageloom.llm.base import file_system, id_and_text, put, worker_state
from pageloom.llm.bpe import byte_characters


class ByteTokenizer:
    """The tokenizers library with a memory of pieces.

    The library splits a text into pieces by a fixed pattern and encodes each for itself; a piece alone is split no further. So a text
    is split here by the same pattern, and the library's model encodes each distinct piece once. That holds for texts of
    common characters, for which the pattern's Unicode classes are written out; any other text, and one with a special token, goes to the library whole.
    """

    COMMON = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
    PIECES = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\t-\r 0-9A-Za-zÀ-ÖØ-öø-ÿ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

    def __init__(self, raw: bytes, dtype: str, remembered: int = 500_000):
        self.library = Tokenizer.from_str(raw.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.code, self.remembered = {2: "H", 4: "I"}[np.dtype(dtype).itemsize], remembered
        self.bytes = byte_characters()
        spec = json.loads(raw)
        split = spec.get("pre_tokenizer") or {}
        self.by_pieces = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array(self.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece by the library's model; kept in one of two memories, of which the older one is dropped."""
        found = self.older.get(piece)
        if found is None:
            characters = "".join([self.bytes[b] for b in piece.encode()])
            found = array(self.code, [t.id for t in self.library.model.tokenize(characters)]).tobytes()
        if len(piece) <= 64:
            if len(self.recent) >= self.remembered:
                self.older, self.recent = self.recent, {}
            self.recent[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as the bytes of little-endian unsigned integers."""
        if not (self.by_pieces and self.COMMON.fullmatch(text)) or self.special.search(text):
            return self._library(text)
        known = self.recent.get
        return b"".join([known(p) or self._piece(p) for p in self.PIECES.findall(text)])


def tokenizer_of(raw: bytes, dtype: str) -> ByteTokenizer:
    return worker_state(("bytes", hash(raw), dtype), lambda: ByteTokenizer(zlib.decompress(raw), dtype))


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0) -> dict:
    """Write the ids of all documents, each with `end_id` behind it, in ascending doc_id order; returns the manifest.

    Part k holds a range of doc_ids in three files: `part-k.bin` (ids, little-endian unsigned 16-bit if the vocabulary allows, else
    32-bit), `part-k.idx` (unsigned 64-bit offsets of its documents within the part, one more than there are documents) and
    `part-k.ids` (doc_ids, Arrow). `manifest.json` names the parts and their bases, the prefix sums of their lengths.

    Null and empty texts are the end id alone. Null doc_ids come first; rows of one doc_id stand in order of their text's hash,
    and all are kept. A repeated task writes the same files again. An empty table gives a manifest without parts.
    """
    with open(tokenizer_file, "rb") as f:
        raw = f.read()
    size = Tokenizer.from_str(raw.decode()).get_vocab_size(with_added_tokens=True)
    dtype = "<u2" if max(size - 1, end_id) < 1 << 16 else "<u4"
    held = docs.sparkSession.sparkContext.broadcast(zlib.compress(raw))
    end = np.array([end_id], dtype).tobytes()
    file_system(path)[0].create_dir(file_system(path)[1], recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, context = tokenizer_of(held.value, dtype), TaskContext.get()
        part, attempt = context.partitionId(), f"{context.taskAttemptId()}.tmp"
        fs, folder = file_system(path)
        name, lengths, ids = f"{folder}/part-{part:06d}", [], []
        out = None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                out = out or fs.open_output_stream(f"{name}.bin.{attempt}")
                for text in rows.column("text"):
                    tokens = tokenizer.encode(text.as_py() or "")
                    out.write(tokens + end)
                    lengths.append((len(tokens) + len(end)) // len(end))
                ids.extend(rows.column("doc_id").to_pylist())
        if out is None:
            return
        out.close()
        fs.move(f"{name}.bin.{attempt}", f"{name}.bin")
        put(fs, f"{name}.idx", [np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes()], attempt)
        doc_ids = pa.record_batch({"doc_id": pa.array(ids, pa.int64())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, doc_ids.schema) as writer:
            writer.write_batch(doc_ids)
        put(fs, f"{name}.ids", [sink.getvalue()], attempt)
        yield pa.RecordBatch.from_pydict({"part": [part], "documents": [len(ids)], "tokens": [int(sum(lengths))]})

    rows = id_and_text(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")
    parts = sorted(map(tuple, ordered.mapInArrow(write, "part long, documents long, tokens long").collect()))
    bases = [0, *accumulate(tokens for _, _, tokens in parts)]
    manifest = {"dtype": dtype, "end_id": end_id, "tokens": bases[-1], "parts": [
        {"name": f"part-{part:06d}", "base": base, "documents": documents, "tokens": tokens}
        for (part, documents, tokens), base in zip(parts, bases, strict=False)]}
    fs, folder = file_system(path)
    put(fs, f"{folder}/manifest.json", [json.dumps(manifest).encode()], "tmp")
    return manifest


def mapped(fs: pa.fs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped if it is local or mounted, else read."""
    if isinstance(fs, pa.fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if fs.get_file_info(path).size else np.empty(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_parts(
    spark: SparkSession, path: str, columns: Callable[[list[np.ndarray]], dict[str, pa.Array]], schema: str
) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids of all documents before it), and what `columns` makes of the
    documents' ids (unsigned 32-bit arrays over the mapped file, about a million ids at a time)."""
    fs, folder = file_system(path)
    with fs.open_input_file(f"{folder}/manifest.json") as f:
        manifest = json.loads(f.read())
    parts, dtype = manifest["parts"], manifest["dtype"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(path)
        for part in (parts[k] for batch in batches for k in batch.column("id").to_pylist()):
            tokens = mapped(fs, f"{folder}/{part['name']}.bin", dtype)
            offsets = mapped(fs, f"{folder}/{part['name']}.idx", "<u8").astype(np.int64)
            with fs.open_input_file(f"{folder}/{part['name']}.ids") as f:
                doc_ids = pa.ipc.open_file(f).read_all().column("doc_id").combine_chunks()
            n, start = len(offsets) - 1, 0
            while start < n:
                stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + (1 << 20), side="right")) - 1)
                ids = np.asarray(tokens[offsets[start]:offsets[stop]]).astype("<u4")
                own = np.split(ids, offsets[start + 1:stop] - offsets[start])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": doc_ids.slice(start, stop - start), "start": pa.array(offsets[start:stop] + part["base"])} | columns(own))
                start = stop

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, f"doc_id long, start long, {schema}")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array<int>) of every document of the files."""
    return read_parts(spark, path, lambda own: {"ids": pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))}, "ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers, without moving the ids."""
    return read_parts(spark, path, lambda own: {
        "n_tokens": pa.array([len(x) for x in own], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())}, "n_tokens long, ids_crc32 long")
