"""BPE by automaton: merges compiled into a deterministic token automaton, encoding by its transitions, decoding by its labels."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from pageloom.llm.base import id_and_text, worker_state

START = 0
DEAD = -1
BASE = -1  # merge number of tokens that no merge makes


class TokenAutomaton:
    """Deterministic automaton over tokens that accepts exactly the tokenizations BPE makes.

    It starts as one state with a loop for each base symbol, which accepts every string of symbols. Each merge (u, v) -> t is a
    gadget put on top, in order of rank: every path `-u-> s -v-> r` gains the arc `-t-> r`, and `s`, as far as it is
    reached by u, loses its v arc. For that `s` is split where other arcs lead to it as well.

    The arc of a token leads to the same state from wherever it starts, so a state is what tokens it blocks. A split state keeps
    its own blocks and a link to the state it was split from, as that was at the time; arcs are not copied. `step` finds a
    transition by these and keeps it in the transition table.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.labels = {i: t for t, i in vocab.items()}
        self.parts: dict[int, tuple[int, int]] = {}  # token: its left part, its merge number
        self.blocked: list[dict[int, int]] = [{}]  # of each state: token: number of the merge that blocked it
        self.origin: list[tuple[int, int] | None] = [None]  # state it was split from, and when
        self.target: dict[int, int] = dict.fromkeys(vocab.values(), DEAD)
        made = {vocab[u + v] for u, v in merges}
        if len(made) != len(merges):
            raise ValueError("two merges make the same token")
        refs = [1]
        for token in vocab.values():
            if token not in made:
                self.target[token] = START
                refs[START] += 1
        for number, (left, right) in enumerate(merges):
            self._gadget(vocab[left], vocab[right], vocab[left + right], number, refs)
        self.table: list[dict[int, int]] = [{} for _ in self.blocked]
        self.prefixes = dict.fromkeys((t[:k] for t in vocab for k in range(1, len(t))), -1) | vocab

    def _gadget(self, u: int, v: int, t: int, number: int, refs: list[int]) -> None:
        middle = self.target[u]
        if middle == DEAD or self.target[v] == DEAD or not self._has(middle, v, number):
            return  # no path of u and v is left, so t never occurs
        self.parts[t] = (u, number)
        self.target[t] = self.target[v]
        refs[self.target[t]] += 1
        if refs[middle] > 1:
            refs[middle] -= 1
            self.blocked.append({v: number})
            self.origin.append((middle, number))
            refs.append(1)
            self.target[u] = len(self.blocked) - 1
        else:
            self.blocked[middle][v] = number

    def _blocked_at(self, state: int, token: int) -> int | None:
        """Number of the merge that took the token's arc from the state."""
        until = None
        while True:
            number = self.blocked[state].get(token)
            if number is not None and (until is None or number < until):
                return number
            if self.origin[state] is None:
                return None
            state, when = self.origin[state]
            until = when if until is None else min(until, when)

    def _has(self, state: int, token: int, before: int) -> bool:
        """Whether the state has the token's arc before the given merge: its own, and its left parts' when it was made."""
        number = self._blocked_at(state, token)
        if number is not None and number < before:
            return False
        while token in self.parts:
            token, made = self.parts[token]
            number = self._blocked_at(state, token)
            if number is not None and number <= made:
                return False
        return True

    def step(self, state: int, token: int) -> int:
        """The state the token leads to, or DEAD."""
        row = self.table[state]
        to = row.get(token)
        if to is None:
            to = self.target[token]
            if to != DEAD and not self._has(state, token, 1 << 60):
                to = DEAD
            row[token] = to
        return to

    def _arcs(self, symbols: list[str], at: int) -> list[tuple[int, int]]:
        """Tokens that the symbols spell from `at` on, and where they end, the longest last."""
        known, text, out = self.prefixes.get, "", []
        for symbol in islice(symbols, at, None):
            text += symbol
            at += 1
            token = known(text)
            if token is None:
                break
            if token >= 0:
                out.append((token, at))
        return out

    def encode(self, symbols: list[str]) -> list[int]:
        """Tokens of the only accepted path over the symbols.

        Arcs are tried from the longest on. Every prefix has one accepted path and so one state, so a place from which the end
        can't be reached is marked and not tried again: each is looked at once, and time grows with the symbols times the longest token.
        """
        n, table = len(symbols), self.table
        dead, at, state = bytearray(n + 1), 0, START
        places, states, tokens, open_arcs = [], [], [], self._arcs(symbols, 0)
        waiting = []
        while at < n:
            row = table[state]
            while open_arcs:
                token, end = open_arcs.pop()
                if dead[end]:
                    continue
                to = row.get(token)
                if to is None:
                    to = self.step(state, token)
                if to != DEAD:
                    waiting.append(open_arcs)
                    places.append(at)
                    states.append(state)
                    tokens.append(token)
                    at, state = end, to
                    open_arcs = self._arcs(symbols, end) if end < n else []
                    break
            else:
                if not waiting:
                    raise ValueError(f"not in the alphabet: {symbols!r}"[:200])
                dead[at] = 1
                open_arcs, at, state = waiting.pop(), places.pop(), states.pop()
                tokens.pop()
        return tokens

    def decode(self, ids: list[int]) -> list[str]:
        """The labels of the arcs."""
        return [self.labels[i] for i in ids]


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable, else one from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class WordTokenizer:
    """Lower-cased words with word ends: the file's normalizer and pattern, bytes as characters, then the automaton."""

    # Texts of these characters are split by a class of characters instead of Unicode categories, with the same result.
    COMMON = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
    COMMON_LETTERS, COMMON_OTHERS = r"a-zÀ-ÖØ-öø-ÿ", r"\t-\r 0-9a-zÀ-ÖØ-öø-ÿ"

    def __init__(self, spec: dict, remembered: int = 120_000):
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.automaton = TokenAutomaton(dict(model["vocab"]), merges)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        named = self.automaton.labels | {i: t for t, i in self.special.items()}
        self.labels = [named.get(i, "") for i in range(max(named, default=-1) + 1)]
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        common = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{self.COMMON_OTHERS}]").replace(r"[\p{L}]", f"[{self.COMMON_LETTERS}]").replace(r"[\p{N}]", "[0-9]")
        self.common = re.compile(common) if r"\p" not in common and r"\s" not in common else None
        # Letters, digits and lower case of all other texts are those of the library's own Unicode tables.
        self.library = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}))
        self.bytes = byte_characters()
        self.byte_of = {c: b for b, c in self.bytes.items()}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remembered = remembered

    def _encoded(self, word: str) -> bytes:
        """Ids of a word as 32-bit integers; kept in one of two memories, of which the older one is dropped."""
        found = self.older.get(word)
        if found is None:
            symbols = [self.bytes[b] for b in word.encode("utf-8", "surrogatepass")]
            symbols[-1] += self.suffix
            found = array("i", self.automaton.encode(symbols)).tobytes()
        if len(word) <= 64:
            if len(self.recent) >= self.remembered:
                self.older, self.recent = self.recent, {}
            self.recent[word] = found
        return found

    def _words(self, text: str) -> list[str]:
        """The lower-cased words of a text, as the library's normalizer and pre-tokenizer give them."""
        if self.common is not None and self.COMMON.fullmatch(text):
            return self.common.findall(text.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes([self.byte_of[c] for c in piece]).decode("utf-8", "surrogatepass") for piece, _ in pieces]

    def _plain(self, text: str) -> bytes:
        known = self.recent.get
        return b"".join([known(w) or self._encoded(w) for w in self._words(text)])

    def encode(self, text: str) -> array:
        """Ids of a text; the strings of special tokens in it are these tokens."""
        if self.at_special is None or not self.at_special.search(text):
            return array("i", self._plain(text))
        out = array("i")
        for part in self.at_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.frombytes(self._plain(part))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the ids' arcs, a space between them."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])


def tokenizer_of(raw: bytes) -> WordTokenizer:
    """One tokenizer for each worker process and file."""
    return worker_state(("words", hash(raw)), lambda: WordTokenizer(json.loads(zlib.decompress(raw))))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row for each document: doc_id, ids (array<int>) and the text that the ids decode to.

    `path` is a tokenizer file on the driver; it goes to each executor once (a few MB). Null and empty texts, and texts of white
    space alone, have no ids and decode to ''. Repeated rows are encoded each for itself; a null doc_id stays null; other columns are ignored.
    A very long text takes time and memory in proportion to its length, as does a very long word.
    """
    with open(path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(zlib.compress(f.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(held.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                out = [tokenizer.encode(t or "") for t in part.column("text").to_pylist()]
                offsets = np.cumsum([0] + [len(ids) for ids in out])
                ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(out))])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids),
                    "decoded": pa.array([tokenizer.decode(ids) for ids in out], pa.string())})

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")
