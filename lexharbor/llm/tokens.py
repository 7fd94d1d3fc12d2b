"""Byte-level BPE as a deterministic automaton, and the encoding of a corpus with it.

The merges are compiled by one gadget each, in the order of their rank, into a deterministic automaton over tokens that accepts just
the sequences BPE would produce. It has a start state and one state for each token p, "p was read last". The gadget of a merge u v -> w
forbids the arc v in the state of u, and adds an arc w: it may be read wherever u may be read, and leads to a copy of the state of v.
Copies are kept as links with the time of the copying instead of being written out, so 50,000 gadgets take 50,000 table rows and not
50,000 x 50,000 arcs; an arc is looked up by following the links (`arc`), and the outcome is kept in the transition table.

A word is encoded by running the bytes through a second table, the trie of all tokens, and keeping for each position the one state that
reaches it: each prefix of a word has exactly one accepted path. Time is linear in the length of the word.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the published pattern that splits a text into words before the merges.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose ids a worker remembers; beyond it the memory is emptied. Words of over KEEP_CHARS are never kept.
KEEP_WORDS, KEEP_CHARS = 400_000, 64
#: Entries of the transition table before it is emptied.
KEEP_ARCS = 2_000_000
NEVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable bytes stand for themselves, the others for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    """The bytes of each id, and the merges (left, right, new) in the order of their rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of = byte_letters()
    ids = model["vocab"]
    tokens = [b""] * (max(ids.values()) + 1)
    for text, i in ids.items():
        tokens[i] = bytes(byte_of[c] for c in text)
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs]


class Automaton:
    """The compiled merges. `arc` is its transition function, `encode_word` a run over one word."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]]):
        n = len(tokens)
        self.tokens = tokens
        self.like_left, self.copy_of = [-1] * n, [-1] * n  # an arc is allowed as its left part is; a state copies that of its right part
        self.time = [-1] * n  # when the gadget made the token; -1: from the start
        self.forbids: dict[int, int] = {}  # state << 32 | arc: when its gadget removed the arc
        for rank, (u, v, w) in enumerate(merges):
            self._gadget(rank, u, v, w)
        self.known: dict[int, bool] = {}
        self.step: dict[int, int] = {}  # node << 8 | byte: the next node of the trie
        self.ends = [-1]  # node: its token
        for i, token in enumerate(tokens):
            if token and (len(token) == 1 or self.time[i] >= 0):
                node = 0
                for b in token:
                    key = node << 8 | b
                    if key not in self.step:
                        self.step[key] = len(self.ends)
                        self.ends.append(-1)
                    node = self.step[key]
                self.ends[node] = i

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        self.forbids[u << 32 | v] = rank
        if self.time[w] < 0:
            self.like_left[w], self.copy_of[w], self.time[w] = u, v, rank

    def arc(self, state: int, token: int) -> bool:
        """Whether `token` may follow in the state reached by token `state`."""
        key = state << 32 | token
        if (found := self.known.get(key)) is None:
            if len(self.known) >= KEEP_ARCS:
                self.known.clear()
            found = self.known[key] = self._arc(state, token)
        return found

    def _arc(self, state: int, token: int) -> bool:
        until_state = NEVER
        while state >= 0:  # the state and those it copies, each as it was when copied
            until, x = NEVER, token
            while x >= 0:  # the arc and those it is allowed with, each as of then
                rank = self.forbids.get(state << 32 | x)
                if rank is not None and rank < until_state and rank <= until:
                    return False
                until, x = self.time[x], self.like_left[x]
            until_state, state = self.time[state], self.copy_of[state]
        return True

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word."""
        n, step, ends, arc = len(word), self.step, self.ends, self.arc
        last, start = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            if i and last[i] < 0:
                continue
            node, state = 0, last[i]
            for j in range(i, n):
                node = step.get(node << 8 | word[j], -1)
                if node < 0:
                    break
                token = ends[node]
                if token >= 0 and last[j + 1] < 0 and (i == 0 or arc(state, token)):
                    last[j + 1], start[j + 1] = token, i
        out = []
        while n:
            out.append(last[n])
            n = start[n]
        return out[::-1]

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


class Encoder:
    """An automaton with the words it has seen."""

    def __init__(self, automaton: Automaton):
        self.automaton, self.seen, self.split = automaton, {}, regex.compile(WORDS).findall

    def _new(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.automaton.encode_word(word.encode("utf-8", "surrogatepass")))
        if len(word) <= KEEP_CHARS:
            if len(self.seen) >= KEEP_WORDS:
                self.seen.clear()
            self.seen[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        add, get, new = out.extend, self.seen.get, self._new
        for word in self.split(text or ""):
            ids = get(word)
            add(new(word) if ids is None else ids)
        return out

    def count(self, text: str | None) -> int:
        get, new, n = self.seen.get, self._new, 0
        for word in self.split(text or ""):
            ids = get(word)
            n += len(new(word) if ids is None else ids)
        return n


_KEPT: dict[int, Encoder] = {}


def _worker(key: int, sent) -> Encoder:
    """The encoder of a broadcast vocabulary, compiled once by a worker."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Encoder(Automaton(*sent.value))
    return _KEPT[key]


def _sent(df: DataFrame, vocabulary: str):
    """The vocabulary for the workers; its size is that of the file, whatever the corpus."""
    return df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))


def token_ids(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> Column:
    """Column ARRAY<INT>: the ids of `text`, without special tokens; their strings in a text are ordinary text.

    An empty and a NULL text have no tokens: both give an empty array, never NULL. Texts are encoded whole.
    """
    sent = _sent(df, vocabulary)
    key = sent._jbroadcast.id()

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(texts: pa.Array) -> pa.Array:
        encoder, parts, ends = _worker(key, sent), [], [0]
        for t in texts:
            ids = encoder.encode(t.as_py())
            parts.append(np.array(ids, dtype=np.int32))
            ends.append(ends[-1] + len(ids))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return encode(F.col(text))


def token_count(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> Column:
    """Column INT: how many tokens `text` has; 0 for an empty and for a NULL text."""
    sent = _sent(df, vocabulary)
    key = sent._jbroadcast.id()

    @F.arrow_udf(IntegerType())
    def count(texts: pa.Array) -> pa.Array:
        encoder = _worker(key, sent)
        return pa.array([encoder.count(t.as_py()) for t in texts], pa.int32())

    return count(F.col(text))


def encode_corpus(df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """`df` with a column `ids` ARRAY<INT> (see `token_ids`), instead of a column of that name if there is one.

    One row for every row of `df`, repeated rows included, without a shuffle; an empty table gives an empty table.
    """
    return df.withColumn(ids, token_ids(df, text, vocabulary))


def decode_corpus(df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """`df` with a column `text` STRING: the text of `ids`; NULL for NULL ids, empty for no ids."""
    sent = _sent(df, vocabulary)

    @F.arrow_udf(StringType())
    def decode(rows: pa.Array) -> pa.Array:
        tokens = sent.value[0]
        join = lambda row: b"".join(tokens[i] for i in row).decode("utf-8", "replace")
        return pa.array([None if (row := r.as_py()) is None else join(row) for r in rows], pa.string())

    return df.withColumn(text, decode(F.col(ids)))
