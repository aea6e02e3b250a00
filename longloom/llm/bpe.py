"""Byte-level BPE by backtracking over an Aho-Corasick automaton.

The vocabulary's byte strings, read as Latin-1, form an automaton. A word is
covered from the left with the longest match at each place; a token stands
only if it is compatible with the one before it, that is, if the merges of the
two side by side leave exactly those two: read off the parts that meet at their
bound while each is merged, without merging. Where none fits, the last token is
taken back and its next shorter prefix tried; which one fits behind a token is
remembered in a table of bounded size. As every place is entered once
for good or marked as dead, a word takes linear time, and the result equals
that of merging by rank.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._pretokens import ChunkValues

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a tiktoken rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class BacktrackBPE:
    def __init__(self, ranks: dict[bytes, int], most_pairs: int = 400_000):
        import ahocorasick

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.most_pairs = most_pairs
        self._picks: dict[tuple[int, int], int] = {}
        self._sizes = {i: len(t) for t, i in ranks.items()}
        self._shorter: dict[int, int] = {}
        self._halves: dict[bytes, list[bytes]] = {}
        self._edges: dict[tuple[int, int], list[tuple[bytes, float]]] = {}
        self._automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            if len(token) > 1:
                halves = self._parts(token, 2)
                if len(halves) > 2:
                    continue  # a token that merges never build is only ever a whole word
                self._halves[token] = halves
            self._automaton.add_word(token.decode("latin-1"), i)
        self._automaton.make_automaton()
        #: every token comes after the two it is merged from, so that the merges of a text run in the order of rank
        self.ordered = all(len(h) == 1 or ranks[h] < ranks[t] for t, halves in self._halves.items() for h in halves)

    def _parts(self, data: bytes, least: int = 1) -> list[bytes]:
        """``data`` merged by rank, the plain way, while more than ``least`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get = self.ranks.get
        while len(parts) > least:
            found = [(r, i) for i in range(len(parts) - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merge(self, data: bytes) -> list[int]:
        """Merge by rank, the plain way: used for pairs of tokens only, where ranks are not ``ordered``."""
        return [self.ranks[p] for p in self._parts(data)]

    def _edge(self, token: int, side: int) -> list[tuple[bytes, float]]:
        """What lies at one end (0 left, 1 right) of a token while it is merged, each part with the rank that ends it."""
        known = self._edges.get((token, side))
        if known is None:
            part, until = self.tokens[token], math.inf
            known = [(part, until)]
            while len(part) > 1:
                part, until = self._halves[part][side], self.ranks[part]
                known.append((part, until))
            known.reverse()
            self._edges[(token, side)] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether no merge joins the two tokens, where ranks are ``ordered``.

        The parts beside the bound last until the next merge of their own side.
        The merge of the two takes place if it comes before both; of merges
        with one rank the leftmost is first.
        """
        lefts, rights, get = self._edge(left, 1), self._edge(right, 0), self.ranks.get
        i = j = 0
        a, a_until = lefts[0]
        b, b_until = rights[0]
        while True:
            rank = get(a + b)
            if rank is not None and rank < a_until and rank <= b_until:
                return False
            if a_until <= b_until:
                i += 1
                if i == len(lefts):
                    return True
                a, a_until = lefts[i]
            else:
                j += 1
                b, b_until = rights[j]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of the two side by side leave exactly those two."""
        if self.ordered:
            return self._apart(left, right)
        return self.merge(self.tokens[left] + self.tokens[right]) == [left, right]

    def _pick(self, before: int, token: int) -> int:
        """The first of ``token`` and its ever shorter prefixes that is compatible with the token before it, or -1."""
        if len(self._picks) >= self.most_pairs:
            self._picks.clear()
        fits = token
        while fits != -1 and before != -1 and not self.compatible(before, fits):
            fits = self.shorter(fits)
        self._picks[(before, token)] = fits
        return fits

    def shorter(self, token: int) -> int:
        """The longest token of the automaton that is a proper prefix of this one, or -1."""
        known = self._shorter.get(token)
        if known is None:
            text = self.tokens[token].decode("latin-1")
            known = next((self._automaton.get(text[:n]) for n in range(len(text) - 1, 0, -1) if text[:n] in self._automaton), -1)
            self._shorter[token] = known
        return known

    def _longest(self, text: str, at: int) -> int:
        """The longest token of the automaton that begins at ``at``, or -1."""
        for end, token in self._automaton.iter_long(text, at):
            return token if end + 1 - self._sizes[token] == at else -1
        return -1

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        n, sizes, picks = len(word), self._sizes, self._picks
        text = word.decode("latin-1")
        matches = self._automaton.iter_long
        # longest matches end to end: nothing to take back if all neighbours are compatible
        first = [i for _, i in matches(text)]
        longest: dict[int, int] = {}
        if sum(map(sizes.__getitem__, first)) == n:
            try:
                if list(map(picks.__getitem__, zip(first, first[1:]))) == first[1:]:
                    return first
            except KeyError:
                pass
            at = 0
            for token in first:
                longest[at] = token
                at += sizes[token]
        out: list[int] = []
        dead = set()
        at, before, token = 0, -1, self._longest(text, 0)
        while True:
            fits = picks.get((before, token))
            if fits is None:
                fits = self._pick(before, token)
            if fits == -1:
                # nothing fits behind the last token: take it back
                dead.add(at)
                if not out:
                    raise ValueError(f"no encoding for {word!r}: a byte of it may not be in the vocabulary")
                fits = out.pop()
                at -= sizes[fits]
                before = out[-1] if out else -1
                token = self.shorter(fits)
                continue
            end = at + sizes[fits]
            if end in dead:
                token = self.shorter(fits)
                continue
            out.append(fits)
            if end == n:
                return out
            at, before, token = end, fits, longest.get(end)
            if token is None:
                token = longest[at] = self._longest(text, at)


class TextEncoder:
    """Whole texts: split by a pattern, then encode each match by itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe = BacktrackBPE(ranks)
        self._packed = {i: i.to_bytes(4, "little") for i in ranks.values()}
        #: ids of a text as little-endian unsigned 32-bit integers
        self.encode = ChunkValues(pattern, self._word, b"".join)

    def _word(self, word: str) -> bytes:
        return b"".join(map(self._packed.__getitem__, self.bpe.encode_word(word.encode())))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bpe.tokens.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> TextEncoder:
    """One automaton and one set of tables for all tasks of a Python worker."""
    return TextEncoder(load_ranks(path), pattern)


def _digests(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path, pattern)
    for batch in batches:
        n_tokens, ids_sha, decoded_sha = [], [], []
        for text in batch.column(1):
            ids = encoder.encode(text.as_py() or "")
            n_tokens.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            decoded_sha.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _id_lists(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    import numpy as np

    encoder = _encoder(path, pattern)
    for batch in batches:
        ids = [np.frombuffer(encoder.encode(t.as_py() or ""), "<u4").astype(np.int32) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokens = {i: t for t, i in load_ranks(path).items()}
    for batch in batches:
        data = [None if not row.is_valid else b"".join([tokens[i] for i in row.as_py()]) for row in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])


def encode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) of every whole text; null and empty texts give an empty list."""
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return plain.mapInArrow(lambda b: _id_lists(b, rank_path, pattern), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """(doc_id, data): the bytes behind ``ids``; null ids give null. An unknown id is an error."""
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: _decoded(b, rank_path), "doc_id long, data binary")


def digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded bytes of every whole text.

    Narrow: one pass over doc_id and text, no shuffle. Words met before come
    from a table of bounded size that each worker keeps between its tasks. Null and empty texts have no
    tokens; repeated rows are encoded each; other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return plain.mapInArrow(lambda b: _digests(b, rank_path, pattern), SCHEMA)
