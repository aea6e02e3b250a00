"""Token counts under a unigram model, sharing work along the prefixes of a trie.

The best score of a prefix depends on nothing behind it, so pre-tokens that
begin alike share their forward scores: they are put into a trie, and each
node is scored once, from its ancestors. A node where a pre-token ends stores
the number of tokens on the best path to it.

The score of a token is a unigram log-probability read off its rank in a
public vocabulary by Zipf's law, log(1 / ((rank + 1) * H)); H is the harmonic
sum over the vocabulary. Every byte is a token, so every text has a path. Of
paths with equal scores the one with fewer tokens counts.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._pretokens import ChunkValues
from .bpe import load_ranks

SCHEMA = "doc_id long, n_pretokens long, n_tokens long, n_bytes long"


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = math.log(math.fsum(1 / (r + 1) for r in ranks.values()))
    return {t: -math.log(r + 1) - total for t, r in ranks.items()}


class TokenTrie:
    """Forward scores of pre-tokens, one node for each distinct prefix.

    Nodes are numbers: ``below`` leads from (node, byte) to the next, and a
    node's best score, its tokens, its last byte and its parent lie in arrays.
    """

    def __init__(self, scores: dict[bytes, float], most_nodes: int = 800_000):
        self.most_nodes = most_nodes
        # the vocabulary backwards: tokens that end at a node are met walking from it to the root
        self.ends: dict = {}
        for token, score in scores.items():
            at = self.ends
            for byte in reversed(token):
                at = at.setdefault(byte, {})
            at[-1] = score
        self.clear()

    def clear(self) -> None:
        self.below: dict[int, int] = {}
        self.best, self.tokens = array("d", [0.0]), array("l", [0])
        self.byte, self.parent = array("h", [-1]), array("l", [-1])

    def _grow(self, parent: int, byte: int) -> int:
        best, tokens = -math.inf, 0
        at, before = self.ends.get(byte), parent
        scores, counts, bytes_, parents = self.best, self.tokens, self.byte, self.parent
        while at is not None:
            found = at.get(-1)
            if found is not None:
                score, n = scores[before] + found, counts[before] + 1
                if score > best or score == best and n < tokens:
                    best, tokens = score, n
            if not before:
                break
            at = at.get(bytes_[before])
            before = parents[before]
        if not tokens:
            raise ValueError(f"no token ends with byte {byte}")
        scores.append(best)
        counts.append(tokens)
        bytes_.append(byte)
        parents.append(parent)
        return len(scores) - 1

    def count(self, word: bytes) -> int:
        """Tokens of one pre-token; 0 if empty."""
        if len(self.best) > self.most_nodes:
            self.clear()
        node, below = 0, self.below
        for byte in word:
            key = node << 8 | byte
            after = below.get(key)
            if after is None:
                after = below[key] = self._grow(node, byte)
            node = after
        return self.tokens[node]


class TextCounter:
    """Pre-tokens and tokens of whole texts; finished pre-tokens keep their terminal counts."""

    def __init__(self, scores: dict[bytes, float], pattern: str):
        self.trie = TokenTrie(scores)
        self._sum = ChunkValues(pattern, lambda w: 1 << 40 | self.trie.count(w.encode()), sum)

    def count(self, text: str) -> tuple[int, int]:
        both = self._sum(text)
        return both >> 40, both & (1 << 40) - 1


def _counts(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    counter = TextCounter(zipf_scores(load_ranks(path)), pattern)
    for batch in batches:
        rows = []
        for text in batch.column(1):
            value = text.as_py() or ""
            rows.append((*counter.count(value), len(value.encode())))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], [f.split()[0] for f in SCHEMA.split(", ")]
        )


def token_counts(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Pre-tokens, tokens and UTF-8 bytes of every whole text.

    One pass without a shuffle; each worker keeps a trie and a table of
    finished pre-tokens, both of bounded size and emptied when full, which
    changes the work but not the counts. Null and empty texts count 0; repeated
    rows are counted each; other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return plain.mapInArrow(lambda b: _counts(b, rank_path, pattern), SCHEMA)
