"""Quality rules as a short-circuit cascade.

Each rule rejects a document or not. On a bounded sample every rule's cost
(seconds a document) and selectivity (share rejected of what the rules before
it leave) are measured; the rules run in the order of rejection per cost, and a
document leaves at the first that rejects it. Measurements shared between rules (words, lines) are
taken when a rule first asks for them. The verdict is the same in any order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import hash_sample
from ._words import _space, all_windows, texts, word_hashes

#: The symbols that n_symbols counts.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean"
)

_ascii_letters = np.array([*range(65, 91), *range(97, 123)])


class Text:
    """What the rules ask about one text, measured on demand."""

    def __init__(self, data: np.ndarray):
        self.data = data

    @cached_property
    def bytes_seen(self) -> np.ndarray:
        return np.bincount(self.data, minlength=256)

    @cached_property
    def words(self) -> np.ndarray:
        return word_hashes(self.data)

    @cached_property
    def n_words(self) -> int:
        inside = ~_space[self.data]
        return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(len(inside) > 0 and inside[0])

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: bytes that neither continue a character nor are space."""
        seen = self.bytes_seen
        return int(len(self.data) - seen[128:192].sum() - seen[_space].sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(self.bytes_seen[list(SYMBOLS)].sum())

    @cached_property
    def lines(self) -> tuple[int, int]:
        """(lines with a word, those equal to an earlier line)."""
        found = [x for x in self.data.tobytes().split(b"\n") if x.strip(b" \t\v\f\r")]
        return len(found), len(found) - len(set(found))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside three-word windows that occur at least twice in the text."""
        windows = all_windows(self.words, 3)
        if len(windows) < 2:
            return 0
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        twice = np.zeros(len(windows) + 2, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = twice.copy()
        covered[1:] |= twice[:-1]
        covered[2:] |= twice[:-2]
        return int(np.count_nonzero(covered))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def few_words(t: Text) -> bool:
    return t.n_words < MIN_WORDS


def repeats(t: Text) -> bool:
    return 100 * t.n_repeat_words > 50 * t.n_words


def symbols(t: Text) -> bool:
    return 100 * t.n_symbols > 20 * t.n_words


def shouting(t: Text) -> bool:
    """Over 40 % of the ASCII letters are capitals."""
    seen = t.bytes_seen
    return 100 * int(seen[65:91].sum()) > 40 * int(seen[_ascii_letters].sum())


def exclaiming(t: Text) -> bool:
    return 100 * int(t.bytes_seen[33]) > 20 * t.n_words


def duplicate_lines(t: Text) -> bool:
    lines, again = t.lines
    return 100 * again > 50 * lines


def word_lengths(t: Text) -> bool:
    return t.word_chars < 2 * t.n_words or t.word_chars > 20 * t.n_words


BASE = (Rule("few_words", few_words), Rule("repeats", repeats))
OWN = (
    Rule("symbols", symbols),
    Rule("shouting", shouting),
    Rule("exclaiming", exclaiming),
    Rule("duplicate_lines", duplicate_lines),
    Rule("word_lengths", word_lengths),
)
RULES = BASE + OWN


def estimate(sample: list[bytes], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds a document, share rejected) over a sample of UTF-8 texts."""
    out = []
    for rule in rules:
        rejected, began = 0, time.thread_time()
        for data in sample:
            rejected += bool(rule.rejects(Text(np.frombuffer(data, np.uint8))))
        n = max(len(sample), 1)
        out.append((rule.name, (time.thread_time() - began) / n, rejected / n))
    return out


def ordered(rules: tuple[Rule, ...], estimates: list[tuple[str, float, float]]) -> tuple[Rule, ...]:
    """Rules by rejection per cost, highest first; equal ones by name."""
    worth = {name: share / max(cost, 1e-9) for name, cost, share in estimates}
    return tuple(sorted(rules, key=lambda r: (-worth[r.name], r.name)))


def chained(rules: tuple[Rule, ...], sample: list[bytes]) -> tuple[Rule, ...]:
    """Rules in the order of a cascade: each time the one with most rejection per cost among the texts still left."""
    cost = {name: max(seconds, 1e-9) for name, seconds, _ in estimate(sample, rules)}
    rejects = {r.name: np.array([bool(r.rejects(Text(np.frombuffer(d, np.uint8)))) for d in sample], bool) for r in rules}
    left, rest, out = np.ones(len(sample), bool), list(rules), []
    while rest:
        best = min(rest, key=lambda r: (-np.count_nonzero(rejects[r.name] & left) / cost[r.name], r.name))
        rest.remove(best)
        out.append(best)
        left &= ~rejects[best.name]
    return tuple(out)


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000, max_chars: int = 20_000) -> tuple[Rule, ...]:
    """The order for ``docs``, from a sample of at most ``sample_rows`` texts of at most ``max_chars`` characters.

    The sample is taken in the order of a hash of id and text, and bounds the
    planning only: what is kept does not depend on it.
    """
    keys = [c for c in ("doc_id", "text") if c in docs.columns]
    rows = hash_sample(docs.select(*keys).where(F.length("text") <= max_chars), sample_rows, *keys).select("text").collect()
    return chained(rules, [r[0].encode() for r in rows])


def _verdicts(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for data in texts(batch.column("text")):
            t = Text(data if data is not None else np.zeros(0, np.uint8))
            keep.append(not any(r.rejects(t) for r in rules))
        yield batch.filter(pa.array(keep, pa.bool_()))


def cascade(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    A null or empty text is rejected for want of words; repeated rows share a
    fate; an empty table stays empty.
    """
    rules = rules or plan(docs)
    return docs.mapInArrow(lambda b: _verdicts(b, rules), docs.schema)


def _measures(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for data in texts(batch.column(1)):
            t = Text(data if data is not None else np.zeros(0, np.uint8))
            base = few_words(t) or repeats(t)
            rows.append(
                (t.n_words, t.word_chars, t.n_symbols, t.lines[1], t.n_repeat_words, base, not base and not any(r.rejects(t) for r in rules))
            )
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.int64()] * 5 + [pa.bool_()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, types, strict=True))],
            [f.split()[0] for f in SCHEMA.split(",")],
        )


def measures(docs: DataFrame, own: tuple[Rule, ...] | None = None) -> DataFrame:
    """Counts, the base verdict and the cascade's verdict for every row of ``docs``.

    A null or empty text has no words, so it fails the base rules. Repeated
    rows each get a row. Other columns are not read. An empty table gives none.
    One narrow pass; the plan samples the texts once before it.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    rules = own or plan(plain, OWN)
    return plain.mapInArrow(lambda b: _measures(b, rules), SCHEMA)


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM d)
),
tri AS (
  SELECT doc_id, pos, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
),
twice AS (
  SELECT doc_id, pos, word,
         CASE WHEN w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w2, w3) > 1 THEN 1 ELSE 0 END AS t
  FROM tri
),
cover AS (
  SELECT doc_id, length(word) AS chars,
         max(t) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c
  FROM twice
),
words AS (
  SELECT doc_id, count(*) AS n_words, sum(chars) AS word_chars, sum(c) AS n_repeat_words FROM cover GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
),
s AS (
  SELECT d.doc_id,
    CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
    CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS upper_letters,
    length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS letters,
    length(text) - length(replace(text, '!', '')) AS bangs
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN lines USING (doc_id)
),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND NOT (100 * n_symbols > 20 * n_words)
    AND NOT (100 * upper_letters > 40 * letters)
    AND NOT (100 * bangs > 20 * n_words)
    AND NOT (100 * n_dup_lines > 50 * n_lines)
    AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""
