"""Removal of long word sequences that occur more than once, on a compacted de Bruijn graph.

Edges of the graph are the windows of ``size`` words, nodes the words two
windows share. A repeated window is an edge seen twice. Edges are not shuffled
one by one: every window holds an anchor, the smallest of its k-mer
fingerprints (a minimizer), and equal windows hold equal anchors in the same
place. All windows through one anchor occurrence form a path of the graph,
known by the anchor and the words around it.

1. Anchors are counted. One seen once lies on no repeated edge.
2. A repeated anchor whose occurrences all have the same words around is on a
   path that never branches: all its edges are repeated at once, and the path
   is compacted to the spans at its source coordinates (document, word).
3. Where the words around differ the graph branches. Equal surroundings are
   compacted as before to one occurrence; the edges of the rest are looked up
   at their source coordinates and compared as whole windows.

Spans return to their documents by coordinate, and the words they cover are
removed. Surroundings and windows are compared by 128-bit fingerprints.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import compact, dropped, row_keys, unused
from ._words import all_windows, pieces, texts, window_hashes, word_hashes

SIZE = 35
ANCHOR = 8
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"

_words = re.compile(rb"[^\x20\x09-\x0D]+").findall
_EMPTY = np.zeros(0, np.uint8)


def _window_min(v: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, have = v, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(words: np.ndarray, size: int = SIZE, k: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(positions, fingerprints) of the k-mers that are smallest in some window of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    v, width = all_windows(words, k), size - k + 1
    low = _window_min(v, width)
    # a k-mer is an anchor if it equals the minimum of a window that covers it
    pad = np.zeros(width - 1, np.uint64)
    best = ~_window_min(~np.concatenate([pad, low, pad]), width)
    at = np.flatnonzero(best == v)
    return at, v[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(batches: Iterator[pa.RecordBatch], size: int, k: int) -> Iterator[pa.RecordBatch]:
    """Anchor occurrences with the extent and the fingerprint of the words around them."""
    reach = size - k
    for batch in pieces(batches, 1):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        parts: list[tuple] = []
        for doc, data in zip(ids, texts(batch.column(1)), strict=True):
            words = word_hashes(_EMPTY if data is None else data)
            at, anchor = anchors(words, size, k)
            if not len(at):
                continue
            low, high = np.maximum(at - reach, 0), np.minimum(at + k + reach, len(words))
            # the extent to the left goes in, so equal marks mean equal places in the surroundings
            a = window_hashes(words, low, high - low) + (at - low).astype(np.uint64)
            b = window_hashes(words, low, high - low, 1)
            parts.append((anchor, a, b, np.full(len(at), doc), at, low, high))
        if parts:
            c = [np.concatenate(x) for x in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*map(_signed, c[:3]), pa.array(c[3]), *(pa.array(x.astype(np.int32)) for x in c[4:])],
                ["anchor", "a", "b", "doc_id", "pos", "low", "high"],
            )


def _window_rows(batches: Iterator[pa.RecordBatch], size: int, k: int) -> Iterator[pa.RecordBatch]:
    """Windows through the listed anchor occurrences of each document: (a, b, doc_id, start, alone)."""
    reach = size - k
    for batch in pieces(batches, 1):
        parts: list[tuple] = []
        for doc, data, places, alone in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2), batch.column(3), strict=True):
            words = word_hashes(_EMPTY if data is None else data)
            at = np.array(places.as_py(), np.int64)
            own = np.repeat(np.array(alone.as_py(), bool), reach + 1)
            start = (at[:, None] - np.arange(reach, -1, -1)).ravel()
            valid = (start >= 0) & (start + size <= len(words))
            start, own = start[valid], own[valid]
            # windows through two listed anchors come once, as not alone if either is not
            start, first = np.unique(start, return_inverse=True)
            joint = np.ones(len(start), bool)
            np.logical_and.at(joint, first, own)
            parts.append((window_hashes(words, start, size), window_hashes(words, start, size, 1), np.full(len(start), doc), start, joint))
        c = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else None
        if c is not None and len(c[0]):
            yield pa.RecordBatch.from_arrays(
                [_signed(c[0]), _signed(c[1]), pa.array(c[2]), pa.array(c[3].astype(np.int32)), pa.array(c[4])],
                ["a", "b", "doc_id", "start", "alone"],
            )


def _cover(n: int, spans: list) -> np.ndarray:
    """True for each of ``n`` words inside a span (low, high)."""
    turns = np.zeros(n + 1, np.int64)
    if spans:
        s = np.array(spans, np.int64)
        np.add.at(turns, s[:, 0], 1)
        np.add.at(turns, s[:, 1], -1)
    return np.cumsum(turns[:-1]) > 0


def _spans(column: pa.Array, i: int) -> list:
    row = column[i].as_py()
    return [(s["low"], s["high"]) for s in row] if row else []


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 1):
        rows = []
        for i, (doc, data) in enumerate(zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True)):
            words = _words(b"" if data is None else data.tobytes())
            gone = _cover(len(words), _spans(batch.column(2), i))
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words
            rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in SCHEMA.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch], names: list[str], text: str, spans: str) -> Iterator[pa.RecordBatch]:
    """Rows with the covered words, and the white space before each, taken out of their text."""
    span = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
    for batch in pieces(batches, text):
        out = []
        held = batch.column(batch.schema.get_field_index(spans))
        for i, data in enumerate(texts(batch.column(batch.schema.get_field_index(text)))):
            found = _spans(held, i)
            if data is None or not found:
                out.append(None if data is None else data.tobytes().decode())
                continue
            raw = data.tobytes()
            words = span.findall(raw)
            gone = _cover(len(words), found)
            out.append(b"".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).lstrip(b" \t\n\v\f\r").decode())
        columns = [pa.array(out, pa.string()) if n == text else batch.column(batch.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names)


def repeated_spans(docs: DataFrame, size: int = SIZE, k: int = ANCHOR) -> DataFrame:
    """(doc_id, spans): the word spans [low, high) of each document whose windows occur elsewhere too.

    ``docs`` is (doc_id, text); rows with one doc_id must have one text. Documents without such a
    span have no row.
    """
    places = docs.mapInArrow(
        lambda b: _anchor_rows(b, size, k), "anchor long, a long, b long, doc_id long, pos int, low int, high int"
    )
    places = compact(places, "anchors")
    mark = F.struct("a", "b")
    seen = places.groupBy("anchor").agg(F.count("*").alias("n"), F.min(mark).alias("least"), F.max(mark).alias("most")).where("n > 1")
    # stored, so that both sides of the join are plain exchanges, of which adaptive execution can split a hot anchor
    seen = compact(seen.select("anchor", (F.col("least") != F.col("most")).alias("branches")), "seen")
    repeated = compact(places.join(seen, "anchor"), "repeated")
    whole = repeated.where("NOT branches").where(F.col("high") - F.col("low") >= size).select("doc_id", "low", "high")
    # branching anchors: equal surroundings are one path; one occurrence stands for it
    branching = repeated.where("branches").where(F.col("high") - F.col("low") >= size)
    paths = compact(
        branching.groupBy("anchor", "a", "b").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first")), "paths"
    )
    twice = branching.join(paths.where("n > 1").select("anchor", "a", "b"), ["anchor", "a", "b"], "left_semi")
    ask = paths.groupBy(F.col("first.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct(F.col("first.pos").alias("pos"), (F.col("n") == 1).alias("alone"))).alias("asked")
    )
    at_source = docs.join(ask, "doc_id").select("doc_id", "text", "asked.pos", "asked.alone")
    windows = at_source.mapInArrow(lambda b: _window_rows(b, size, k), "a long, b long, doc_id long, start int, alone boolean")
    windows = compact(windows, "windows")
    # only windows of lone paths are still open; those of compacted paths are there to be met
    met = windows.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("alone").alias("open")).where("n > 1 AND open")
    met = compact(met.select("a", "b"), "met")  # for the same reason as above
    single = windows.where("alone").join(met, ["a", "b"], "left_semi")
    single = single.select("doc_id", F.col("start").alias("low"), (F.col("start") + size).alias("high"))
    spans = whole.unionByName(twice.select("doc_id", "low", "high")).unionByName(single)
    found = compact(spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans")), "spans")
    dropped(places, seen, repeated, paths, windows, met)
    return found


def digests(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Words, removed words and the SHA-256 of the kept words of every row of ``docs``.

    A null or empty text has no words; a text shorter than a window keeps all.
    Exact copies lose all words that a window covers, overlapping repeats within
    one text count. Repeated rows are copies of each other. A null doc_id is
    allowed. Other columns are not read; an empty table gives no rows.
    """
    keyed = docs.select(row_keys(docs).alias("key"), F.col("doc_id").cast("long").alias("id"), "text")
    spans = repeated_spans(keyed.select(F.col("key").alias("doc_id"), "text"), size)
    joined = keyed.join(spans, keyed["key"] == spans["doc_id"], "left")
    return joined.select("id", "text", "spans").mapInArrow(_digests, SCHEMA)


def remove(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with repeated spans taken out of ``text``; all rows and columns stay.

    Null texts stay null, empty ones empty; of repeated rows each loses what the
    others hold too; columns of any name are allowed beside doc_id and text.
    """
    key, spans = (unused(docs, name) for name in ("_longloom_key", "_longloom_spans"))
    keyed = docs.withColumn(key, row_keys(docs))
    found = repeated_spans(keyed.select(F.col(key).alias("doc_id"), "text"), size)
    found = found.select(F.col("doc_id").alias(key), F.col("spans").alias(spans))
    names, text = docs.columns, docs.select("text").columns[0]
    return keyed.join(found, key, "left").drop(key).mapInArrow(lambda b: _cut(b, names, text, spans), docs.schema)
