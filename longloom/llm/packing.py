"""Packing documents into training sequences.

``pack_partition`` is the sum-of-squares rule (Csirik, Johnson, Kenyon et al.,
"On the sum-of-squares algorithm for bin packing"): a piece goes where it
leaves the sum, over fill levels, of the squared number of open windows with
that level smallest. The open windows are known only by an array of counts per
level, so one placement costs one pass over that array.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._words import freed

WINDOW = 2048
END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window, dtype=np.int64)
        self.open: dict[int, list[int]] = {}

    def choose(self, size: int) -> int:
        """The level to add ``size`` to; 0 is a new window. Ties: the fullest level."""
        w, n = self.window, self.count
        room = w - size
        best, level = 2 * int(n[size]) + 1 if size < w else 0, 0
        if room < 1:
            return 0
        # leaving level h: 1 - 2 n[h]; entering h + size: 1 + 2 n[h + size]; a full window has no level
        change = 1 - 2 * n[1 : room + 1]
        change[:-1] += 1 + 2 * n[1 + size : w]
        change[n[1 : room + 1] == 0] = np.iinfo(np.int64).max
        at = len(change) - 1 - int(np.argmin(change[::-1]))
        if change[at] <= best and n[at + 1]:
            level = at + 1
        return level

    def place(self, size: int, fresh) -> tuple[int, int]:
        """(sequence, offset) of a piece; ``fresh()`` names a new window."""
        level = self.choose(size)
        if level:
            sequence = self.open[level].pop()
            self.count[level] -= 1
        else:
            sequence = fresh()
        if level + size < self.window:
            self.open.setdefault(level + size, []).append(sequence)
            self.count[level + size] += 1
        return sequence, level

    def partly_full(self) -> list[tuple[int, int]]:
        return [(level, s) for level, found in sorted(self.open.items(), reverse=True) for s in found]


def pack_partition(documents, first_sequence: int, window: int = WINDOW):
    """Pieces (doc, start, length, sequence, offset) for documents (doc, length), in input order.

    Whole windows are cut off a long document at once; the rest of it is one
    piece for ``Levels``. Of the windows still partly full at the end, the
    emptiest are given up and their pieces cut once more to fill the others;
    what is left over becomes sequences whose lengths are powers of two, so that a
    partition ends without padding. Only those held back (one list per open
    window) are kept in memory.
    """
    next_id = first_sequence

    def fresh() -> int:
        nonlocal next_id
        next_id += 1
        return next_id - 1

    levels, held = Levels(window), {}
    for doc, length in documents:
        start = 0
        while length - start >= window:
            yield doc, start, window, fresh(), 0
            start += window
        if start < length:
            size = length - start
            sequence, offset = levels.place(size, fresh)
            held.setdefault(sequence, []).append((doc, start, size))
            if offset + size == window:
                at = 0
                for d, s, n in held.pop(sequence):
                    yield d, s, n, sequence, at
                    at += n
    # fullest first; the emptiest windows are given up, just enough of them to fill the others
    open_windows, gap, given = levels.partly_full(), 0, 0
    first, last = 0, len(open_windows)
    while first < last:
        if gap + window - open_windows[first][0] <= given:
            gap += window - open_windows[first][0]
            first += 1
        else:
            last -= 1
            given += open_windows[last][0]
    sizes = []
    for level, sequence in open_windows[:first]:
        at = 0
        for d, s, n in held[sequence]:
            yield d, s, n, sequence, at
            at += n
        sizes.append((window - level, sequence, level))
    left = given - gap
    for size in [window] * (left // window) + [1 << b for b in reversed(range(window.bit_length())) if (left % window) >> b & 1]:
        sizes.append((size, fresh(), 0))
    room, sequence, at = 0, -1, 0
    sizes.reverse()
    for _, given_up in open_windows[first:]:
        for d, s, n in held[given_up]:
            while n:
                if not room:
                    room, sequence, at = sizes.pop()
                take = min(n, room)
                yield d, s, take, sequence, at
                s, n, room, at = s + take, n - take, room - take, at + take


_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds:
    """Token ids of a text, one white-space separated chunk at a time.

    The vocabulary's normalizer composes (NFC) and then lower-cases letter by
    letter; its pre-tokenizer drops white space, never joins across it, and
    parts letters from punctuation. So a composed text is lower-cased once, a
    text's ids are those of its chunks in order, and those of a chunk that is
    letters followed by ASCII punctuation are those of the two. Chunks met
    before come from a table of bounded size. A text that carries a special
    token's string goes to the tokenizer whole.
    """

    def __init__(self, path: str, most: int = 900_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        # for chunks that are one pre-token as they stand: the same model, without the steps before it
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.most = most

    def _ids(self, texts: list[str], bare: bool = False) -> list[bytes]:
        tokenizer = self.bare if bare else self.tokenizer
        return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> str | None:
        """``text`` in lower case where that changes no ids; None if the tokenizer has to see it whole."""
        if text.isascii():
            text = text.lower()
        else:
            # a capital sigma is the one letter whose lower case would depend on its neighbours
            low = text.replace("\u03a3", "\u03c3").lower()
            if is_normalized("NFC", text) and is_normalized("NFC", low):
                text = low
        return None if any(s in text for s in self.special) else text

    @staticmethod
    def _is_word(chunk: str) -> bool:
        """Letters that the normalizer leaves as they are."""
        return chunk.isalpha() and chunk == chunk.lower() and (chunk.isascii() or is_normalized("NFC", chunk))

    def _learn(self, unknown: set[str]) -> None:
        """Put the ids of chunks not met before into ``chunks``."""
        chunks, is_word = self.chunks, self._is_word
        letters, other, parted = [], [], []
        for chunk in unknown:
            if is_word(chunk):
                letters.append(chunk)
            else:
                head = chunk.rstrip(_PUNCTUATION)
                if len(head) < len(chunk) and is_word(head):
                    parted.append((chunk, head, chunk[len(head) :]))
                else:
                    other.append(chunk)
        letters += {h for _, h, _ in parted}.difference(chunks, unknown)
        other += {t for _, _, t in parted}.difference(chunks, unknown)
        for bare, new in ((False, other), (True, letters)):
            for i in range(0, len(new), 50_000):
                chunks.update(zip(new[i : i + 50_000], self._ids(new[i : i + 50_000], bare), strict=True))
        for chunk, head, tail in parted:
            chunks[chunk] = chunks[head] + chunks[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Only blanks and line ends part chunks; any other character stays with
        its chunk for the tokenizer to judge.
        """
        if len(self.chunks) > self.most:
            self.chunks.clear()
        plain = [self._plain(text) for text in texts]
        parts = [None if p is None else p.replace("\n", " ").split(" ") for p in plain]
        unknown = set().union(*[p for p in parts if p is not None]).difference(self.chunks)
        if unknown:
            self._learn(unknown)
        of = self.chunks.__getitem__
        return [self._ids([text])[0] if p is None else b"".join(map(of, p)) for text, p in zip(texts, parts, strict=True)]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One table for all tasks of a Python worker."""
    return WordIds(path)


def _token_pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, text_bytes: int, keep: bool) -> Iterator[pa.RecordBatch]:
    import os

    from pyspark import TaskContext

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    words = _word_ids(path)
    ids_of: dict[int, list] = {}  # documents with pieces not yet out: [ids, tokens out so far]

    def documents():
        key = 0
        for batch in batches:
            doc_ids, text = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(text):
                past = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, past + text_bytes)))
                part = [t or "" for t in text.slice(start, stop - start).to_pylist()]
                for doc_id, ids in zip(doc_ids[start:stop], words.encode(part), strict=True):
                    ids += END_ID.to_bytes(4, "little")
                    ids_of[key] = [doc_id, ids, 0]
                    yield key, len(ids) // 4
                    key += 1
                start = stop

    rows: list[tuple] = []
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def out():
        columns = list(zip(*rows, strict=True))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    first = TaskContext.get().partitionId() << 32
    for key, start, length, sequence, offset in pack_partition(documents(), first, window):
        doc = ids_of[key]
        doc_id, ids = doc[0], doc[1]
        rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4, sequence, offset))
        doc[2] += length
        if doc[2] * 4 == len(ids):
            del ids_of[key]
        if len(rows) >= 10_000:
            yield out()
    if rows:
        yield out()
    if not keep:
        words.chunks.clear()
        freed()


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, text_bytes: int = 4_000_000, keep: bool = True
) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``window`` tokens.

    One row per piece. Each input partition is packed on its own in one pass
    and without a shuffle, so the plan is as wide as the scan. ``sequence_id``
    is the partition number times 2**32 plus a count. Null and empty texts hold
    the end id alone. Repeated doc_id values are packed as separate documents.
    Other columns are not read. An empty table gives no rows.

    About ``text_bytes`` are encoded at a time. The table of word ids stays in
    its Python worker for the next task, or if ``keep`` is not set is emptied
    behind each. Neither changes a result.
    """
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return plain.mapInArrow(lambda batches: _token_pieces(batches, tokenizer_path, window, text_bytes, keep), SCHEMA)
