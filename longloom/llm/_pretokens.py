"""Values of whole texts as joins over their pre-tokens, with chunks remembered.

Where no two white-space characters meet, the pattern never joins across a
single space except to take that space in front of the next match, so a text
may be cut before each of its spaces and the cuts handled one by one. Chunks
repeat far more than texts, and are kept in tables of bounded size; filling up
empties a table, which changes the work but not the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_two_spaces = re.compile(r"\s\s").search


class ChunkValues:
    """``join`` over ``value(pre-token)`` for the pre-tokens of a text, in order."""

    def __init__(self, pattern: str, value: Callable, join: Callable, most: int = 600_000):
        import regex

        self.split = regex.compile(pattern).findall
        self.value, self.join, self.most = value, join, most
        self.words: dict = {}
        self.chunks: dict = {}

    def _of(self, chunk: str):
        words, out = self.words, []
        for w in self.split(chunk):
            v = words.get(w)
            if v is None:
                if len(words) >= self.most:
                    words.clear()
                v = words[w] = self.value(w)
            out.append(v)
        return self.join(out)

    def __call__(self, text: str):
        if _two_spaces(text):
            return self._of(text)
        chunks, parts = self.chunks, text.split(" ")
        head = self._of(parts[0])
        rest = parts[1:]
        try:
            return self.join([head, *map(chunks.__getitem__, rest)])
        except KeyError:
            pass
        if len(chunks) >= self.most:
            chunks.clear()
        out = [head]
        for c in rest:
            v = chunks.get(c)
            if v is None:
                v = self._of(" " + c)
                if "\n" not in c:
                    chunks[c] = v
            out.append(v)
        return self.join(out)
