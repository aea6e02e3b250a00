"""What the sample viewers need to know about a rendered sample."""

from __future__ import annotations

import re


def chunk_starts(text: str, n: int) -> list[int]:
    """Where the chunks labelled [1] to [n] begin, in increasing order.

    A label stands at the start or after a blank line; one may also occur there inside a chunk. Of all increasing choices, one that
    makes the shortest chunk as long as can be is taken: the length is found by
    bisection, and for a given length the earliest places that keep it are
    tried. If no choice is possible the labels are taken one after another
    where they first follow.
    """
    places: list[list[int]] = [[] for _ in range(n)]
    for m in re.finditer(r"(?:\A|(?<=\n\n))\[(\d+)\] ", text):
        if 1 <= int(m.group(1)) <= n:
            places[int(m.group(1)) - 1].append(m.start())

    def choose(least: int) -> list[int] | None:
        out: list[int] = []
        for options in places:
            after = out[-1] + least if out else 0
            at = next((p for p in options if p >= after), None)
            if at is None:
                return None
            out.append(at)
        return out if not out or len(text) - out[-1] >= least else None

    if not n:
        return []
    best = choose(1)
    if best is None:
        out, at = [], 0
        for options in places:
            at = next((p for p in options if p >= at), at)
            out.append(at)
        return out
    low, high = 1, len(text)
    while low < high:
        middle = (low + high + 1) // 2
        found = choose(middle)
        if found is None:
            high = middle - 1
        else:
            low, best = middle, found
    return best
