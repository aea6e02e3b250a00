"""Main text of web pages, with nearest-URL page differencing.

A page is cut into blocks (paragraphs, headings, list items, table rows).
Containers that HTML or their own names mark as navigation, adverts, notices,
forms or comments are left out. What templates put on many pages of a site is
found by differencing: pages are paired with their neighbours by URL path
within their host, their lines are aligned by longest common subsequence, and
shared lines are deleted. Lines inside an ``article`` or ``main`` element go
only when two neighbours with different articles share them, as copies of one
article on two pages would otherwise delete each other; for the same reason a
neighbour that is a copy or near copy of the page is no evidence and the
search goes on to the nearest page that differs enough.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import partitions

SCHEMA = "page_id long, url string, text string, n_chars long"

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>|<(script|style|noscript|template|textarea|svg|math|iframe|object|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_attribute = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot"
    " thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head nav footer aside form button dialog menu label input".split())
#: Elements whose class and id names are read.
CONTAINERS = frozenset("article aside center details div dl fieldset figure footer header ol section table ul".split())
#: Words in class and id names of containers that are not main text.
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright disclaimer disqus footer hidden login masthead menu modal nav navbar navigation"
    " newsletter notice overlay pager pagination popup promo promoted promotion recommended related replies reply"
    " respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget"
    " widgets".split()
)
#: Words that may stand beside those in one name; with any other word it names a subject, as in related-work.
BESIDE = frozenset(
    "area articles bar block bottom box btn button buttons center column container content fixed form global google group header icon icons inline inner"
    " items label left links list main message mobile more news outer page panel post posts primary right row secondary section site slot stories text"
    " thread top unit wrap wrapper".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_AUTOCLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_words = re.compile(r"[a-z]+|[A-Z][a-z]*").findall


def _is_left_out(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in LEFT_OUT or tag == "header" and not in_main:
        return True
    if not attributes.strip():
        return False
    for m in _attribute.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name in ("class", "id"):
            if tag not in CONTAINERS:
                continue
            for part in value.split():
                words = {w.lower() for w in _words(part)}
                if words & NAMES and words <= NAMES | BESIDE and not (tag == "article" and not words & {"comment", "comments", "reply", "ad", "advert", "promo", "related"}):
                    return True
        elif name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, whether inside article or main) of the blocks of a page, in order.

    White space inside a block is one space. Left-out containers give nothing;
    an ``article`` or ``main`` that opens inside one that was never closed
    counts as outside it.
    """
    out: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, left out, inside main
    piece: list[str] = []
    skip = main = False
    at = 0

    def flush() -> None:
        if piece:
            text = " ".join(_html.unescape("".join(piece)).split())
            piece.clear()
            if text:
                out.append((text, main))

    for m in _markup.finditer(page):
        if not skip and m.start() > at:
            piece.append(page[at : m.start()])
        at = m.end()
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):  # an end tag closes down to its start tag, if there is one
            if tag in BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    skip, main = stack[-1][1:] if stack else (False, False)
                    break
            continue
        if tag in BLOCKS:
            flush()
            while stack and stack[-1][0] == "p":
                stack.pop()
                skip, main = stack[-1][1:] if stack else (False, False)
        elif tag in ("br", "td", "th"):
            piece.append(" ")
        if tag in VOID or m.group(4).rstrip().endswith("/"):
            continue
        if tag in _AUTOCLOSE and stack and stack[-1][0] in _AUTOCLOSE[tag]:
            stack.pop()
            skip, main = stack[-1][1:] if stack else (False, False)
        left_out = _is_left_out(tag, m.group(4), main)
        if tag in ("article", "main") and not left_out:
            skip = any(name not in ("nav", "header", "aside", "div", "ul", "form", "head") and out_ for name, out_, _ in stack)
            main = True
        skip = skip or left_out
        stack.append((tag, skip, main))
    if not skip and at < len(page):
        tail = page[at:]
        cut = tail.find("<")  # a tag that the page's end cuts off
        piece.append(tail if cut < 0 or not re.match(r"<[/!a-zA-Z]", tail[cut:]) else tail[:cut])
    flush()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``.

    Hunt and Szymanski's way: the longest rising run of matching positions of
    ``b``, each line's matches tried from the last to the first.
    """
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    links: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    found, link = set(), links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def evidence(own: list[tuple[str, bool]], other: list[tuple[str, bool]]) -> set[int] | None:
    """Positions of the lines of ``own`` that ``other`` shares, or None if ``other`` is a copy or near copy of it.

    A near copy holds four fifths of the page's characters, or holds half of
    them and little else, as a print version does.
    """
    shared = common_lines([text for text, _ in own], [text for text, _ in other])
    both = sum(len(own[i][0]) for i in shared)
    mine, theirs = (sum(len(text) for text, _ in x) for x in (own, other))
    if len(shared) == len(own) or 5 * both >= 4 * mine or 5 * both >= 4 * theirs and 2 * both >= mine:
        return None
    return shared


def main_text(own: list[tuple[str, bool]], neighbours: list[list[tuple[str, bool]]]) -> str:
    """Blocks of a page less the lines that differencing finds to be the site's.

    Outside ``article`` and ``main`` one neighbour that shares the line is
    enough. Inside, two are needed that are no near copies of each other.
    Near copies of the page itself are no evidence.
    """
    gone: set[int] = set()
    differing = [(other, shared) for other in neighbours if (shared := evidence(own, other)) is not None]
    for _, shared in differing:
        gone |= {i for i in shared if not own[i][1]}
    for k, (other, shared) in enumerate(differing):
        for another, too in differing[:k]:
            inside = {i for i in shared & too if own[i][1]}
            if inside and evidence(other, another) is not None and evidence(another, other) is not None:
                gone |= inside
    if len(gone) == len(own):
        gone = set()
    return "\n\n".join(text for i, (text, _) in enumerate(own) if i not in gone)


class _Page:
    """A page with the blocks of the nearest pages before and behind it that are no near copies of it."""

    __slots__ = ("page_id", "url", "site", "own", "guest", "before", "behind", "links")

    def __init__(self, page_id, url, site, own, guest):
        self.page_id, self.url, self.site, self.own, self.guest = page_id, url, site, own, guest
        self.before: list[list] = []
        self.behind: list[list] = []
        self.links: list[_Page] = []  # the pages of ``before``


def paired(pages: Iterator[_Page], reach: int) -> Iterator[_Page]:
    """``pages``, sorted by site and path, each once it has ``reach`` differing neighbours on either side or its site ends.

    From a near copy the search goes on with what that one found, so a run of
    copies costs no more than other pages do; only pages that have met nothing
    but near copies behind them are kept waiting.
    """
    last: _Page | None = None
    waiting: list[_Page] = []

    def ended() -> Iterator[_Page]:
        for page in waiting:
            if not page.behind and evidence(page.own, last.own) is not None:
                page.behind.append(last.own)
            yield page
        waiting.clear()

    for page in pages:
        if last is not None and page.site != last.site:
            yield from ended()
            last = None
        if last is not None and page.own == last.own:
            page.own, page.before, page.links = last.own, last.before, last.links
        elif last is not None:
            for other in [last, *last.links, *(x for link in last.links for x in link.links)]:
                if len(page.links) < reach and evidence(page.own, other.own) is not None:
                    page.links.append(other)
                    page.before.append(other.own)
            for link in page.links:
                for x in link.links:
                    x.links = []  # no longer chain is kept
            if evidence(last.own, page.own) is not None:
                differs: dict[int, bool] = {}
                still = []
                for x in waiting:
                    if id(x.own) not in differs:
                        differs[id(x.own)] = evidence(x.own, page.own) is not None
                    if differs[id(x.own)]:
                        x.behind.append(page.own)
                    if len(x.behind) < reach:
                        still.append(x)
                    else:
                        yield x
                waiting[:] = still
        if not page.guest:
            waiting.append(page)
        last = page
    yield from ended()


def _extracted(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Texts of pages that come sorted by range, host and path."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = (pa.int64(), pa.string(), pa.string(), pa.int64())
    rows: list[tuple] = []

    def pages():
        for batch in batches:
            for page_id, url, source, host, in_range, guest in zip(*batch.columns, strict=True):
                site = (in_range.as_py(), host.as_py())
                yield _Page(page_id.as_py(), url.as_py(), site, blocks(source.as_py() or ""), guest.as_py())

    def out():
        columns = list(zip(*rows, strict=True))
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for page in paired(pages(), reach):
        text = main_text(page.own, page.before + page.behind)
        rows.append((page.page_id, page.url, text, len(text)))
        if len(rows) >= 500:
            yield out()
    if rows:
        yield out()


_KEY = ("host", "path", "at_id", "at_url")
_PATHS, _ROWS = 8, 64


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted range of keys: the first, the last of its head and the first of its tail.

    Head and tail are the ``_PATHS`` outermost paths of the host there, at most ``_ROWS`` pages.
    """

    def inner(keys: list[tuple]) -> tuple | None:
        paths, found = set(), None
        for key in keys:
            paths.add(key[1])
            if key[0] != keys[0][0] or len(paths) > _PATHS:
                break
            found = key
        return found

    head, tail = [], deque(maxlen=_ROWS)
    for batch in batches:
        for key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(head) < _ROWS:
                head.append(key)
            tail.append(key)
    if head:
        keys = [head[0], inner(head), inner([*reversed(tail)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([[k[i] for k in keys]], pa.list_(pa.int64() if i == 2 else pa.string())) for i in range(4)], list(_KEY)
        )


def _ranges(bounds: list[tuple[tuple, tuple, tuple]]):
    """For a key, 2 x its range, and 2 x range + 1 for a neighbouring range that sees it as a guest."""
    firsts, heads, tails = (list(x) for x in zip(*bounds, strict=True))

    @F.arrow_udf("array<int>")
    def dealt(host: pa.Array, path: pa.Array, at_id: pa.Array, at_url: pa.Array) -> pa.Array:
        out = []
        for key in zip(*(c.to_pylist() for c in (host, path, at_id, at_url)), strict=True):
            i = max(0, bisect_right(firsts, key) - 1)
            to = [2 * i]
            if i and key <= heads[i]:
                to.append(2 * i - 1)
            if i + 1 < len(firsts) and key >= tails[i]:
                to.append(2 * i + 3)
            out.append(to)
        return pa.array(out, pa.list_(pa.int32()))

    return dealt


def extract(pages: DataFrame, reach: int = 1) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html).

    Pages are dealt in ranges of host, path and page_id, so that neighbours by
    URL lie side by side and a host with very many pages spreads over tasks;
    each is compared with the ``reach`` nearest pages of its host on either
    side that are no near copies of it. The bounds come from a pass over the
    keys; the outermost 8 paths (at most 64 pages) of a range also go to the
    range next to it, as neighbours only. Null and empty html gives an empty
    text, a null url is a host of its own name "". Repeated rows each get a
    row; other columns are not read.
    """
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    page_id = F.col("page_id").cast("long")
    at_id = F.coalesce(page_id, F.lit(-(1 << 63)))
    rows = pages.select(page_id.alias("page_id"), "url", "html", host.alias("host"), path.alias("path"), at_id.alias("at_id"), url.alias("at_url"))
    count = pages.count()
    n = min(max(partitions(pages), count // 2000 + 1), count // 50 + 1)
    in_order = rows.select(*_KEY).repartitionByRange(n, *_KEY).sortWithinPartitions(*_KEY)
    schema = ", ".join(f"{k} array<{'long' if k == 'at_id' else 'string'}>" for k in _KEY)
    bounds = sorted(tuple(zip(*r, strict=True)) for r in in_order.mapInArrow(_edges, schema).collect())
    if not bounds:
        bounds = [(("", "", 0, ""),) * 3]
    to = F.explode(_ranges(bounds)(*_KEY)).alias("to")
    near = rows.select("*", to).withColumns({"range": F.expr("to div 2").cast("int"), "guest": F.col("to") % 2 == 1})
    near = near.repartitionById(len(bounds), "range").sortWithinPartitions("range", *_KEY)
    return near.select("page_id", "url", "html", "host", "range", "guest").mapInArrow(lambda b: _extracted(b, reach), SCHEMA)
