"""Quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good; everything else is unlabelled web
text, a mixture of good and bad. With the share of good texts among the
unlabelled (the class prior) known, the risk of a classifier on bad texts is
that on unlabelled texts less the prior times that on positives; Kiryo et al.
(2017) keep this difference from going below zero, and that risk is minimised
here. The prior comes from the best bin of Garg et al. (2021): no score
threshold can pass fewer unlabelled texts than the prior times the positives
it passes. Labelled bad texts are never read.

The model is additive: each figure of a text falls into one of a few quantile
bins, and each bin has a weight. Figures are taken once from every whole text
and stored; the bin edges, the counts behind the prior and the score that gets
a half (that which the prior's share of all texts exceeds) are statistics of
all texts. Only the weights are fitted on bounded samples.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import compact, crc_bucket, dropped, hash_sample, held_out
from ._words import texts
from .rules import Text

_EMPTY = np.zeros(0, np.uint8)
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

FIGURES = (
    "words", "symbols", "capitals", "exclamations", "bars", "digits", "word_length", "repeats", "same_next",
    "distinct", "duplicate_lines", "line_words", "stops", "controls", "other_ascii",
)

_punctuation = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "#*$%&|<>!.,"])


def figures(data: np.ndarray) -> list[float]:
    """The figures of one text in single precision, each a share or a logarithm; zeros for an empty text."""
    t = Text(data)
    n, seen = t.n_words, t.bytes_seen
    if not n:
        return [0.0] * len(FIGURES)
    words = t.words
    lines, again = t.lines
    letters = max(int(seen[65:91].sum() + seen[97:123].sum()), 1)
    out = [
        np.log1p(n),
        t.n_symbols / n,
        seen[65:91].sum() / letters,
        seen[33] / n,
        seen[124] / n,
        seen[48:58].sum() / n,
        t.word_chars / n,
        t.n_repeat_words / n,
        np.count_nonzero(words[1:] == words[:-1]) / n,
        len(np.unique(words)) / n,
        again / max(lines, 1),
        np.log1p(n / max(lines, 1)),
        (seen[46] + seen[44]) / n,
        (seen[:9].sum() + seen[14:32].sum()) / n,
        seen[_punctuation].sum() / n,
    ]
    return np.array(out, np.float32).tolist()


@dataclass(frozen=True)
class Model:
    edges: list[np.ndarray]
    weights: np.ndarray  # one for each bin of each figure, then the bias
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        """For each row the position of its bin of each figure in ``weights``."""
        out, at = np.empty(x.shape, np.int64), 0
        for j, edges in enumerate(self.edges):
            out[:, j] = at + np.searchsorted(edges, x[:, j], side="right")
            at += len(edges) + 1
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.bins(x)].sum(1) + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -30, 30)))


def class_prior(share_p: np.ndarray, share_u: np.ndarray, n_p: int, n_u: int, least: int = 50) -> float:
    """Best-bin estimate of the share of positives among the unlabelled.

    ``share_p`` and ``share_u`` are the shares of ``n_p`` positives and ``n_u``
    unlabelled texts at or above each of some thresholds. The bin is the one with the
    smallest ratio of the two, with a confidence margin for the counts;
    thresholds that pass fewer than ``least`` positives are not looked at.
    """
    margin = np.sqrt(np.log(40) / 2 / n_u) + np.sqrt(np.log(40) / 2 / n_p)
    usable = share_p * n_p >= min(least, n_p)
    bound = (share_u + margin) / np.maximum(share_p, 1e-9)
    best = np.flatnonzero(usable)[np.argmin(bound[usable])]
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.98))


SHARES = np.sort(np.concatenate([np.linspace(0, 1, 9)[1:-1], [0.01, 0.03, 0.97, 0.99]]))


def _edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, SHARES)) for c in x.T]


def _counts(scores: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many ``scores`` lie below the first of the sorted ``cuts``, from each to the next, and from the last on."""
    return np.bincount(np.searchsorted(cuts, scores, side="right"), minlength=len(cuts) + 1)


def minimise(
    positive: np.ndarray, unlabelled: np.ndarray, edges: list[np.ndarray], prior: float,
    steps: int = 600, rate: float = 0.05, ridge: float = 1e-4, nonnegative: bool = True,
) -> Model:
    """Weights of least non-negative PU risk with the logistic loss, by Adam on the whole sample."""
    model = Model(edges, np.zeros(sum(len(e) + 1 for e in edges) + 1), prior)
    at_p, at_u = model.bins(positive), model.bins(unlabelled)
    w = model.weights
    size, m, v = len(w), np.zeros(len(w)), np.zeros(len(w))

    def gradient(at: np.ndarray, g: np.ndarray) -> np.ndarray:
        out = np.bincount(at.ravel(), np.repeat(g, at.shape[1]), size)
        out[-1] = g.sum()
        return out

    for step in range(1, steps + 1):
        z_p, z_u = w[at_p].sum(1) + w[-1], w[at_u].sum(1) + w[-1]
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        as_bad = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        good = gradient(at_p, prior * (s_p - 1) / len(s_p))
        bad = gradient(at_u, s_u / len(s_u)) - gradient(at_p, prior * s_p / len(s_p))
        # below zero the risk on bad texts is overfitted: step back on that part alone
        g = (good + bad if as_bad >= 0 or not nonnegative else -bad) + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _flat(edges: list[np.ndarray]) -> Model:
    """The model that knows nothing: a half for every text."""
    return Model(edges, np.zeros(sum(len(e) + 1 for e in edges) + 1), 0.5)


def fit(positive: np.ndarray, unlabelled: np.ndarray, aside: np.ndarray, edges: list[np.ndarray] | None = None, cells=None, quantile=None) -> Model:
    """Prior, weights and threshold from figures.

    The prior is estimated twice, by a first model fitted on ``positive`` from
    the positives ``aside`` and the other way round (on the halves of
    ``positive``, if there are none aside); each estimate is a bound, so the
    smaller one counts. ``edges`` are the bin edges, ``cells(model, cuts)``
    counts all unlabelled texts in the cells between ``cuts``, and
    ``quantile(model, share)`` is a quantile of all their scores; by default
    each is taken from ``unlabelled``.
    """
    base = unlabelled if len(unlabelled) else positive
    if edges is None:
        edges = _edges(base) if len(base) else [np.zeros(0)] * base.shape[1]
    if not len(positive) or not len(unlabelled):
        return _flat(edges)
    both = np.concatenate([positive, aside])
    if not len(aside):
        positive, aside = positive[::2], positive[1::2] if len(positive) > 1 else positive
    prior = 1.0
    for known, other in ((positive, aside), (aside, positive)):
        first = minimise(known, unlabelled, edges, 0.5, steps=200)
        cuts = np.unique(first.raw(other))
        n_p = _counts(first.raw(other), cuts)
        n_u = cells(first, cuts) if cells else _counts(first.raw(unlabelled), cuts)
        share_p, share_u = (1 - np.cumsum(n)[:-1] / n.sum() for n in (n_p, n_u))
        prior = min(prior, class_prior(share_p, share_u, int(n_p.sum()), int(n_u.sum())))
    model = minimise(both, unlabelled, edges, prior)
    share = 1 - model.prior
    half = quantile(model, share) if quantile else float(np.quantile(model.raw(unlabelled), share))
    return replace(model, shift=-half)


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [figures(_EMPTY if d is None else d) for d in texts(batch.column(3))]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(rows, pa.list_(pa.float32()))], ["doc_id", "held_out", "mark", "figures"])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, mark, figures) for every row of ``docs``, stored; ``mark`` is a hash of id and text."""
    plain = docs.select(F.col("doc_id").cast("long"), held_out("doc_id"), F.xxhash64("doc_id", "text").alias("mark"), "text")
    return compact(plain.mapInArrow(_figures, "doc_id long, held_out boolean, mark long, figures array<float>"), "figures")


def _figures_of(sample: list[list[float]]) -> np.ndarray:
    return np.array(sample, np.float64).reshape(-1, len(FIGURES))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(FIGURES))


#: Figures are tallied by the upper 18 bits of their single-precision form (steps of 0.2 %), scores in steps of 0.001.
_DROPPED_BITS = 14
_STEP = 0.001


def _figure_cells(column: pa.Array) -> np.ndarray:
    """One number for each figure of each text: its place in FIGURES and its cell; figures are not negative."""
    bits = column.flatten().to_numpy(zero_copy_only=False).view(np.int32).reshape(-1, len(FIGURES)) >> _DROPPED_BITS
    return (bits.astype(np.int64) + (np.arange(len(FIGURES)) << 32)).ravel()


def _tallied(batches: Iterator[pa.RecordBatch], cells: Callable[[pa.Array], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cell, n = np.unique(cells(batch.column(0)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(n.astype(np.int64))], ["cell", "n"])


def _tally(found: DataFrame, cells: Callable[[pa.Array], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(cells in order, rows in each) over all of ``found``: whole numbers, so the same however the table is split."""
    counted = found.select("figures").mapInArrow(lambda b: _tallied(b, cells), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    pairs = sorted((r[0], r[1]) for r in counted.collect())  # a row for each cell, whose number does not grow with the table
    out = np.array(pairs, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def _quantiles(cells: np.ndarray, n: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The cells in which the ``shares`` of the rows are reached."""
    total = np.cumsum(n)
    return cells[np.searchsorted(total, shares * total[-1])]


def _learned(found: DataFrame, labels: DataFrame, good_rows: int, unlabelled_rows: int) -> Model:
    sample = lambda df, n: [r[0] for r in hash_sample(df, n, "mark", "doc_id", "figures").select("figures").toLocalIterator()]
    good = labels.where((crc_bucket("doc_id") != 0) & (F.col("quality") == 1)).select("doc_id").distinct()
    # at most good_rows ids, so the broadcast has a fixed bound
    good = F.broadcast(hash_sample(good, good_rows, "doc_id"))
    positive = sample(found.join(good, "doc_id", "left_semi"), good_rows)
    parts = [_figures_of(rows) for rows in (positive[::2], sample(found, unlabelled_rows), positive[1::2])]
    cell, n = _tally(found, _figure_cells)
    edges = []
    for j in range(len(FIGURES)):
        own = cell >> 32 == j
        low = _quantiles(cell[own] & 0xFFFFFFFF, n[own], SHARES) if own.any() else np.zeros(0, np.int64)
        edges.append(np.unique((low << _DROPPED_BITS).astype(np.int32).view(np.float32).astype(np.float64)))

    def cells(model: Model, cuts: np.ndarray) -> np.ndarray:
        cell, n = _tally(found, lambda c: np.searchsorted(cuts, model.raw(_matrix(c)), side="right"))
        return np.bincount(cell, n, len(cuts) + 1)

    def quantile(model: Model, share: float) -> float:
        cell, n = _tally(found, lambda c: np.floor(model.raw(_matrix(c)) / _STEP).astype(np.int64))
        return float(_quantiles(cell, n, np.array([share]))[0]) * _STEP

    return fit(*parts, edges, cells, quantile)


def learn(docs: DataFrame, labels: DataFrame, good_rows: int = 3000, unlabelled_rows: int = 20_000) -> Model:
    """Fit on the figures of all ``docs`` and of at most ``good_rows`` labelled good rows.

    Labels of the held-out fold (crc32 of the id, mod 5, is 0) are not read.
    Bin edges, prior and threshold are statistics of all rows, texts of any
    length included. The weights' risk on unlabelled texts is that of
    ``unlabelled_rows`` rows, taken in the order of a hash of id and text,
    however the table is split. An empty table or no labels give the flat model.
    """
    found = measured(docs)
    model = _learned(found, labels, good_rows, unlabelled_rows)
    dropped(found)
    return model


def _scores(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = model.score(_matrix(batch.column(2)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            [f.split()[0] for f in SCHEMA.split(", ")],
        )


def _kept(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [figures(_EMPTY if d is None else d) for d in texts(batch.column(batch.schema.get_field_index("text")))]
        yield batch.filter(pa.array(model.score(_figures_of(rows)) >= threshold))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: Model | None = None) -> DataFrame:
    """Score every whole text of ``docs``: one narrow pass over the texts, then passes over their figures.

    Empty and null texts have zero figures and are scored as such. Repeated
    doc_id values get a row each, a null doc_id is not held out; other columns
    are not read; an empty table gives no rows. Without labels every score is a
    half.
    """
    found = measured(docs)
    model = model or _learned(found, labels, 3000, 20_000)
    return found.select("doc_id", "held_out", "figures").mapInArrow(lambda b: _scores(b, model, threshold), SCHEMA)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` scored at ``threshold`` or above, with all their columns.

    Null and empty texts are scored by their zero figures; repeated rows share
    a fate; an empty table stays empty.
    """
    model = model or learn(docs, labels)
    return docs.mapInArrow(lambda b: _kept(b, model, threshold), docs.schema)
