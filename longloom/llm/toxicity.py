"""Toxicity by compression distance.

Two zstandard dictionaries are trained with zstandard's cover algorithm on
labelled texts, one for each class. The ordinary one is trained on the distinct
words of ordinary texts, the toxic one on those words of toxic texts that these
hold far oftener. A window of a text is compressed twice, with the ordinary
dictionary and with both of them; the bytes that the toxic one saves are the
window's distance. As the two sides share the ordinary part, windows of common
words differ by little. The distances of all windows of a text give five
figures, and a logistic curve over these, fitted on labelled texts that the
dictionaries have not seen, calibrates the threshold.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import crc_bucket, hash_sample, held_out
from ._words import mix, shingles

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_words = re.compile(rb"[^\x20\x09-\x0D]+").findall


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # bias first
    window_words: int = 16
    level: int = 6
    min_match: int = 5


def spaced_words(text: str) -> list[bytes]:
    """Words lower-cased and led by a space, so that a match can hold on to a word's start."""
    return [b" " + w for w in _words(text.lower().encode())]


def distinct(texts: list[str]) -> list[str]:
    """``texts`` without near copies of earlier ones, so that a copied text is evidence once.

    Near copies are texts that share one of four minima over their three-word shingles.
    """
    seen: set[tuple[int, int]] = set()
    out = []
    for text in texts:
        found = shingles(np.frombuffer(text.encode(), np.uint8), 3)
        if len(found):
            keys = {(j, int(mix(found + np.uint64(7919 * j)).min())) for j in range(4)}
            if seen.isdisjoint(keys):
                out.append(text)
            seen |= keys
    return out


def trained(samples: list[bytes], size: int, d: int, k: int) -> bytes:
    """A dictionary of at most ``size`` bytes by zstandard's cover algorithm (d-mers in segments of k bytes).

    The trainer wants several samples; what it refuses is a dictionary as it stands.
    """
    import zstandard

    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, d=d, k=k).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionaries(toxic: list[str], ordinary: list[str], toxic_bytes: int, ordinary_bytes: int, evidence: float) -> tuple[bytes, bytes]:
    """Trained dictionaries (ordinary, toxic) from labelled texts.

    A sample is the distinct words of one text. Those for the toxic dictionary
    are kept if toxic texts hold them over five times as often, with a
    likelihood ratio of at least ``evidence``.
    """
    of_toxic, of_ordinary = ([set(spaced_words(t)) for t in distinct(texts)] for texts in (toxic, ordinary))
    seen_t, seen_o = Counter(), Counter()
    for words in of_toxic:
        seen_t.update(words)
    for words in of_ordinary:
        seen_o.update(words)
    n_t, n_o = len(of_toxic), len(of_ordinary)

    def ratio(word: bytes) -> float:
        """Twice the log likelihood ratio of two Poisson rates against one."""
        x, y = seen_t[word], seen_o[word]
        expected = (x + y) / (n_t + n_o)
        return 2 * (x * math.log(x / (expected * n_t)) + (y * math.log(y / (expected * n_o)) if y else 0))

    marks = {w for w, x in seen_t.items() if x > 1 and x * n_o > 5 * seen_o[w] * n_t and ratio(w) >= evidence}
    plain = trained([b"".join(sorted(words)) for words in of_ordinary], ordinary_bytes, 6, 16)
    return plain, trained([b"".join(sorted(words & marks)) for words in of_toxic], toxic_bytes, 8, 12)


class Distance:
    def __init__(self, model: Model):
        import zstandard

        self.n = model.window_words
        parameters = zstandard.ZstdCompressionParameters.from_level(
            model.level, window_log=17, min_match=model.min_match, write_content_size=0, write_dict_id=0,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        )
        compressors = []
        for data in (model.ordinary, model.ordinary + model.toxic):
            if len(data) >= 8:
                d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=parameters)
                compressors.append(zstandard.ZstdCompressor(dict_data=d, compression_params=parameters).compress)
            else:
                compressors.append(zstandard.ZstdCompressor(compression_params=parameters).compress)
        self.ordinary, self.toxic = compressors

    def figures(self, text: str) -> np.ndarray:
        """Largest, mean of the three largest, mean, mean excess over 2 bytes, and share of 3 bytes or more."""
        words = spaced_words(text)
        windows = [b"".join(words[i : i + self.n]) for i in range(0, len(words), self.n)]
        if not windows:
            return np.zeros(5)
        a, b = self.ordinary, self.toxic
        d = np.sort([len(a(w)) - len(b(w)) for w in windows])[::-1]
        return np.array([d[0], d[:3].mean(), d.mean(), np.maximum(d - 2, 0).mean(), (d >= 3).mean()])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps for a logistic curve; returns weights on the raw figures, bias first."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return np.concatenate([[w[0] - (w[1:] * mean / scale).sum()], w[1:] / scale])


def fit(
    toxic: list[str], ordinary: list[str], toxic_bytes: int = 2_000, ordinary_bytes: int = 60_000, evidence: float = 20.0
) -> Model:
    """Dictionaries from one half of the texts, the curve from the other.

    Texts alternate between the halves in the given order. Without texts of
    either label the scores are 0.
    """
    half = dictionaries(toxic[::2], ordinary[::2], toxic_bytes, ordinary_bytes, evidence)
    bare = Model(*half, weights=())
    if not toxic or not ordinary:
        return Model(*half, weights=(-30.0, 0, 0, 0, 0, 0))
    distance = Distance(bare)
    rest = [(t, 1) for t in toxic[1::2] or toxic] + [(t, 0) for t in ordinary[1::2] or ordinary]
    x = np.array([distance.figures(t) for t, _ in rest])
    return Model(*half, weights=tuple(_logistic(x, np.array([y for _, y in rest], float)).tolist()))


def _scores(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    distance, w = Distance(model), np.array(model.weights)
    for batch in batches:
        x = np.array([distance.figures(t.as_py() or "") for t in batch.column(2)]).reshape(-1, 5)
        score = 1 / (1 + np.exp(-np.clip(x @ w[1:] + w[0], -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            [f.split()[0] for f in SCHEMA.split(", ")],
        )


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int], max_chars: int) -> dict[int, list[str]]:
    """Texts by label value: those of the learning folds, at most ``rows[value]`` each.

    Rows are taken in the order of a hash, so the sample does not depend on how
    the tables are split. Its bound keeps it fit for the driver: at most
    sum(rows) texts, none over ``max_chars`` characters.
    """
    learn = labels.where((crc_bucket("doc_id") != 0) & F.col(label).isin(*rows))
    learn = learn.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    # at most sum(rows) ids, so the broadcast has a fixed bound and no text is shuffled
    picked = [hash_sample(learn.where(F.col("y") == v), n, "doc_id") for v, n in rows.items()]
    wanted = F.broadcast(reduce(DataFrame.unionByName, picked))
    texts = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", "text")
    both = texts.join(wanted, "doc_id")
    out = {}
    for value, most in rows.items():
        found = both.where(F.col("y") == value).select(F.xxhash64("text").alias("h"), "doc_id", "text").orderBy("h", "doc_id").limit(most)
        out[value] = [r[2] for r in found.toLocalIterator()]
    return out


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, toxic_rows: int = 1200, ordinary_rows: int = 4000, max_chars: int = 20_000
) -> DataFrame:
    """Score every whole text of ``docs``; learn from labelled rows outside the held-out fold.

    The model is fitted on at most ``toxic_rows + ordinary_rows`` texts of at
    most ``max_chars`` characters; scoring is one narrow pass over all rows.
    Empty and null texts get the score of no evidence. Repeated doc_id values
    get a row each, and a null doc_id is not held out; rows without a label, and labels without a row, do no harm.
    """
    found = sample_labelled(docs, labels, "toxic", {1: toxic_rows, 0: ordinary_rows}, max_chars)
    model = fit(found[1], found[0])
    plain = docs.select(F.col("doc_id").cast("long"), held_out("doc_id"), F.col("text"))
    return plain.mapInArrow(lambda b: _scores(b, model, threshold), SCHEMA)
