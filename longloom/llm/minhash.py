"""Near-duplicate documents by circulant MinHash, confirmed by exact Jaccard similarity.

Two permutations make all coordinates of a signature (Li and Li, C-MinHash,
2021): the first scatters the shingles over D places, the second, shifted
circularly by one place for each coordinate, ranks them; a coordinate is the
smallest rank. In memory the shifted copies of a rank lie side by side, so a
shingle costs one read of a row of neighbours.

Documents with equal shingle sets are folded into one class, then:

1. signatures are cut into bands; classes that agree in a band share a bucket;
2. in rounds, each class is checked on the full shingle sets against one member
   of the largest component of one of its buckets, and confirmed links are
   joined to components, as long as that spares step 3 much of its work;
3. where a bucket still holds more than one component, signatures are compared
   block against block, and classes that look similar to one of another
   component meet there once more with their whole texts: all pairs across
   components are decided by exact intersection sizes.

No pair ever becomes a row: a round tries one pair for each class, and a block
returns the edges of a spanning forest. Step 3 leaves no bucket pair across
components out. Rows of a bucket's largest component meet the others only, not
each other, so what step 2 has joined costs no more comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._groups import root, sorted_groups
from ._shared import compact, components, dropped, partitions, unused
from ._words import mix, shingles, texts

D = 1 << 20
#: log2 of the places in use: a text of 2 million shingles still leaves most of them empty.
PLACE_BITS = 22
_EMPTY = np.zeros(0, np.uint8)


@cache
def _ranks(size: int, places: int, seed: int) -> np.ndarray:
    """The second permutation as a view: at each place its ranks under ``size`` shifts, side by side."""
    ranks = np.random.default_rng(seed).permutation(places).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[:size]]), size)


class Circulant:
    """Signatures of ``bands * rows`` coordinates over ``places`` (a power of two) places."""

    def __init__(self, bands: int, rows: int, seed: int = 7, places: int = D):
        self.bands, self.rows, self.size, self.seed, self.places = bands, rows, bands * rows, seed, places
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def signature(self, found: np.ndarray) -> np.ndarray:
        """Smallest ranks over the shingles ``found``, one for each shift."""
        # the first permutation: an odd multiple modulo 2**64, of which the top bits are the place
        places = ((found * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - self.places.bit_length())).astype(np.int64)
        out, shifted = np.full(self.size, self.places, np.uint32), _ranks(self.size, self.places, self.seed)
        for i in range(0, len(places), 1024):
            np.minimum(out, shifted[places[i : i + 1024]].min(0), out=out)
        return out

    def buckets(self, signature: np.ndarray) -> np.ndarray:
        """One fingerprint for each band, different between bands."""
        rows = signature.reshape(self.bands, self.rows).astype(np.uint64)
        h = self.salt.copy()
        for j in range(self.rows):
            h = mix(h * np.uint64(31) + rows[:, j])
        return h


def _signatures(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, a, b, signature): a and b fingerprint the whole set."""
    minhash = Circulant(bands, rows, places=1 << PLACE_BITS)
    for batch in batches:
        n, a, b, signatures = [], [], [], []
        for data in texts(batch.column(1)):
            found = shingles(_EMPTY if data is None else data, size)
            n.append(len(found))
            with np.errstate(over="ignore"):
                a.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)) if len(found) else None)
                b.append(int(np.bitwise_xor.reduce(mix(found + np.uint64(1))).view(np.int64)) if len(found) else None)
            signatures.append(minhash.signature(found).astype(np.uint16).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(signatures, pa.binary())],
            ["doc_id", "n_shingles", "a", "b", "signature"],
        )


def _banded(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(bucket, id, n) for each band of each class."""
    minhash = Circulant(bands, rows)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        h = [minhash.buckets(np.frombuffer(s.as_py(), np.uint16)).view(np.int64) for s in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(h)), pa.array(np.repeat(ids, bands)), pa.array(np.repeat(n, bands).astype(np.int32))], ["bucket", "id", "n"]
        )


def _verified(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) whose sets pass; the last sets met are kept, as pairs come sorted by u."""
    last_text, last_set = None, None
    for batch in batches:
        keep = []
        for one, other in zip(texts(batch.column("u_text")), texts(batch.column("v_text")), strict=True):
            raw = one.tobytes()
            if raw != last_text:
                last_text, last_set = raw, shingles(one, size)
            found = shingles(other, size)
            both = len(np.intersect1d(last_set, found, assume_unique=True))
            keep.append(bool(len(found)) and 100 * both >= percent * (len(last_set) + len(found) - both))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


_DEALT = ["bucket", "one", "two"]


def _halves(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rows of a group's first block, and of its second (the same rows where both are one block)."""
    one, two = group.column("one")[0].as_py(), group.column("two")[0].as_py()
    block = group.column("block").to_numpy()
    rows = np.flatnonzero(block == one)
    return rows, rows if one == two else np.flatnonzero(block == two)


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The rows (bucket, one, two, block, id, component_id) of two blocks of a bucket whose signature agrees in a
    share of ``least`` with a row of the other block and another component."""
    keep = [*_DEALT, "block", "id", "component_id"]
    for group in sorted_groups(batches, _DEALT):
        if group.num_rows < 2:
            continue
        comp = group.column("component_id").to_numpy()
        signatures = np.stack([np.frombuffer(s.as_py(), np.uint16) for s in group.column("signature")])
        rows, cols = _halves(group)
        near = np.zeros(group.num_rows, bool)
        for i in rows:
            across = cols[comp[cols] != comp[i]]
            if len(across):
                similar = across[(signatures[across] == signatures[i]).mean(1) >= least]
                near[similar] = True
                near[i] |= len(similar) > 0
        if near.any():
            yield from group.select(keep).filter(pa.array(near)).to_batches()


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of ``sets`` (of distinct values): products of 0-1 matrices.

    Only values that two sets hold can count; they are taken ``columns`` at a time.
    """
    n = len(sets)
    out = np.zeros((n, n), np.int64)
    if not n:
        return out
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, value, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    at = shared[value]
    owner, value = owner[at], place[value[at]]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    for low in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(value, [low, low + columns])
        held = np.zeros((n, columns), np.float32)
        held[owner[a:b], value[a:b] - low] = 1
        out += (held @ held.T).astype(np.int64)
    return out


def _forest(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a spanning forest of the links across components between two blocks of a bucket."""
    for group in sorted_groups(batches, _DEALT):
        if group.num_rows < 2:
            continue
        ids, comp = group.column("id").to_numpy(), group.column("component_id").to_numpy()
        rows, cols = _halves(group)
        sets = [shingles(t, size) for t in texts(group.column("text"))]
        n = np.array([len(s) for s in sets], np.int64)
        both = intersections(sets)[np.ix_(rows, cols)]
        linked = 100 * both >= percent * (n[rows][:, None] + n[cols][None, :] - both)
        linked &= (comp[rows][:, None] != comp[cols][None, :]) & (both > 0)
        a, b = np.nonzero(linked)
        if not len(a):
            continue
        a, b = rows[a], cols[b]
        # one link for each pair of components is enough to join them
        ends = np.stack([np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])])
        _, first = np.unique(ends, axis=1, return_index=True)
        parent: dict[int, int] = {}
        us, vs = [], []
        for i in first.tolist():
            x, y = root(parent, int(comp[a[i]])), root(parent, int(comp[b[i]]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                us.append(min(ids[a[i]], ids[b[i]]))
                vs.append(max(ids[a[i]], ids[b[i]]))
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])


def _labelled(met: DataFrame, label: DataFrame | None) -> DataFrame:
    """``met`` with the component of each id."""
    if label is None:
        return met.withColumn("component_id", F.col("id"))
    return met.join(label, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))


def _largest(labelled: DataFrame, turn: int) -> DataFrame:
    """(bucket, main, hub, rows, units, parts): the component with most rows in each bucket, one member of it that
    changes with ``turn``, and the sizes of that component and of all."""
    pick = F.xxhash64("id", F.lit(turn)) if turn else F.col("id")
    parts = labelled.groupBy("bucket", "component_id").agg(
        F.count("*").alias("rows"), F.sum("n").alias("units"), F.min(F.struct(pick.alias("pick"), "id", "n")).alias("hub")
    )
    most = F.max(F.struct("rows", (-F.col("component_id")).alias("least"), "units", "hub")).alias("m")
    out = parts.groupBy("bucket").agg(most, F.sum("rows").alias("all_rows"), F.sum("units").alias("all_units"), F.count("*").alias("parts"))
    return out.where("parts > 1").select(
        "bucket", (-F.col("m.least")).alias("main"), F.col("m.hub").alias("hub"), F.col("m.rows").alias("main_rows"),
        F.col("m.units").alias("main_units"), "all_rows", "all_units",
    )


def _blocked(labelled: DataFrame, block: int, units: int) -> DataFrame:
    """Rows of buckets of several components, dealt to pairs of blocks (one, two).

    Blocks 0, 1, ... hold the rows outside the bucket's largest component, the
    blocks behind them its rows; these are paired with the former only. A block
    has about ``block`` rows and ``units`` shingles at most.
    """
    number = lambda rows, size: F.greatest(F.ceil(rows / block), F.ceil(size / units), F.lit(1)).cast("int")
    found = _largest(labelled, 0).select(
        "bucket", "main", number(F.col("main_rows"), F.col("main_units")).alias("inner"),
        number(F.col("all_rows") - F.col("main_rows"), F.col("all_units") - F.col("main_units")).alias("outer"),
    )
    within = F.col("component_id") == F.col("main")
    spread = lambda count: F.pmod(F.xxhash64("id", "bucket"), count).cast("int")
    dealt = labelled.join(found, "bucket").withColumn(
        "block", F.when(within, F.col("outer") + spread(F.col("inner"))).otherwise(spread(F.col("outer")))
    )
    mates = F.when(within, F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1))
    dealt = dealt.withColumn("mate", F.explode(mates))
    return dealt.select("bucket", "id", "component_id", "block", F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("two"))


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 36, rows: int = 7, block: int = 256, rounds: int = 8
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): n_shingles, component_id, kept.

    Words are runs outside white space, A-Z lower-cased; shingles are ``size``
    words, or all of them if there are fewer. Two documents are linked when
    their sets' Jaccard similarity is at least ``percent`` / 100. A pair at
    that similarity goes unseen with a probability of (1 - (percent/100)^rows)^bands,
    0.0002 as set, and less above it. Null and empty texts have an empty set
    and link with nothing. Rows with one doc_id share a component; rows whose
    doc_id is null keep to themselves. Other columns are not read; an empty
    table gives no rows. ``rounds`` bounds step 2 only: what it leaves, step 3
    decides. The result is written to the shared folder, and what led to it is
    deleted there.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = plain.mapInArrow(lambda b: _signatures(b, size, bands, rows), "doc_id long, n_shingles long, a long, b long, signature binary")
    signed = compact(signed, "signatures")
    sets = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("a", "b", "n_shingles").agg(F.min("doc_id").alias("id"), F.min("signature").alias("signature"))
    classes = compact(classes, "classes")

    banded = classes.select("id", F.col("n_shingles").alias("n"), "signature").mapInArrow(
        lambda x: _banded(x, bands, rows), "bucket long, id long, n int"
    )
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = compact(banded.join(shared.select("bucket"), "bucket").select("bucket", "id", "n"), "buckets")

    # texts are shuffled whole once; what follows moves those of classes that met another only
    sources = plain.where("text IS NOT NULL").join(met.select(F.col("id").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    sources = compact(sources, "texts")

    label, links, tried, work = None, None, None, None
    few = 64 * met.count()
    for turn in range(max(rounds, 1)):
        labelled = _labelled(met, label)
        largest = compact(_largest(labelled, turn), "largest")
        before, work = work, largest.agg(F.sum((F.col("all_rows") - F.col("main_rows")) * F.col("all_rows"))).first()[0] or 0
        if turn and (work <= few or 10 * work > 9 * before):
            dropped(largest)
            break
        ask = labelled.join(largest, "bucket").where(F.col("component_id") != F.col("main"))
        near_size = F.least(F.col("n"), F.col("hub.n")) * 100 >= F.greatest(F.col("n"), F.col("hub.n")) * percent
        pairs = ask.where(near_size).select(F.col("hub.id").alias("u"), F.col("id").alias("v"))
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        by = F.xxhash64("u", "v", F.lit(turn)) if turn else F.col("u")
        asked = compact(pairs.groupBy("v").agg(F.min(F.struct(by.alias("by"), "u")).alias("m")).select("m.u", "v"), "asked")
        found = compact(_confirmed(asked, sources, size, percent), "confirmed")
        tried = asked if tried is None else tried.unionByName(asked)
        links = found if links is None else links.unionByName(found)
        old, label = label, components(links)
        dropped(largest, *([old] if old is not None else []))

    labelled = compact(_labelled(met, label), "labelled")
    # five standard errors below the threshold
    share = percent / 100
    least = share - 5 * (share * (1 - share) / (bands * rows)) ** 0.5
    n = partitions(docs)
    compared = _blocked(labelled, block, 2_000_000).join(classes.select("id", "signature").hint("merge"), "id")
    compared = compared.repartition(n, *_DEALT).sortWithinPartitions(*_DEALT)
    likely = compared.mapInArrow(lambda b: _likely(b, least), "bucket long, one int, two int, block int, id long, component_id long")
    likely = compact(likely, "likely")
    whole = likely.join(sources.withColumnRenamed("doc_id", "id").hint("merge"), "id")
    whole = whole.repartition(n, *_DEALT).sortWithinPartitions(*_DEALT)
    more = compact(whole.mapInArrow(lambda b: _forest(b, size, percent), "u long, v long").distinct(), "forest")

    # a doc_id that stands on different texts joins their classes
    key = F.struct("a", "b", "n_shingles")
    odd = sets.groupBy("doc_id").agg(F.min(key).alias("x"), F.max(key).alias("y")).where("x <> y").select("doc_id")
    of_odd = sets.join(odd, "doc_id").join(classes.select("a", "b", "n_shingles", "id"), ["a", "b", "n_shingles"]).select("doc_id", "id")
    same_id = of_odd.join(of_odd.groupBy("doc_id").agg(F.min("id").alias("u")), "doc_id").select("u", F.col("id").alias("v"))

    final = components(links.unionByName(more).unionByName(same_id))
    of_class = classes.join(final, "id", "left").select("a", "b", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    out = signed.drop("signature").join(of_class, ["a", "b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
    out = compact(out, "near-duplicates")
    dropped(signed, classes, met, sources, tried, links, labelled, likely, more, final, label)
    return out


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (u, v) whose documents' shingle sets pass ``percent``.

    The text of v travels once to where u's is. Adaptive execution splits the
    joins where one u has very many pairs. Lists of pairs have no size bound, so
    they are merged, not broadcast.
    """
    v = pairs.join(docs.select(F.col("doc_id").alias("v"), F.col("text").alias("v_text")).hint("merge"), "v")
    both = v.join(docs.select(F.col("doc_id").alias("u"), F.col("text").alias("u_text")).hint("merge"), "u")
    return both.select("u", "v", "u_text", "v_text").mapInArrow(lambda b: _verified(b, size, percent), "u long, v long").distinct()


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` for each component: that with its smallest doc_id, null being the largest.

    Where a doc_id is null or repeated, rows are told apart by a hash of id and
    text, and of rows equal in both one stays. Rows without a shingle are
    copies only of rows with their doc_id. An empty table stays empty; columns
    of any name are allowed beside doc_id and text.
    """
    if not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        found = near_duplicates(docs, **options).where("NOT kept").select("doc_id").distinct()
        return docs.join(found, "doc_id", "left_anti")
    key, of = unused(docs, "_longloom_key"), unused(docs, "_longloom_of")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), **options)
    found = compact(found.select(F.col("doc_id").alias(key), "component_id", "n_shingles").distinct(), "components")
    ids = keyed.select(key, F.col("doc_id").cast("long").alias("id")).distinct()
    rows = found.join(ids, key)
    bare = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    group = F.when(bare, F.struct(F.lit(True).alias("bare"), F.col("id").alias("of"))).otherwise(
        F.struct(F.lit(False).alias("bare"), F.col("component_id").alias("of"))
    )
    best = F.min(F.struct(F.col("id").isNull().alias("_none"), "id", F.col(key).alias("_key"), F.col("n_shingles").alias("_n"))).alias("best")
    chosen = rows.groupBy(group.alias("group")).agg(best).select(F.col("best._key").alias(key), F.struct("best._none", "best._n").alias(of))
    kept = keyed.join(chosen, key)
    lone = F.col(of)["_none"] & (F.col(of)["_n"] == 0)  # without id and without words: nothing says that they are copies
    once = kept.where(~lone).dropDuplicates([key]).unionByName(kept.where(lone))
    return once.select(*docs.columns)
