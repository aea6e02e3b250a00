"""Near-duplicate vectors by random hyperplanes, checked by exact cosine.

Equal vectors are folded into one class first. Each class is hashed in several
tables to the signs of its products with random hyperplanes; only classes that
meet in a bucket of some table are compared, by exact cosine in double
precision, block against block, so no pair becomes a row unless it joins two
classes in a spanning forest of its block. A pair that meets in several tables
counts in the first of them. Large buckets are split into blocks that are dealt
over the cluster in pairs.

Signs per table and tables follow from the number of classes: buckets hold a
few unrelated vectors each, and a pair at the threshold is missed with at most
the stated probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._groups import root, sorted_groups
from ._shared import components, dropped, partitions, stored

_BUCKET = ["t", "code"]
_LINKS = "id long, other long, n_links long"


def tables_for(n: int, threshold: float, miss: float, per_bucket: int = 8, least_bits: int = 8, most_bits: int = 60) -> tuple[int, int]:
    """(tables, signs per table) for ``n`` vectors."""
    bits = min(most_bits, max(least_bits, math.ceil(math.log2(max(n, 1) / per_bucket + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log1p(-same))), bits


def _unit(flat: np.ndarray, width: int) -> np.ndarray:
    x = flat.reshape(-1, width).astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _coded(batches: Iterator[pa.RecordBatch], tables: int, bits: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Rows with their codes, one for each table; hyperplanes are those of a vector's length."""
    powers = np.int64(1) << np.arange(bits, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        width = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
        codes = np.empty((batch.num_rows, tables), np.int64)
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            planes = np.random.default_rng([seed, w]).standard_normal((w, tables * bits))
            x = batch.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
            codes[at] = ((_unit(x, w) @ planes > 0).reshape(len(at), tables, bits) * powers).sum(2)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), tables).cast(pa.list_(pa.int64()))],
            ["id", "size", "embedding", "codes"],
        )


def _compared(batches: Iterator[pa.RecordBatch], tables: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of each row with the rows of its bucket block pair, and forest edges.

    Rows out: (id, other, 0) for an edge, (id, null, n) for links counted.
    """
    ids, others, counts = [], [], []

    def out():
        columns = [pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(counts, pa.int64())]
        ids.clear(), others.clear(), counts.clear()
        return pa.RecordBatch.from_arrays(columns, ["id", "other", "n_links"])

    for group in sorted_groups(batches, ["width", *_BUCKET, "one", "two"]):
        if group.num_rows < 2:
            continue
        width, t, one, two = (group.column(c)[0].as_py() for c in ("width", "t", "one", "two"))
        block = group.column("block").to_numpy()
        x = _unit(group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), width)
        codes = group.column("codes").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, tables)
        id_, size = group.column("id").to_numpy(), group.column("size").to_numpy()
        rows = np.flatnonzero(block == one)
        cols = rows if one == two else np.flatnonzero(block == two)
        linked = x[rows] @ x[cols].T >= threshold
        if one == two:
            linked &= np.tri(len(rows), k=-1, dtype=bool)
        a, b = np.nonzero(linked)
        if not len(a):
            continue
        a, b = rows[a], cols[b]
        first = np.ones(len(a), dtype=bool)
        for earlier in range(t):
            first &= codes[a, earlier] != codes[b, earlier]
        a, b = a[first], b[first]
        n = np.bincount(a, size[b], len(id_)) + np.bincount(b, size[a], len(id_))
        some = np.flatnonzero(n)
        ids.extend(id_[some].tolist())
        others.extend([None] * len(some))
        counts.extend(n[some].astype(np.int64).tolist())
        parent: dict[int, int] = {}
        for u, v in zip(id_[a].tolist(), id_[b].tolist(), strict=True):
            ru, rv = root(parent, u), root(parent, v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
                ids.append(u)
                others.append(v)
                counts.append(0)
        if len(ids) > 50_000:
            yield out()
    yield out()


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, miss: float = 0.002, block: int = 1024, seed: int = 20, id_col: str = "vec_id"
) -> DataFrame:
    """One row for each row of ``vectors`` (vec_id, embedding): links and component.

    ``n_links`` counts the other rows linked directly (copies included),
    ``component_id`` is the smallest id reachable. A vector that is null, zero,
    empty, or holds a null or a component that is not finite links with
    nothing. Vectors of different lengths are compared within their length.
    Repeated ids are rows of their own and share a component. A row whose id is
    null links with nothing and is kept, with a null component. Labels and
    other columns are not read. An empty table gives no rows. The result is
    written to the shared folder, and what led to it is deleted there.

    A pair at ``threshold`` goes unseen with a probability of ``miss`` at most;
    a bucket of n vectors is compared in (n / block)**2 / 2 tasks, so copies of
    each vector grow with its bucket.
    """
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "float" if single else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    bad = (
        F.col("id").isNull()
        | F.col("embedding").isNull()
        | F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        | ~F.exists("embedding", lambda v: v != 0)
    )
    sound = F.coalesce(~bad, F.lit(False))
    # -0.0 and 0.0 are one value; the key makes no class of two vectors that differ
    key = F.transform("embedding", lambda v: v + F.lit(0.0).cast(kind))
    rows = stored(rows.select("id", F.when(sound, key).alias("embedding")), "vectors")
    good = rows.where("embedding IS NOT NULL")
    classes = stored(good.groupBy("embedding").agg(F.min("id").alias("id"), F.count("*").alias("size")), "classes")
    tables, bits = tables_for(classes.count(), threshold, miss)
    coded = classes.select("id", "size", "embedding").mapInArrow(
        lambda b: _coded(b, tables, bits, seed), f"id long, size long, embedding array<{kind}>, codes array<long>"
    )
    coded = stored(coded, "codes")
    keys = ["width", *_BUCKET]
    spread = coded.select("id", F.size("embedding").alias("width"), F.posexplode("codes").alias(*_BUCKET))
    buckets = spread.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    met = spread.join(buckets, keys)
    # blocks of a bucket by a hash of the id; a row goes to every pair of blocks with its own
    met = met.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn(
        "block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("id"), F.col("blocks"))).otherwise(0).cast("int")
    )
    met = met.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("id", *keys, "block", F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("two"))
    met = met.join(coded, "id").select(*keys, "one", "two", "block", "id", "size", "embedding", "codes")
    dealt = met.repartition(partitions(vectors), *keys, "one", "two").sortWithinPartitions(*keys, "one", "two")
    edges = dealt.mapInArrow(lambda b: _compared(b, tables, threshold), _LINKS)
    edges = stored(edges.groupBy("id", "other").agg(F.sum("n_links").alias("n_links")), "found")
    counts = edges.where("other IS NULL").groupBy("id").agg(F.sum("n_links").alias("n_links"))
    linked = components(edges.where("other IS NOT NULL").select(F.col("id").alias("u"), F.col("other").alias("v")))
    per_class = (
        classes.select("id")
        .join(counts, "id", "left")
        .join(linked, "id", "left")
        .select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    )
    members = classes.join(per_class, "id").select(
        "embedding", (F.col("n_links") + F.col("size") - 1).alias("n_links"), "component_id"
    )
    joined = rows.join(members, "embedding", "left")
    component = F.coalesce("component_id", "id")
    out = joined.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
    out = stored(out, "near-duplicates")
    dropped(rows, classes, coded, edges, linked)
    return out
