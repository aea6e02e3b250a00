"""Exact neighbours by cosine, and bundles of related documents."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import stored


def embed(docs: DataFrame, model: Callable[[list[str]], np.ndarray], max_tokens: int = 256) -> DataFrame:
    """(doc_id, embedding) by a function of texts to vectors, which are scaled to unit length.

    Texts are cut to 12 characters a token before the model sees them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(model([t or "" for t in batch.column(1).to_pylist()]), np.float32)
            v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(v), pa.list_(pa.float32()))], ["doc_id", "embedding"])

    plain = docs.select("doc_id", F.substring("text", 1, 12 * max_tokens).alias("text"))
    return plain.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, embedding array<float>")


def best_columns(sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ``k`` largest values of each row, in order; ties go to the column on the left. -inf does not count.

    No row is sorted as a whole: values at or above its k-th largest are picked first.
    """
    least = np.partition(sim, -k, axis=1)[:, -k] if k < sim.shape[1] else np.full(len(sim), -np.inf)
    r, c = np.nonzero((sim >= least[:, None]) & (sim > -np.inf))
    order = np.lexsort((c, -sim[r, c], r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return r[rank < k], c[rank < k]


def topk(vectors: DataFrame, k: int, id_col: str = "vec_id", blocks: int | None = None, block_rows: int = 16_384) -> DataFrame:
    """(i, j, sim, k_rank): the ``k`` nearest others of each vector; ties go to the smaller id.

    Both sides are dealt in blocks: a task multiplies one block of rows with
    one of columns in double precision and gives at most ``k`` candidates a
    row, so neither a cross join's rows nor a whole side is ever in one place.
    The work is quadratic, as exact search is, and each vector is sent to every
    block. Unless told, there are as many blocks as keep each at about
    ``block_rows`` vectors, or at a quarter of that where all cores would not
    have a few pairs of blocks each otherwise.
    """
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    if blocks is None:
        n = vectors.count()
        blocks = max(1, -(-n // block_rows), min(-(-4 * n // block_rows), math.isqrt(4 * cores) + 1))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col("embedding"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = rows.withColumn("one", block).withColumn("two", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("side", F.lit(0))
    right = rows.withColumn("two", block).withColumn("one", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("side", F.lit(1))
    both = left.select("one", "two", "side", "id", "embedding").unionByName(right.select("one", "two", "side", "id", "embedding"))

    def best(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        x = np.stack(table.column("embedding").to_numpy()).astype(np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        order = np.argsort(ids, kind="stable")
        r, c = order[side[order] == 0], order[side[order] == 1]
        i, j, s = [], [], []
        other, across, odd = ids[c], np.ascontiguousarray(x[c].T), bool(np.isnan(x).any())
        for start in range(0, len(r) if len(c) else 0, 512):
            part = r[start : start + 512]
            sim = x[part] @ across
            if odd:
                sim[np.isnan(sim)] = -np.inf
            # ids are in order: the columns with the row's own id lie side by side
            low, high = np.searchsorted(other, ids[part], "left"), np.searchsorted(other, ids[part], "right")
            for row in np.flatnonzero(low < high):
                sim[row, low[row] : high[row]] = -np.inf
            a, b = best_columns(sim, k)
            i.append(ids[part][a])
            j.append(other[b])
            s.append(sim[a, b])
        return pa.table({"i": pa.array(np.concatenate(i) if i else [], pa.int64()), "j": pa.array(np.concatenate(j) if j else [], pa.int64()), "sim": pa.array(np.concatenate(s) if s else [], pa.float64())})

    # few bytes and much work: adaptive execution must not put pairs together
    both = both.repartition(max(int(both.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(blocks * blocks, 8 * cores)), "one", "two")
    near = both.groupBy("one", "two").applyInArrow(best, "i long, j long, sim double")
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("sim"), "j"))
    return near.withColumn("k_rank", rank).where(F.col("k_rank") <= k)


def chain(order: list[int], tokens: dict[int, int], near: dict[int, list[tuple[float, int]]], budget: int, floor: float) -> list[tuple[int, int, int]]:
    """(seed, rank, member) of greedy chains.

    Each seed, in order, draws its most similar unused neighbours, and theirs,
    while they fit in the budget; one that does not is passed over for good. A
    seed over the budget stays alone.
    """
    used: set[int] = set()
    out = []
    for seed in order:
        if seed in used:
            continue
        total, rank, heap = 0, 0, [(-2.0, seed)]
        while heap and total < budget:
            _, node = heapq.heappop(heap)
            if node in used or rank and total + tokens[node] > budget:
                continue
            used.add(node)
            out.append((seed, rank, node))
            total, rank = total + tokens[node], rank + 1
            for sim, other in near.get(node, ()):
                if sim < floor:
                    break
                if other not in used:
                    heapq.heappush(heap, (-sim, other))
    return out


def bundle(neighbours: DataFrame, docs: DataFrame, budget: int, floor: float = 0.35, components: Callable | None = None) -> DataFrame:
    """(id, cluster_id, rank, n_tokens): related documents chained within a token budget.

    A chain never leaves a connected component of the neighbour graph above
    ``floor``, so components are chained apart, each as one group; cluster ids
    are then numbered by the id of their seed. ``docs`` is (id, n_tokens).
    """
    links = stored(neighbours.where(F.col("sim") >= floor).select("i", "j", "sim"), "links")
    find = components or label_components
    of = find(links.select(F.col("i").alias("u"), F.col("j").alias("v")))
    known = docs.join(of, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    near = links.groupBy(F.col("i").alias("id")).agg(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("neg"), "j"))).alias("near"))
    joined = known.join(near, "id", "left").select("component_id", "id", "n_tokens", "near")

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["id"])
        found = chain(
            [r["id"] for r in rows], {r["id"]: r["n_tokens"] for r in rows},
            {r["id"]: [(-n["neg"], n["j"]) for n in r["near"] or ()] for r in rows}, budget, floor,
        )
        tokens = {r["id"]: r["n_tokens"] for r in rows}
        columns = list(zip(*[(m, s, k, tokens[m]) for s, k, m in found], strict=True))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("id", "seed", "rank", "n_tokens"), columns, strict=True)})

    chained = stored(joined.groupBy("component_id").applyInArrow(run, "id long, seed long, rank long, n_tokens long"), "chains")
    numbers = chained.select("seed").distinct()
    numbers = numbers.withColumn("cluster_id", (F.row_number().over(Window.orderBy("seed")) - 1).cast("long"))
    return chained.join(numbers, "seed").select("id", "cluster_id", "rank", "n_tokens")


def label_components(edges: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id connected with each node.

    In rounds each label hangs on the smallest label beside it, and paths of
    those are cut short; links between labels that are still different go on,
    so there are fewer of them each round, however long the paths were.
    """
    both = stored(edges.union(edges.select("v", "u")).distinct(), "both")
    label = both.select(F.col("u").alias("id"), F.col("u").alias("c")).distinct()
    link = both.where("u <> v")
    while not link.isEmpty():
        up = stored(link.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p")), "up")
        via = up.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        up = stored(up.join(via, "p").select("u", F.col("pp").alias("p")).join(via, "p").select("u", F.col("pp").alias("p")), "up")
        other = up.select(F.col("u").alias("v"), F.col("p").alias("q"))
        link = link.join(up, "u").join(other, "v").where("p <> q").select(F.col("p").alias("u"), F.col("q").alias("v"))
        link = stored(link.distinct(), "links")
        label = label.join(up.select(F.col("u").alias("c"), "p"), "c", "left")
        label = stored(label.select("id", F.coalesce("p", "c").alias("c")), "label")
    return label.select("id", F.col("c").alias("component_id"))


def bundle_summary(bundles: DataFrame, largest: int = 10) -> DataFrame:
    """One row on the bundles: documents, clusters, sizes and token percentiles."""
    sizes = bundles.groupBy("cluster_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    biggest = sizes.orderBy(F.desc("n")).limit(largest).agg(F.sort_array(F.collect_list("n"), asc=False).alias("biggest_clusters_docs"))
    return sizes.agg(
        F.sum("n").alias("n_docs"),
        F.count("*").alias("n_clusters"),
        F.count_if(F.col("n") > 1).alias("multi_doc"),
        F.count_if(F.col("n") == 1).alias("singletons"),
        F.sum("t").alias("tokens"),
        F.percentile("t", F.lit(0.5)).cast("int").alias("p50"),
        F.percentile("t", F.lit(0.9)).cast("int").alias("p90"),
        F.max("t").alias("max"),
    ).join(biggest)


def cluster_documents(bundles: DataFrame, texts: DataFrame, seed: int = 0, max_clusters: int | None = None) -> DataFrame:
    """(cluster_id, text): texts of each bundle of two or more, in chain order, joined by a blank line."""
    big = bundles.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n >= 2")
    if max_clusters is not None:
        big = big.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), "cluster_id"))).limit(max_clusters)
    members = bundles.join(big.select("cluster_id"), "cluster_id", "left_semi").join(texts.select("id", "text"), "id")
    parts = F.array_sort(F.collect_list(F.struct("rank", "id", "text")))
    joined = members.groupBy("cluster_id").agg(parts.alias("parts")).where("size(parts) >= 2")
    return joined.select("cluster_id", F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n").alias("text"))
