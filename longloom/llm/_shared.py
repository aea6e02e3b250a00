"""Session helpers: the shared folder, stored tables, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (a local test session) a temporary folder of this machine is used.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="longloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/longloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, file_bytes: int = 16 << 20) -> DataFrame:
    """``df`` in at most two partitions a core, or one for each ``file_bytes`` of the files it is made of if those are more.

    On a ``file:`` folder Hadoop starts about three processes for the permissions
    of each file, and while one starts, its executor's memory counts twice.
    Partitions are put together without a shuffle. Not for rows made by the
    number of their task (``TaskContext.partitionId``).
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.coalesce(min(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // file_bytes)), 1 << 30))


def compact(df: DataFrame, name: str) -> DataFrame:
    """``df`` as ``stored``, in few files."""
    return stored(few_files(df), name)


def dropped(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        root = f"{shared_dir(spark)}/longloom/"
        jvm = spark.sparkContext._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if f"/longloom/" in path and root.split(":", 1)[-1].lstrip("/") in path:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of the edges (u, v): rows (id, component_id).

    Alternates the large-star and small-star steps of Kiveris et al. (2014):
    each hangs every neighbour of a node on the smallest id around it, until
    nothing but stars is left. Smallest ids come from partial aggregation and a
    join (which adaptive execution splits where a hub is hot), never from a
    collected neighbour list. Each round is written to the shared folder.
    Nodes without an edge are not in the result; self-loops are ignored.
    """
    now = compact(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    state = None
    for _ in range(max_rounds):
        both = _directed(now)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = compact(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        small = compact(
            small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "small",
        )
        found = small.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        dropped(now, large)
        now = small
        if found == state:
            break
        state = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)


def row_keys(docs: DataFrame) -> Column:
    """A long that tells the rows of (doc_id, text) apart: doc_id, where it is unique and never null.

    Otherwise a hash of both columns; rows equal in both then share a key.
    """
    odd = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    return F.xxhash64("doc_id", "text") if odd else F.col("doc_id").cast("long")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows of ``df``, in the order of a hash of ``keys``: the same however the table is split.

    A filter on the hash leaves few more than asked for over the whole table,
    so what tasks return does not grow with their number.
    """
    share = min(1.0, (1.2 * rows + 100) / max(df.count(), 1))
    mark = F.xxhash64(*keys)
    return df.where(F.pmod(mark, F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy(mark, *keys).limit(rows)


def crc_bucket(doc_id: Column | str) -> Column:
    """crc32 of the id as text, mod 5: 0 marks the held-out rows."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5


def held_out(doc_id: str) -> Column:
    """Whether a row lies in the held-out fold; a null id does not."""
    return F.coalesce(crc_bucket(doc_id) == 0, F.lit(False)).alias("held_out")
