"""The driver's tables seen as the engine's inputs, as DataFrames and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import token_count
from ..operators.rows import with_next


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a scored corpus; group sizes by text through an aggregate, not a window, as one text may be hot."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    copies = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("minhash_cluster_size"))
    scores = F.when(F.col("quality").isNotNull(), F.array(F.col("quality").cast("double")))
    return (
        docs.withColumn("h", F.sha2("text", 256))
        .join(copies, "h", "left")
        .join(labels, "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("doc_id"),
            F.concat_ws(":", "source", "doc_id").alias("source"),
            "text",
            token_count(F.col("text")).alias("token_count"),
            scores.alias("fw_edu_scores"),
            "minhash_cluster_size",
            F.col("doc_id").alias("position"),
        )
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("name"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").cast("int").alias("value"),
    )


def word_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case words of 3 to 12 ASCII letters of the English documents, with their places."""
    docs = table(spark, sf_dir, "documents").where("lang = 'en'")
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)
    return docs.select("doc_id", F.posexplode(found).alias("pos", "word")).where(F.length("word").between(3, 12))


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who acts after whom, in order of time: the driver's event log has one time order, of which ranges are sorted apart."""
    events = table(spark, sf_dir, "events").select("ts", "event_id", F.col("user_id").alias("u"))
    return with_next(events, ["ts", "event_id"], "u", "v").where("v IS NOT NULL AND u <> v")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two transitions of each user, distinct: a thin graph of many layers."""
    nth = F.row_number().over(Window.partitionBy("u").orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")))
    return _steps(spark, sf_dir).withColumn("n", nth).where("n <= 2").select("u", "v").distinct()


def all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transition, distinct."""
    return _steps(spark, sf_dir).select("u", "v").distinct()


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", (1000 + F.col("vec_id") % 500).alias("n_tokens"))


CORPUS = """v_corpus AS (
  SELECT d.doc_id, d.text, d.source,
    len(regexp_extract_all(d.text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) AS token_count,
    l.quality, count(*) OVER (PARTITION BY d.text) AS minhash_cluster_size
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""
RECORDS = """v_records AS (
  SELECT l_orderkey || '-' || l_linenumber AS name, l_returnflag AS category, CAST(trunc(l_quantity) AS INT) AS value FROM lineitem
)"""
WORDS = """v_words AS (
  SELECT doc_id, pos, word FROM (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents WHERE lang = 'en')
  ) WHERE length(word) BETWEEN 3 AND 12
)"""
EDGES = """v_edges AS (
  SELECT DISTINCT u, v FROM (
    SELECT u, v, row_number() OVER (PARTITION BY u ORDER BY ts, event_id) AS n FROM (
      SELECT ts, event_id, user_id AS u, lead(user_id) OVER (ORDER BY ts, event_id) AS v FROM events
    ) WHERE v IS NOT NULL AND u <> v
  ) WHERE n <= 2
)"""
ALL_EDGES = """v_edges AS (
  SELECT DISTINCT u, v FROM (
    SELECT user_id AS u, lead(user_id) OVER (ORDER BY ts, event_id) AS v FROM events
  ) WHERE v IS NOT NULL AND u <> v
)"""
VECTORS = "v_vec AS (SELECT vec_id, embedding, 1000 + vec_id % 500 AS n_tokens FROM embeddings)"


def pick_sql(n: str | int, key: str) -> str:
    """The SQL of ``functions.numbers.pick``; ``key`` is a string expression."""
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {n})"
