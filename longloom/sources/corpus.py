"""Reading and filtering a document corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import token_count

# Column names that a corpus may use, in order of preference.
TEXT_COLUMNS = ("text", "content", "raw_content", "document", "body")
ID_COLUMNS = ("id", "doc_id", "url", "_id")


@dataclass(frozen=True)
class Filters:
    min_tokens: int = 200
    min_edu: float = 0.75
    drop_dups: bool = True
    keep_one: bool = False  # of a group of near copies, rather than none
    char_cap: int | None = None
    max_docs: int | None = None


def pick_column(columns: list[str], candidates: tuple[str, ...]) -> str | None:
    """The first candidate that is there."""
    return next((c for c in candidates if c in columns), None)


def read_corpus(spark: SparkSession, input_dir: str) -> DataFrame:
    """All parquet files below a folder, as doc_id, source, text, token_count, fw_edu_scores, minhash_cluster_size.

    Missing optional columns are null, a missing token count is computed. The
    source tag is file:row and unique, and stands in for a missing id.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True)
    try:
        raw = raw.parquet(input_dir)
    except Exception as e:
        raise ValueError(f"no parquet files under {input_dir!r}") from e
    text, id_ = pick_column(raw.columns, TEXT_COLUMNS), pick_column(raw.columns, ID_COLUMNS)
    if text is None:
        raise ValueError(f"no text column among {raw.columns}; one of {TEXT_COLUMNS} is needed")
    source = F.concat_ws(":", F.col("_metadata.file_name"), F.col("_metadata.row_index"))

    def optional(name: str, kind: str) -> Column:
        return (F.col(name) if name in raw.columns else F.lit(None)).cast(kind).alias(name)

    scores = F.lit(None)
    if "fw_edu_scores" in raw.columns:
        array = raw.schema["fw_edu_scores"].dataType.typeName() == "array"
        scores = F.col("fw_edu_scores") if array else F.when(F.col("fw_edu_scores").isNotNull(), F.array("fw_edu_scores"))
    counted = F.col("token_count").cast("long") if "token_count" in raw.columns else token_count(F.col(text))
    return raw.select(
        F.coalesce(F.col(id_).cast("string") if id_ else F.lit(None).cast("string"), source).alias("doc_id"),
        source.alias("source"),
        F.col(text).cast("string").alias("text"),
        counted.alias("token_count"),
        scores.cast("array<double>").alias("fw_edu_scores"),
        optional("minhash_cluster_size", "long"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("position"),
    )


def score_mean(scores: Column) -> Column:
    """Mean of a list; 0 for null and empty lists."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return F.when(F.size(scores) > 0, total / F.size(scores)).otherwise(0.0)


def drop_reason(f: Filters = Filters()) -> Column:
    """Why a document goes: the first of empty, short, dup, lowedu that holds, else kept."""
    copies = F.coalesce(F.col("minhash_cluster_size") > 1, F.lit(False))
    return (
        F.when(F.coalesce(F.col("text"), F.lit("")) == "", "empty")
        .when(F.coalesce(F.col("token_count"), F.lit(0)) < f.min_tokens, "short")
        .when(copies if f.drop_dups and not f.keep_one else F.lit(False), "dup")
        .when(score_mean(F.col("fw_edu_scores")) < f.min_edu, "lowedu")
        .otherwise("kept")
    )


def filtered(corpus: DataFrame, f: Filters = Filters()) -> DataFrame:
    """doc_id, source, text, n_tokens of the documents that stay.

    ``max_docs`` takes the first in file order. Cheap checks come first in the
    scan's filter; the token count and group size are pushed to the files.
    """
    kept = corpus.where(drop_reason(f) == "kept")
    if f.keep_one:
        kept = kept.join(kept.groupBy("text").agg(F.min("doc_id").alias("doc_id")), ["text", "doc_id"])
    if f.max_docs is not None:
        kept = kept.orderBy("position").limit(f.max_docs)
    text = F.col("text") if f.char_cap is None else F.substring("text", 1, f.char_cap)
    return kept.select("doc_id", "source", text.alias("text"), F.coalesce("token_count", F.lit(0)).alias("n_tokens"))


def reason_counts(corpus: DataFrame, f: Filters = Filters()) -> DataFrame:
    return corpus.groupBy(drop_reason(f).alias("reason")).agg(F.count("*").alias("n"))


def texts_by_id(corpus: DataFrame, needed: DataFrame) -> DataFrame:
    """Texts of the ids in ``needed``; of rows with one id the last in file order counts."""
    found = corpus.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    return found.groupBy("doc_id").agg(F.max_by("text", "position").alias("text"))


def within_limit(docs: DataFrame, min_tokens: int, max_tokens: int, reserve: int) -> tuple[DataFrame, DataFrame]:
    """(documents of a usable length, counts by reason) for prompts of at most ``max_tokens``."""
    reason = F.when(F.col("n_tokens") < min_tokens, "short").when(F.col("n_tokens") > max_tokens - reserve, "long").otherwise("kept")
    tagged = docs.withColumn("reason", reason)
    return tagged.where("reason = 'kept'").drop("reason"), tagged.groupBy("reason").agg(F.count("*").alias("n"))
