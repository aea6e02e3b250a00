"""From raw documents to training sequences, in five stages.

Each stage gets the DataFrame that the one before it kept, and is written as
Parquet in the shared folder before the next reads it, so a lost executor
costs at most the stage at hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longloom.llm import minhash, packing, quality, rules, substring
from longloom.llm._shared import dropped, few_files, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return few_files(rules.cascade(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or above.

    The model learns from the documents as they came in, labels of the
    held-out fold aside, so that it has seen what the rules take away.
    """
    labels = table(spark, sf_dir, "labels")
    return few_files(quality.keep_good(docs, labels, model=quality.learn(table(spark, sf_dir, "documents"), labels)))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return few_files(minhash.keep_one(docs))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 35-word sequences that occur elsewhere too."""
    out = few_files(substring.remove(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens.

    Its workers share an executor with what the stages before it have left in
    memory, and serve whatever runs next, so they encode less at a time and
    keep no table of word ids.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), text_bytes=1_000_000, keep=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_dedup", minhash_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: The classifier and the packing have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of ``documents``; what a stage kept is deleted once the next has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return docs
