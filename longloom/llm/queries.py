"""The queries over the driver's tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import rules
from ._shared import table


def _vocabulary(name: str) -> tuple[str, str]:
    """Path of a public vocabulary file, and the pattern that goes with the rank files."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.measures(table(spark, sf_dir, "documents"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html

    return html.extract(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substring

    return substring.digests(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), *_vocabulary("byte_bpe_multi_50k.tiktoken"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import embeddings

    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), *_vocabulary("byte_bpe_multi_50k.tiktoken"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import packing

    return packing.pack(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json")[0])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_quality_rules, op3_minhash_dedup, op4_html_text, op5_substring_dedup, op6_byte_bpe, op7_embedding_dedup, op8_token_counts, op9_packing, op10_toxicity)
}

ORACLE_SQL: dict[str, str] = {"op2_quality_rules": rules.ORACLE}
