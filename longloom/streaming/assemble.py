"""Assembling samples from responses as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import response_id, response_text
from ..plans.requests import multihop_assemble, summarize_assemble


def response_stream(spark: SparkSession, path: str, id_field: str = "id", text_field: str | None = None) -> DataFrame:
    """(file, line, id, reply) from JSON lines in a folder that grows.

    A file is read once, whole, when it appears; broken lines are skipped.
    """
    text = spark.readStream.format("text").load(path).select("value", F.col("_metadata.file_path").alias("file"))
    row = F.try_parse_json("value")
    rows = text.select("file", F.md5("value").alias("line"), row.alias("row")).where("row IS NOT NULL")
    return rows.select("file", "line", response_id(F.col("row"), id_field).alias("id"), response_text(F.col("row"), text_field).alias("reply"))


def assemble_stream(
    responses: DataFrame, requests: DataFrame, docs: DataFrame, store: str, out: str, checkpoint: str, kind: str = "multihop", fmt: str = "sft"
) -> StreamingQuery:
    """Keep what has arrived in ``store`` and rewrite the samples in ``out`` after each batch.

    A document's sample needs all its responses so far, so each batch appends
    its replies by batch number (a batch that is run again after a failure
    replaces itself) and the assembly reads the store.
    """
    assemble = {"multihop": multihop_assemble, "summarize": summarize_assemble}[kind]
    ids = requests.select("id", "doc").distinct()

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        rows.join(ids, "id").write.mode("overwrite").parquet(f"{store}/batch={number}")
        found = spark.read.parquet(store)
        assemble(found.select("file", "line", "id", "doc", "reply"), docs, fmt).write.mode("overwrite").json(out)

    return responses.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
