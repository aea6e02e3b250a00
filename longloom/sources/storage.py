"""Tables and JSON lines in shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of this machine only where none is set in a local session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="longloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = f"{shared_folder(df.sparkSession)}/longloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reused(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path`` if there is one, else what ``make()`` gives, written there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        make().write.parquet(path)
    return spark.read.parquet(path)


def write_jsonl(rows: DataFrame, path: str, by: str | None = "task") -> None:
    """One folder of JSON lines for each value of ``by``; null fields are written."""
    out = rows.withColumn("_by", F.col(by)) if by else rows
    writer = out.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy("_by") if by else writer).json(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, row VARIANT) of JSON lines of any shape; blank and broken lines are skipped."""
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), "value"
    )
    return text.where(F.trim("value") != "").select("file", "line", F.try_parse_json("value").alias("row")).where("row IS NOT NULL")


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").json(path)


def line_tally(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the JSON files of each generator folder below ``path``."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*").text(path)
    return rows.groupBy(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("generator")).agg(F.count("*").alias("n"))


def viewer_sample(rows: DataFrame, num: int, by: str = "task", id_col: str = "id") -> DataFrame:
    """At most ``num`` rows of each task, chosen by a hash of their ids."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy(F.md5(F.col(id_col).cast("string")), id_col))
    return rows.withColumn("_nth", nth).where(F.col("_nth") <= num).drop("_nth")


def word_list(values: DataFrame, column: str = "value", position: str = "pos") -> DataFrame:
    """Words of 3 to 12 ASCII letters, lower case, each at its first place."""
    rows = values.where(F.col(column).rlike("^[A-Za-z]{3,12}$")).select(F.lower(column).alias("word"), position)
    return rows.groupBy("word").agg(F.min(position).alias("pos"))


def marker_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ASCII letters, without comments and blanks, lower case, each at its first place."""
    rows = spark.read.text(path).select(F.trim("value").alias("w"), F.monotonically_increasing_id().alias("pos"))
    rows = rows.where(F.col("w").rlike("^[A-Za-z]+$")).select(F.lower("w").alias("word"), "pos")
    return rows.groupBy("word").agg(F.min("pos").alias("pos"))


def ordered(column: Column) -> Column:
    return F.array_sort(F.collect_set(column))
