"""Relational operators over records and word streams."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources.storage import stored


def count_where(rows: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    return rows.agg(F.count_if(predicate).alias(name))


def tally(records: DataFrame) -> DataFrame:
    return records.groupBy("category").agg(F.count("*").alias("n"))


def sums(records: DataFrame) -> DataFrame:
    return records.groupBy("category").agg(F.sum("value").alias("total"))


def as_map(groups: DataFrame, key: str, value: str) -> DataFrame:
    """One row with a map of the groups, keys in order."""
    pairs = F.array_sort(F.collect_list(F.struct(key, value)))
    return groups.agg(F.map_from_entries(pairs).alias("gold"))


def top_words(words: DataFrame, k: int, noise: str | None = None) -> DataFrame:
    """The ``k`` most frequent words in order; ties go to the word met first."""
    rows = words if noise is None else words.where(F.col("word") != noise)
    counted = rows.groupBy("word").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first"))
    best = counted.orderBy(F.desc("n"), "first").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "first"))  # over k rows
    return best.select("word", "n", rank.alias("rank"))


def common_words(words: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent words as one sorted list."""
    return top_words(words, k).agg(F.array_join(F.array_sort(F.collect_list("word")), ",").alias("words"))


def vocabulary(words: DataFrame, source: Column) -> DataFrame:
    return words.where(source).select("word").distinct()


def ordered_distinct(rows: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct values in order of first appearance."""
    return rows.groupBy(value).agg(F.min(position).alias(position))


def numbered(rows: DataFrame, *order: str | Column, name: str = "line") -> DataFrame:
    """1-based numbers in an order. The numbers are dealt in one partition: use on ids, not on texts."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def in_ranges(rows: DataFrame, *keys: Column, range_bytes: int = 4 << 20) -> DataFrame:
    """``rows`` in sorted partitions that follow each other by ``keys``; one for each ``range_bytes`` of what is read, if those are more than usual."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    ranges = -(-size // range_bytes)
    many = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) < ranges < 1 << 20
    dealt = rows.repartitionByRange(ranges, *keys) if many else rows.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def with_next(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the ``value`` of the row behind each in ``order``, nulls last, and null behind the last: a ``lead`` over the whole table.

    Ranges of the order are sorted apart and written once. Only the first and
    the last row of each range meet in one task.
    """
    end = "_end"  # 0: a row with its next one, 1: a copy of a range's first row, 2: a range's last row

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def out(found: pa.RecordBatch, after: pa.Array, mark: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*found.columns, after, pa.array([mark] * found.num_rows, pa.int32())], [*found.schema.names, name, end])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index(value)
            unknown = pa.nulls(1, batch.column(at).type)
            if held is None:
                yield out(batch.slice(0, 1), unknown, 1)
            else:
                yield out(held, batch.column(at).slice(0, 1), 0)
            yield out(batch.slice(0, batch.num_rows - 1), batch.column(at).slice(1), 0)
            held = batch.slice(batch.num_rows - 1)
        if held is not None:
            yield out(held, unknown, 2)

    schema = StructType([*rows.schema.fields, StructField(name, rows.schema[value].dataType), StructField(end, IntegerType())])
    keys = [F.asc_nulls_last(c) for c in order]
    found = stored(in_ranges(rows, *keys).mapInArrow(led, schema), "next")
    ends = found.where(F.col(end) > 0).withColumn(name, F.lead(value).over(Window.orderBy(*keys, end)))  # two rows of each range
    return found.where(F.col(end) == 0).unionByName(ends.where(F.col(end) == 2)).drop(end)


def numbered_in_ranges(rows: DataFrame, *keys: Column, name: str) -> DataFrame:
    """``rows`` with their 0-based numbers in the order of ``keys``: ranges are numbered apart and written once, their sizes are added."""
    part, nth = "_range", "_nth"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, past = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = pa.array(range(past, past + batch.num_rows), pa.int64())
            past += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([here] * batch.num_rows, pa.int64()), own], [*batch.schema.names, part, nth])

    schema = StructType([*rows.schema.fields, StructField(part, LongType()), StructField(nth, LongType())])
    found = stored(in_ranges(rows, *keys).mapInArrow(counted, schema), "numbered")
    sizes = found.groupBy(part).agg(F.count("*").alias("n"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # over one row of each range
    before = sizes.select(part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return found.join(F.broadcast(before), part).withColumn(name, F.col("before") + F.col(nth)).drop(part, nth, "before")


def zipf_counts(ranks: DataFrame, size: int) -> DataFrame:
    """How often the word of each rank appears in a stream of about ``size`` words, exponent 1.5."""
    zeta = F.lit(2.612375348685488)  # sum over r of r ** -1.5
    return ranks.select("rank", F.floor(F.lit(float(size)) * F.pow(F.col("rank").cast("double"), F.lit(-1.5)) / zeta).cast("long").alias("n"))
