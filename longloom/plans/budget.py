"""Sizes that fit a token budget, and samples that keep to it.

A sample is built from (sample_id, size) by a function of such rows. Its length
is that of the rendered prompt with worked examples before it, by any
tokenizer. The rows of a round are built and measured together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import pick
from ..functions.text import library_token_count
from ..sources.storage import stored
from .shape import prompt_input

Build = Callable[[DataFrame], DataFrame]
Counter = Callable[[Column], Column]


def counter(spec: str = "whitespace") -> Counter:
    """Token counts of ``whitespace``, ``hf:<file>`` or ``tiktoken:<rank file>``."""
    return lambda text: library_token_count(text, spec)


def length(count: Counter, head: str = "", cue: bool = True) -> Column:
    """Tokens of a sample's prompt; with ``cue`` its answer cue on a line of its own counts too."""
    text = F.concat(F.lit(head), prompt_input(F.col("instruction"), F.col("context"), F.col("question")))
    return count(F.concat(text, F.lit("\n"), F.col("answer_prefix")) if cue else text).cast("int")


def fitted_size(spark: SparkSession, build: Build, budget: int, least: int, count: Counter, head: str = "", cue: bool = True, grid: int = 24) -> int:
    """The largest size whose sample fits ``budget`` tokens; ``least`` if none does.

    A few jobs of ``grid`` sizes each narrow it down.
    """
    low, high, best = least, max(4 * least, budget + budget // 4), least
    while high >= low:
        sizes = sorted({low + round((high - low) * i / grid) for i in range(grid + 1)})
        rows = spark.createDataFrame([(s, s) for s in sizes], "sample_id long, size int")
        built = build(rows).select("sample_id", length(count, head, cue).alias("n"))
        fits = {r[0] for r in built.where(F.col("n") <= budget).collect()}
        if not fits:
            break
        best = max(best, max(fits))
        above = [s for s in sizes if s > best]
        if not above or above[0] == best + 1:
            break
        low, high = best + 1, above[0] - 1
    return best


def within_budget(spark: SparkSession, build: Build, n: int, size: int, budget: int, least: int, count: Counter, head: str = "", cue: bool = True, first: int = 0) -> DataFrame:
    """``n`` samples of ``size`` or less: those over ``budget`` are built again at nine tenths of their size.

    A sample of the ``least`` size stays, whatever its length. Adds ``length``
    and ``size``. A size shrinks by a tenth a round, so rounds grow with its
    logarithm; only what is still over goes into the next one.
    """
    todo = spark.range(first, first + n).select(F.col("id").alias("sample_id"), F.lit(max(size, least)).alias("size"))
    done = None
    while True:
        built = build(todo).join(todo, "sample_id").withColumn("length", length(count, head, cue))
        built = stored(built, "built")
        fits = (F.col("length") <= budget) | (F.col("size") <= least)
        done = built.where(fits) if done is None else done.unionByName(built.where(fits))
        smaller = F.greatest(F.lit(least), F.floor(F.col("size") * 9 / 10).cast("int"))
        todo = stored(built.where(~fits).select("sample_id", smaller.alias("size")), "over")
        if todo.isEmpty():
            return done


def dealt_words(rows: DataFrame, words: DataFrame, key: str, seed: int = 42, more: int = 40) -> DataFrame:
    """(sample_id, word): ``size + more`` words of the whole list for each row (sample_id, size), all different while it lasts.

    Words are numbered once and drawn along an arithmetic walk, so no sample
    carries the list. ``words`` is (wid, word) from ``numbered_words``.
    """
    total = words.agg(F.count("*").alias("total"))
    rows = rows.join(F.broadcast(total)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("size") + more - 1)))
    primes = F.array(*map(F.lit, (7919, 104729, 611953, 1299709)))
    step = F.element_at(F.filter(primes, lambda p: F.col("total") % p != 0), 1)
    wid = F.pmod(pick(F.col("total"), seed, key, F.col("sample_id"), "words") + F.col("i") * step, F.col("total"))
    return rows.select("sample_id", wid.alias("wid")).join(words, "wid").select("sample_id", "word").distinct()


def numbered_words(words: DataFrame) -> DataFrame:
    """(wid, word) of the distinct words: numbers from 0 in the order of a hash, by counts of ranges and offsets."""
    hashed = stored(words.select("word").distinct().select("word", F.xxhash64("word").alias("h")), "words")
    part = F.shiftright("h", 52)
    counts = hashed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # 4096 rows at most
    total, offsets = 0, []
    for part_, n in counts:
        offsets.append((part_, total))
        total += n
    from pyspark.sql import Window

    at = hashed.sparkSession.createDataFrame(offsets, "part long, before long")
    nth = F.row_number().over(Window.partitionBy("part").orderBy("h", "word")) - 1
    rows = hashed.withColumn("part", part).withColumn("nth", nth).join(F.broadcast(at), "part")
    return stored(rows.select((F.col("before") + F.col("nth")).alias("wid"), "word"), "numbered")
