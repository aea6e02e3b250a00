"""Cutting documents into units, passages, chunks and spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import pick
from ..functions.text import paragraphs, token_count, units, words

# Fences and heading that passages must not contain.
MARKUP = ("<<<", ">>>", "Paragraph ")


def _measured(items: Column, count) -> Column:
    return F.transform(items, lambda x: F.struct(x.alias("text"), count(x).alias("n_tok")))


def word_windows(text: Column, size: int) -> Column:
    """Consecutive windows of ``size`` words, each joined by single blanks.

    The words are bound to a lambda's variable, so that the text is split once and not once for each window.
    """

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(size))
        found = F.transform(starts, lambda i: F.array_join(F.slice(w, i + 1, size), " "))
        return F.when(F.size(w) > 0, found).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(words(text)), cut), F.lit(0))


def _fits(items: Column, most: int, window: int, count) -> Column:
    """Items over ``most`` tokens cut into windows of words."""
    return F.flatten(F.transform(items, lambda x: F.when(count(x) > most, word_windows(x, window)).otherwise(F.array(x))))


def packed(items: Column, target: Column | int, count=token_count, joiner: str = "\n\n", jitter: float = 0.0, key: Column | None = None) -> Column:
    """Greedy packing of texts: array of struct(text, n_tok).

    A pack is closed when it holds something and the next text would take it
    over the target. With ``jitter`` each pack's target is drawn within that
    share of ``target``, by ``key`` and the pack's number.
    """
    target = F.lit(target) if isinstance(target, int) else target

    def limit(acc: Column) -> Column:
        if not jitter:
            return target.cast("double")
        return target * (1 - jitter + 2 * jitter * pick(10_001, key, F.size(acc["done"])) / 10_000)

    piece = "struct<text:string,n_tok:bigint>"
    start = F.struct(F.array().cast(f"array<{piece}>").alias("done"), F.lit("").alias("text"), F.lit(0).cast("long").alias("n_tok"))

    def step(acc: Column, x: Column) -> Column:
        full = (acc["n_tok"] > 0) & (acc["n_tok"] + x["n_tok"] > limit(acc))
        closed = F.when(full, F.array_append(acc["done"], F.struct(acc["text"].alias("text"), acc["n_tok"].alias("n_tok")))).otherwise(acc["done"])
        text = F.when(full | (acc["n_tok"] == 0), x["text"]).otherwise(F.concat(acc["text"], F.lit(joiner), x["text"]))
        n = F.when(full, F.lit(0).cast("long")).otherwise(acc["n_tok"]) + x["n_tok"]
        return F.struct(closed.alias("done"), text.alias("text"), n.alias("n_tok"))

    def last(acc: Column) -> Column:
        tail = F.struct(acc["text"].alias("text"), acc["n_tok"].alias("n_tok"))
        return F.when(acc["n_tok"] > 0, F.array_append(acc["done"], tail)).otherwise(acc["done"])

    return F.aggregate(_measured(items, count), start, step, last)


def make_units(
    text: Column, target: int, most: int | None = None, jitter: float = 0.0, key: Column | None = None, count=token_count
) -> Column:
    """Units of about ``target`` tokens for reordering: array of struct(text, n_tok)."""
    fitting = _fits(units(text), most or target, max(1, round(0.75 * target)), count)
    return packed(fitting, target, count, jitter=jitter, key=key)


def admissible(text: Column) -> Column:
    """Whether a passage is free of the markup that prompts are parsed by."""
    ok = F.lit(True)
    for m in MARKUP:
        ok = ok & ~F.contains(text, F.lit(m))
    return ok


def passages(text: Column, target: int = 256, least: int = 64, most: int = 512, count=token_count) -> Column:
    """Passages of a document, in order: packed paragraphs, and word windows of those over ``most`` tokens.

    An oversize paragraph closes the pack before it.
    """
    window = max(1, round(0.9 * target))
    parts = F.transform(paragraphs(text), lambda p: F.struct(p.alias("text"), count(p).alias("n_tok")))
    piece = "struct<text:string,n_tok:bigint>"
    start = F.struct(F.array().cast(f"array<{piece}>").alias("done"), F.lit("").alias("text"), F.lit(0).cast("long").alias("n_tok"))

    def step(acc: Column, x: Column) -> Column:
        over = x["n_tok"] > most
        full = (acc["n_tok"] > 0) & (over | (acc["n_tok"] + x["n_tok"] > target))
        held = F.struct(acc["text"].alias("text"), acc["n_tok"].alias("n_tok"))
        done = F.when(full, F.array_append(acc["done"], held)).otherwise(acc["done"])
        cut = F.transform(word_windows(x["text"], window), lambda w: F.struct(w.alias("text"), count(w).alias("n_tok")))
        done = F.when(over, F.concat(done, cut)).otherwise(done)
        text = F.when(over, F.lit("")).when(full | (acc["n_tok"] == 0), x["text"]).otherwise(F.concat(acc["text"], F.lit("\n\n"), x["text"]))
        n = F.when(over, F.lit(0).cast("long")).otherwise(F.when(full, F.lit(0).cast("long")).otherwise(acc["n_tok"]) + x["n_tok"])
        return F.struct(done.alias("done"), text.alias("text"), n.alias("n_tok"))

    def last(acc: Column) -> Column:
        tail = F.struct(acc["text"].alias("text"), acc["n_tok"].alias("n_tok"))
        return F.when(acc["n_tok"] > 0, F.array_append(acc["done"], tail)).otherwise(acc["done"])

    return F.filter(F.aggregate(parts, start, step, last), lambda p: (p["n_tok"] >= least) & admissible(p["text"]))


def passage_pool(docs: DataFrame, pool_size: int, order: str = "doc_id", **options) -> DataFrame:
    """The first ``pool_size`` passages in corpus order: (pid, text, n_tok)."""
    found = docs.select(F.col(order).alias("o"), F.posexplode(passages(F.col("text"), **options)).alias("pos", "p"))
    first = found.orderBy("o", "pos").limit(pool_size)
    pid = F.row_number().over(Window.orderBy("o", "pos")) - 1  # over the pool only
    return first.select(pid.cast("long").alias("pid"), F.col("p.text").alias("text"), F.col("p.n_tok").alias("n_tok"))


def word_chunks(text: Column, chunk: int = 512, least: int = 128, count=token_count) -> Column:
    """Chunks of ``chunk`` words of at least ``least`` tokens.

    With the white-space tokenizer a chunk of words never has fewer tokens
    than words, so none needs to be extended.
    """
    found = F.transform(word_windows(text, chunk), lambda w: F.struct(w.alias("text"), count(w).alias("n_tok")))
    return F.filter(found, lambda c: c["n_tok"] >= least)


LABEL_TOKENS = 3


def flow_budget(flow: str, context_len: int) -> int:
    """Tokens for the units of a sample; an answer that repeats them halves it."""
    if flow not in ("reconstruct", "permutation"):
        raise ValueError(f"unknown flow {flow!r}")
    return context_len // 2 if flow == "reconstruct" else context_len - 1500


def take_span(rows: DataFrame, budget: int, seed: int, source: str = "src", order: str = "pos", tokens: str = "n_tok") -> DataFrame:
    """A contiguous span of each source's units within ``budget`` tokens, labels included.

    The whole source if it fits; otherwise from a start drawn among those with
    more than the budget behind them. The first unit is always taken.
    """
    cost = F.col(tokens) + LABEL_TOKENS
    backward = Window.partitionBy(source).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(source)
    rows = rows.withColumn("_left", F.sum(cost).over(backward))
    rows = rows.withColumn("_last", F.max(F.when(F.col("_left") > budget, F.col(order))).over(every))
    start = F.when(F.col("_last").isNull(), 0).otherwise(pick(F.col("_last") + 1, seed, F.col(source), "start"))
    rows = rows.withColumn("_start", start).where(F.col(order) >= F.col("_start"))
    forward = Window.partitionBy(source).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_run", F.sum(cost).over(forward))
    return rows.where((F.col("_run") <= budget) | (F.col(order) == F.col("_start"))).drop("_left", "_last", "_start", "_run")
