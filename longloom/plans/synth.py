"""Synthetic long-context tasks: rows, their gold answer and their rendering.

Every sample is built inside its own row from hashes of (seed, task, sample,
slot), so generation needs no shuffle, and gives the same samples under any
partitioning. Graph tasks also lay their edges out as one table for all
samples, as node ids never repeat between samples, and answer them together.

A task is a function of (params, pool): params has sample_id and size; pool is
an array column of distinct words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import chance, hashed, hex_id, letters, median_text, pick, pick_between, rounded_mean, shuffled
from ..functions.text import json_list, token_count
from ..operators import graph
from ..sources.storage import stored
from . import budget
from .shape import fewshot_block

# Labels and sentences of the tasks.
CATEGORIES = ("fruit", "metal", "animal", "color", "country", "planet", "tool", "gem", "flower", "fish", "bird", "vehicle")
NOISE = "The grass is green. The sky is blue. The sun is yellow. Here we go. There and back again."
GRAPH_PREAMBLE = (
    'You are given a directed graph as a list of edges, one per line in the form "A -> B", meaning there is a directed edge '
    "from node A to node B. Node names are random hexadecimal strings, the edges are listed in arbitrary order, and every node "
    "has degree at least 1.\n\nDefinitions: the children (direct successors) of a node X are the nodes Y with an edge X -> Y; "
    "the parents (direct predecessors) of X are the nodes Y with an edge Y -> X; a BFS from X reaches a node at depth d when its "
    "shortest directed path from X uses exactly d edges.\n\nPerform the requested operation and respond with only the answer:\n"
    '  ["node1", "node2", ...]   for a set of nodes (use [] if empty)\n  <integer>                 for a numeric answer\n'
    "  Yes   (or No)             for a yes/no answer"
)
EDGE_HEADING = "The graph has the following edges:"

COLUMNS = ("sample_id", "task", "instruction", "context", "question", "answer_prefix", "answers", "gold", "answer_type", "meta")


@dataclass(frozen=True)
class Task:
    name: str
    build: Callable[[DataFrame, int], DataFrame]
    reserve_tokens: int
    min_size: int


TASKS: dict[str, Task] = {}


def task(name: str, reserve: int, least: int):
    def add(f):
        TASKS[name] = Task(name, f, reserve, least)
        return f

    return add


def get_task(name: str) -> Task:
    if name not in TASKS:
        raise KeyError(f"unknown task {name!r}; known: {', '.join(sorted(TASKS))}")
    return TASKS[name]


def params(spark: SparkSession, n: int, size: int, pool: list[str] | DataFrame, first: int = 0) -> DataFrame:
    """(sample_id, size, pool) for ``n`` samples; the pool is one list for all, or one for each ``sample_id``."""
    rows = spark.range(first, first + n).select(F.col("id").alias("sample_id"), F.lit(size).alias("size"))
    if isinstance(pool, DataFrame) and "sample_id" in pool.columns:
        return rows.join(pool.groupBy("sample_id").agg(F.array_sort(F.collect_set("word")).alias("pool")), "sample_id")
    if isinstance(pool, DataFrame):
        return rows.join(F.broadcast(pool.agg(F.array_sort(F.collect_set("word")).alias("pool"))))
    return rows.withColumn("pool", F.array(*map(F.lit, pool)))


# Rows ------------------------------------------------------------------------

_K = "task"


def _key(name: str, seed: int, *slots):
    return (seed, name, F.col("sample_id"), *slots)


def _sampled(name: str, seed: int, n: Column) -> Column:
    """``n`` words of the pool, without replacement while it lasts: an arithmetic walk round the pool."""
    size = F.size("pool")
    start, step = pick(size, *_key(name, seed, "start")), pick(size - 1, *_key(name, seed, "step")) + 1
    # a step without a common divisor visits every word once
    step = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(60)), lambda i: (step + i) % size + 0), lambda s: _gcd_is_one(s, size)), 1)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at("pool", (F.pmod(start + i * F.coalesce(step, F.lit(1)), size) + 1).cast("int")))


def _gcd_is_one(a: Column, b: Column) -> Column:
    """Euclid's steps, folded; 48 are enough for 32-bit numbers."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    run = F.aggregate(
        F.sequence(F.lit(1), F.lit(48)), start,
        lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.when(s["b"] == 0, F.lit(0).cast("long")).otherwise(s["a"] % F.nullif(s["b"], F.lit(0).cast("long"))).alias("b"))),
        lambda s: s["a"],
    )
    return run == 1


def _repeated(words: Column, times: Callable[[Column, Column], Column]) -> Column:
    return F.flatten(F.transform(words, lambda w, i: F.array_repeat(w, times(w, i).cast("int"))))


def _numbered(items: Column, joiner: str = " ") -> Column:
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x.cast("string"))), joiner)


def _records(name: str, seed: int) -> Column:
    """Records (name, category, value 1 to 999)."""
    words = _sampled(name, seed, F.col("size"))
    labels = F.array(*map(F.lit, CATEGORIES))
    return F.transform(words, lambda w, i: F.struct(
        w.alias("name"), F.element_at(labels, (pick(len(CATEGORIES), *_key(name, seed, "cat", i)) + 1).cast("int")).alias("category"),
        pick_between(1, 999, *_key(name, seed, "value", i)).cast("int").alias("value"),
    ))


def _record_lines(records: Column) -> Column:
    return F.array_join(F.transform(records, lambda r, i: F.format_string("%d. %s | category: %s | value: %d", i + 1, r["name"], r["category"], r["value"])), "\n")


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _sample(rows: DataFrame, name: str, instruction: str, context, question, prefix, answers, gold, kind, **meta) -> DataFrame:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    m = F.struct(*(lit(v).alias(k) for k, v in meta.items())) if meta else F.struct(F.lit(name).alias("task"))
    return rows.select(
        "sample_id", F.lit(name).alias("task"), F.lit(instruction).alias("instruction"), lit(context).alias("context"), lit(question).alias("question"),
        lit(prefix).alias("answer_prefix"), answers.alias("answers"), gold.alias("gold"), lit(kind).alias("answer_type"), _json(m).alias("meta"),
    )


@task("common_words", 160, 20)
def common_words(p: DataFrame, seed: int) -> DataFrame:
    p = p.withColumn("words", _sampled("common_words", seed, 10 + F.greatest(F.lit(10), F.col("size"))))
    p = p.withColumn("common", F.slice("words", 1, 10))
    stream = shuffled(_repeated(F.col("words"), lambda w, i: F.when(i < 10, 30).otherwise(3)), *_key("common_words", seed, "mix"))
    return _sample(
        p, "common_words",
        "Below is a numbered list of words. Some words appear far more often than others. Memorize the ones that appear most often.",
        _numbered(stream), "Question: What are the 10 most common words in the list above?", "The most common words are:",
        F.col("common"), _json(F.col("common")), "list", num_cw=10, common_rep=30, uncommon_rep=3,
    )


@task("freq_words", 96, 63)
def freq_words(p: DataFrame, seed: int) -> DataFrame:
    """At least 63 words, as below that ranks 4 and 5 may tie."""
    n = F.greatest(F.lit(20), F.floor(F.col("size") / 20).cast("int"))
    vocabulary = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i == 0, "...").otherwise(letters(6, *_key("freq_words", seed, i))))
    p = p.withColumn("words", vocabulary)
    times = lambda w, i: F.floor(F.col("size") * F.pow((i + 1).cast("double"), F.lit(-1.5)) / F.lit(2.612375348685488))
    stream = shuffled(_repeated(F.col("words"), times), *_key("freq_words", seed, "mix"))
    gold = F.slice("words", 2, 3)
    return _sample(
        p, "freq_words",
        "Read the following stream of coded words and track how often each one appears. Ignore the dots '...'.",
        F.array_join(stream, " "), "Question: What are the three most frequently appearing coded words (excluding '...')?",
        "The three most frequent words are:", gold, _json(gold), "list", alpha=1.5, vocab_size=F.size("words"),
    )


def _with_chain(lines: Column, chain: Column, name: str, seed: int) -> Column:
    """The chain's lines among noise, in order, at sorted random places."""
    places = F.array_sort(F.slice(shuffled(F.sequence(F.lit(0), F.size(lines) - 1), *_key(name, seed, "places")), 1, F.size(chain)))
    noise = F.transform(lines, lambda x, i: F.struct(i.alias("at"), F.lit(1).alias("kind"), x.alias("line")))
    marked = F.transform(chain, lambda x, i: F.struct(F.element_at(places, i + 1).alias("at"), F.lit(0).alias("kind"), x.alias("line")))
    return F.array_join(F.transform(F.array_sort(F.concat(noise, marked)), lambda s: s["line"]), "\n")


def _names(name: str, seed: int) -> Column:
    """Five names of five letters; a digit of the slot in base 26 keeps them apart."""
    return F.array(*(F.concat(letters(4, *_key(name, seed, "var", i), upper=True), F.chr((F.pmod(pick(26, *_key(name, seed, "last")) + i, F.lit(26)) + 65).cast("long"))) for i in range(5)))


@task("variable_tracking", 96, 12)
def variable_tracking(p: DataFrame, seed: int) -> DataFrame:
    name = "variable_tracking"
    p = p.withColumn("names", _names(name, seed)).withColumn("value", pick_between(10000, 99999, *_key(name, seed, "value")).cast("string"))
    chain = F.transform("names", lambda x, i: F.concat(F.lit("VAR "), x, F.lit(" = "), F.when(i == 0, F.col("value")).otherwise(F.concat(F.lit("VAR "), F.get("names", i - 1)))))
    return _sample(
        p, name, "Memorize and track the chain of variable assignments hidden in the following text.",
        _with_chain(F.array_repeat(F.lit(NOISE), F.col("size")), chain, name, seed),
        F.concat(F.lit("Question: Find all variables that are assigned the value "), "value", F.lit(".")),
        F.concat(F.lit("The variables assigned the value "), "value", F.lit(" are:")),
        F.col("names"), _json(F.col("names")), "list", num_chains=1, num_hops=4, value=F.col("value"),
    )


@task("variable_arithmetic", 48, 12)
def variable_arithmetic(p: DataFrame, seed: int) -> DataFrame:
    name = "variable_arithmetic"
    steps = F.array(*(
        F.struct(F.element_at(F.array(F.lit("+"), F.lit("-"), F.lit("*")), (pick(3, *_key(name, seed, "op", i)) + 1).cast("int")).alias("op"),
                 pick_between(1, 9, *_key(name, seed, "c", i)).alias("c"))
        for i in range(4)
    ))
    p = p.withColumn("names", _names(name, seed)).withColumn("first", pick_between(1, 20, *_key(name, seed, "first"))).withColumn("steps", steps)

    def apply(acc, s):
        return F.when(s["op"] == "+", acc + s["c"]).when(s["op"] == "-", acc - s["c"]).otherwise(acc * s["c"])

    p = p.withColumn("result", F.aggregate("steps", F.col("first"), apply)).withColumn("target", F.get("names", F.lit(4)))
    start = F.array(F.concat(F.lit("VAR "), F.get("names", F.lit(0)), F.lit(" = "), F.col("first").cast("string")))
    rest = F.transform("steps", lambda s, i: F.concat(F.lit("VAR "), F.get("names", i + 1), F.lit(" = VAR "), F.get("names", i), F.lit(" "), s["op"], F.lit(" "), s["c"].cast("string")))
    value = F.col("result").cast("string")
    return _sample(
        p, name, "Track the chain of arithmetic variable assignments hidden in the text below.",
        _with_chain(F.array_repeat(F.lit(NOISE), F.col("size")), F.concat(start, rest), name, seed),
        F.concat(F.lit("Question: What is the final integer value of VAR "), "target", F.lit("?")),
        F.concat(F.lit("The value of VAR "), "target", F.lit(" is")), F.array(value), value, "int", num_hops=4, target=F.col("target"),
    )


@task("count_occurrences", 32, 20)
def count_occurrences(p: DataFrame, seed: int) -> DataFrame:
    name = "count_occurrences"
    p = p.withColumn("words", F.array_distinct(_sampled(name, seed, F.greatest(F.lit(10), F.floor(F.col("size") / 4).cast("int")))))
    most = F.greatest(F.lit(3), F.floor(F.col("size") / 20).cast("int"))
    planted = pick(most - 1, *_key(name, seed, "planted")) + 2
    stream = _repeated(F.col("words"), lambda w, i: F.when(i == 0, planted).otherwise(pick_between(1, 4, *_key(name, seed, "n", i))))
    p = p.withColumn("stream", shuffled(stream, *_key(name, seed, "mix"))).withColumn("target", F.get("words", F.lit(0)))
    count = F.size(F.filter("stream", lambda w: w == F.col("target"))).cast("string")
    return _sample(
        p, name, "Below is a numbered list of words.", _numbered(F.col("stream")),
        F.concat(F.lit("Question: How many times does the word '"), "target", F.lit("' appear in the list?")),
        F.concat(F.lit("The word '"), "target", F.lit("' appears")), F.array(F.concat(count, F.lit(" times")), count), count, "int", target=F.col("target"),
    )


@task("count_distinct", 32, 20)
def count_distinct(p: DataFrame, seed: int) -> DataFrame:
    name = "count_distinct"
    words = _sampled(name, seed, F.greatest(F.lit(5), F.floor(F.col("size") / 4).cast("int")))
    p = p.withColumn("stream", shuffled(_repeated(words, lambda w, i: pick_between(1, 5, *_key(name, seed, "n", i))), *_key(name, seed, "mix")))
    gold = F.size(F.array_distinct("stream")).cast("string")
    return _sample(
        p, name, "Below is a numbered list of words, where some words are repeated.", _numbered(F.col("stream")),
        "Question: How many distinct (unique) words appear in the list?", "The number of distinct words is", F.array(gold), gold, "int",
    )


@task("count_predicate", 32, 10)
def count_predicate(p: DataFrame, seed: int) -> DataFrame:
    name = "count_predicate"
    p = p.withColumn("r", _records(name, seed)).withColumn("kind", pick(4, *_key(name, seed, "kind")))
    p = p.withColumn("t", pick_between(200, 800, *_key(name, seed, "t"))).withColumn("low", pick_between(100, 400, *_key(name, seed, "low")))
    p = p.withColumn("high", pick_between(500, 900, *_key(name, seed, "high")))
    p = p.withColumn("c", F.element_at(F.array(*map(F.lit, CATEGORIES)), (pick(len(CATEGORIES), *_key(name, seed, "asked")) + 1).cast("int")))

    def matches(r):
        v = r["value"]
        return (
            F.when(F.col("kind") == 0, v > F.col("t")).when(F.col("kind") == 1, v < F.col("t"))
            .when(F.col("kind") == 2, r["category"] == F.col("c")).otherwise(v.between(F.col("low"), F.col("high")))
        )

    gold = F.size(F.filter("r", matches)).cast("string")
    question = (
        F.when(F.col("kind") == 0, F.format_string("Question: How many records have a value greater than %d?", "t"))
        .when(F.col("kind") == 1, F.format_string("Question: How many records have a value less than %d?", "t"))
        .when(F.col("kind") == 2, F.format_string("Question: How many records have category '%s'?", "c"))
        .otherwise(F.format_string("Question: How many records have a value between %d and %d inclusive?", "low", "high"))
    )
    return _sample(
        p, name, "Below is a list of records. Each record has a name, a category, and a numeric value.", _record_lines(F.col("r")),
        question, "The count is", F.array(gold), gold, "int", predicate=F.element_at(F.array(*map(F.lit, ("gt", "lt", "category", "between"))), (F.col("kind") + 1).cast("int")),
    )


def _by_category(name: str, seed: int, value: Callable[[Column], Column], p: DataFrame) -> DataFrame:
    p = p.withColumn("r", _records(name, seed)).withColumn("cats", F.array_sort(F.array_distinct(F.transform("r", lambda r: r["category"]))))
    amount = lambda c: F.aggregate(F.filter("r", lambda r: r["category"] == c), F.lit(0).cast("long"), lambda a, r: a + value(r))
    return p.withColumn("amounts", F.transform("cats", amount))


def _category_sample(p: DataFrame, name: str, instruction: str, question: str) -> DataFrame:
    both = F.arrays_zip("cats", "amounts")
    answers = F.transform(both, lambda x: F.concat(x["cats"], F.lit(": "), x["amounts"].cast("string")))
    return _sample(
        p, name, instruction, _record_lines(F.col("r")), question, "", answers, _json(F.map_from_arrays("cats", "amounts")), "map", num_categories=F.size("cats"),
    )


@task("tally_by_category", 200, 10)
def tally_by_category(p: DataFrame, seed: int) -> DataFrame:
    return _category_sample(
        _by_category("tally_by_category", seed, lambda r: F.lit(1), p), "tally_by_category", "Below is a list of records, each tagged with a category.",
        "Question: How many records fall into each category? List every category that appears together with its count.",
    )


@task("group_by", 200, 10)
def group_by(p: DataFrame, seed: int) -> DataFrame:
    return _category_sample(
        _by_category("group_by", seed, lambda r: r["value"], p), "group_by", "Below is a list of records, each with a category and a numeric value.",
        "Question: For each category, what is the sum of values across all records in that category?",
    )


@task("numeric_agg", 32, 10)
def numeric_agg(p: DataFrame, seed: int) -> DataFrame:
    name = "numeric_agg"
    p = p.withColumn("v", F.transform(F.sequence(F.lit(1), F.col("size")), lambda i: pick_between(1, 999, *_key(name, seed, i)).cast("int")))
    p = p.withColumn("agg", F.element_at(F.array(*map(F.lit, ("sum", "min", "max", "mean", "median"))), (pick(5, *_key(name, seed, "agg")) + 1).cast("int")))
    p = p.withColumn("total", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x)).withColumn("mean", rounded_mean(F.col("total"), F.size("v")))
    gold = (
        F.when(F.col("agg") == "sum", F.col("total").cast("string")).when(F.col("agg") == "min", F.array_min("v").cast("string"))
        .when(F.col("agg") == "max", F.array_max("v").cast("string")).when(F.col("agg") == "mean", F.col("mean").cast("string"))
        .otherwise(median_text(F.col("v")))
    )
    return _sample(
        p, name, "Below is a numbered list of integers.", _numbered(F.col("v"), "\n"),
        F.format_string("Question: What is the %s of all the integers in the list?", "agg"), F.format_string("The %s is", "agg"), F.array(gold), gold, "number", agg=F.col("agg"), n=F.col("size"),
    )


@task("top_k", 96, 40)
def top_k(p: DataFrame, seed: int) -> DataFrame:
    name = "top_k"
    p = p.withColumn("k", F.when(pick(2, *_key(name, seed, "k")) == 0, 3).otherwise(5)).withColumn("base", F.greatest(F.floor(F.col("size") / 3).cast("int"), F.lit(6)))
    p = p.withColumn("words", F.array_distinct(_sampled(name, seed, F.col("k") + F.greatest(F.lit(5), F.floor(F.col("size") / 2).cast("int")))))
    times = lambda w, i: F.when(i < F.col("k"), F.col("base") + 3 * (F.col("k") - i)).otherwise(pick_between(1, 2, *_key(name, seed, "n", i)))
    stream = shuffled(_repeated(F.col("words"), times), *_key(name, seed, "mix"))
    gold = F.slice("words", F.lit(1), F.col("k"))
    return _sample(
        p, name, "Below is a numbered list of words.", _numbered(stream),
        F.format_string("Question: What are the %d most frequently occurring words, ordered from most to least frequent?", "k"),
        F.format_string("The %d most frequent words are:", "k"), gold, _json(gold), "list", k=F.col("k"),
    )


@task("set_ops", 200, 12)
def set_ops(p: DataFrame, seed: int) -> DataFrame:
    name = "set_ops"
    p = p.withColumn("n", F.greatest(F.lit(4), F.floor(F.col("size") / 2).cast("int"))).withColumn("half", F.floor(F.col("n") / 2).cast("int"))
    p = p.withColumn("words", _sampled(name, seed, 2 * F.col("n")))
    only_b = F.slice("words", F.col("n") + 1, F.col("n") - F.col("half"))
    p = p.withColumn("a", shuffled(F.slice("words", F.lit(1), F.col("n")), *_key(name, seed, "a")))
    p = p.withColumn("b", shuffled(F.concat(F.slice("words", F.lit(1), F.col("half")), only_b), *_key(name, seed, "b"))).withColumn("op", pick(3, *_key(name, seed, "op")))
    union = F.size(F.array_union("a", "b")).cast("string")
    found = F.array_sort(F.when(F.col("op") == 0, F.array_intersect("a", "b")).otherwise(F.array_except("a", "b")))
    size = F.col("op") == 1
    question = (
        F.when(F.col("op") == 0, "Question: Which words appear in BOTH Set A and Set B?")
        .when(size, "Question: How many distinct words appear in Set A or Set B (the size of their union)?")
        .otherwise("Question: Which words appear in Set A but NOT in Set B?")
    )
    prefix = F.when(F.col("op") == 0, "The words in both sets are:").when(size, "The size of the union is").otherwise("The words only in Set A are:")
    return _sample(
        p, name, "Below are two sets of words, Set A and Set B.",
        F.concat(F.lit("Set A: "), F.array_join("a", ", "), F.lit("\n\nSet B: "), F.array_join("b", ", ")), question, prefix,
        F.when(size, F.array(union)).otherwise(found), F.when(size, union).otherwise(_json(found)), F.when(size, "int").otherwise("list"),
        op=F.element_at(F.array(*map(F.lit, ("intersection", "union_size", "difference"))), (F.col("op") + 1).cast("int")),
    )


# Graphs ----------------------------------------------------------------------


def generated(p: DataFrame, name: str, seed: int, avg_deg: float = 2.5, acyclic: Column | None = None) -> DataFrame:
    """(sample_id, nodes, edges): a directed graph in each row.

    Each node is wired to one other, then hashed pairs follow up to avg_deg
    edges a node, without loops or repeats. An acyclic graph has its edges
    turned from the lower to the higher node.
    """
    acyclic = F.lit(False) if acyclic is None else acyclic
    n = F.greatest(F.lit(6), F.col("size"))
    p = p.withColumn("n", n).withColumn("nodes", F.transform(F.sequence(F.lit(0), n - 1), lambda i: hex_id(10, seed, name, F.col("sample_id"), "node", i)))
    target = F.floor(F.col("n") * avg_deg).cast("int")
    own = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(i.cast("long").alias("u"), F.pmod(i + 1 + pick(F.col("n") - 1, *_key(name, seed, "own", i)), F.col("n")).cast("long").alias("v")))
    more = F.transform(F.sequence(F.lit(0), 5 * target + 10), lambda i: F.struct(pick(F.col("n"), *_key(name, seed, "u", i)).cast("long").alias("u"), pick(F.col("n"), *_key(name, seed, "v", i)).cast("long").alias("v")))
    turned = F.transform(F.concat(own, more), lambda e: F.when(acyclic & (e["u"] > e["v"]), F.struct(e["v"].alias("u"), e["u"].alias("v"))).otherwise(e))
    kept = F.slice(F.array_distinct(F.filter(turned, lambda e: e["u"] != e["v"])), F.lit(1), F.greatest(target, F.col("n")))
    named = F.transform(kept, lambda e: F.struct(F.get("nodes", e["u"].cast("int")).alias("u"), F.get("nodes", e["v"].cast("int")).alias("v")))
    return p.select("sample_id", "nodes", shuffled(named, *_key(name, seed, "order")).alias("edges"))


def edge_lines(edges: Column) -> Column:
    return F.concat(F.lit(EDGE_HEADING + "\n"), F.array_join(F.transform(edges, lambda e: F.concat(e["u"], F.lit(" -> "), e["v"])), "\n"))


def _edge_table(graphs: DataFrame) -> DataFrame:
    return graphs.select("sample_id", F.explode("edges").alias("e")).select("sample_id", "e.u", "e.v")


def _chosen(rows: DataFrame, column: str, *parts) -> DataFrame:
    """One value of ``column`` for each sample: the one of the smallest hash."""
    return rows.groupBy("sample_id").agg(F.min_by(column, hashed(*parts, F.col("sample_id"), F.col(column))).alias(column))


def _lists(found: DataFrame) -> DataFrame:
    return found.groupBy("sample_id").agg(F.array_sort(F.collect_set("node")).alias("nodes_found"))


def _graph_sample(graphs: DataFrame, name: str, question: Column, gold: Column, kind: str, **meta) -> DataFrame:
    answers = F.array(json_list(F.col("nodes_found"))) if kind == "list" else F.array(gold)
    gold = _json(F.col("nodes_found")) if kind == "list" else _json(F.struct(gold.alias("x"))).substr(F.lit(6), F.length(_json(F.struct(gold.alias("x")))) - 6) if kind == "string" else gold
    return _sample(
        graphs, name, GRAPH_PREAMBLE, edge_lines(F.col("edges")),
        F.concat(F.lit("Operation:\n"), question), "", answers, gold, kind, **meta,
    )


def _asked(p: DataFrame, name: str, seed: int, end: str = "u", **options):
    graphs = stored(generated(p, name, seed, **options), "graphs")
    edges = _edge_table(graphs)
    start = _chosen(edges.select("sample_id", F.col(end).alias("node")), "node", seed, name, "start")
    return graphs, edges, stored(start, "starts")


def _neighbours(name: str, end: str, other: str, words: str):
    @task(name, 512, 6)
    def build(p: DataFrame, seed: int) -> DataFrame:
        graphs, edges, start = _asked(p, name, seed, end)
        found = _lists(edges.join(start.withColumnRenamed("node", end), ["sample_id", end]).select("sample_id", F.col(other).alias("node")))
        rows = graphs.join(start, "sample_id").join(found, "sample_id")
        return _graph_sample(rows, name, F.concat(F.lit(f"List all {words} of node "), "node", F.lit(".")), F.lit(None), "list", node=F.col("node"))


_neighbours("graph_children", "u", "v", "children (direct successors)")
_neighbours("graph_parents", "v", "u", "parents (direct predecessors)")


def _closure(name: str, end: str, words: str):
    @task(name, 512, 6)
    def build(p: DataFrame, seed: int) -> DataFrame:
        graphs, edges, start = _asked(p, name, seed, end)
        along = edges if end == "u" else graph.reversed_edges(edges)
        found = graph.reachable(along, start.select("node"))
        found = _lists(found.join(start.withColumnRenamed("node", "start"), "start").select("sample_id", "node"))
        rows = graphs.join(start, "sample_id").join(found, "sample_id", "left").withColumn("nodes_found", F.coalesce("nodes_found", F.array().cast("array<string>")))
        return _graph_sample(rows, name, F.format_string(words, "node"), F.lit(None), "list", node=F.col("node"))


_closure("graph_descendants", "u", "List all descendants of node %s (every node reachable by following directed edges from it).")
_closure("graph_ancestors", "v", "List all ancestors of node %s (every node that can reach it by following directed edges).")


@task("graph_bfs", 512, 6)
def graph_bfs(p: DataFrame, seed: int) -> DataFrame:
    graphs, edges, start = _asked(p, "graph_bfs", seed)
    layers = graph.bfs(edges, start.select("node")).where("depth > 0").join(start.withColumnRenamed("node", "start"), "start")
    layers = stored(layers, "layers")
    asked = _chosen(layers.select("sample_id", "depth").distinct(), "depth", seed, "graph_bfs", "depth")
    found = _lists(layers.join(asked, ["sample_id", "depth"]))
    rows = graphs.join(start, "sample_id").join(asked, "sample_id").join(found, "sample_id")
    question = F.format_string("Perform a BFS from node %s and list every node that is exactly %d step(s) away.", "node", "depth")
    return _graph_sample(rows, "graph_bfs", question, F.lit(None), "list", start=F.col("node"), depth=F.col("depth"))


@task("graph_shortest_path", 512, 6)
def graph_shortest_path(p: DataFrame, seed: int) -> DataFrame:
    name = "graph_shortest_path"
    graphs, edges, start = _asked(p, name, seed)
    layers = stored(graph.bfs(edges, start.select("node")).where("depth > 0").join(start.withColumnRenamed("node", "start"), "start"), "layers")
    dst = _chosen(layers.select("sample_id", "node"), "node", seed, name, "dst")
    rows = graphs.join(start.withColumnRenamed("node", "src"), "sample_id").join(dst.join(layers.select("sample_id", "node", "depth"), ["sample_id", "node"]), "sample_id")
    question = F.format_string("Find the length (number of edges) of the shortest directed path from node %s to node %s.", "src", "node")
    return _graph_sample(rows, name, question, F.col("depth").cast("string"), "int", src=F.col("src"), dst=F.col("node"))


@task("graph_reachable", 512, 6)
def graph_reachable(p: DataFrame, seed: int) -> DataFrame:
    name = "graph_reachable"
    graphs = stored(generated(p, name, seed), "graphs")
    every = graphs.select("sample_id", F.explode("nodes").alias("node"))
    start = stored(_chosen(every, "node", seed, name, "start").withColumnRenamed("node", "src"), "starts")
    reach = graph.reachable(_edge_table(graphs), start.select(F.col("src").alias("node"))).select(F.col("start").alias("src"), "node").join(start, "src")
    reach = stored(reach.select("sample_id", "node", F.lit(True).alias("yes")), "reach")
    others = every.join(start, "sample_id").where("node <> src").join(reach, ["sample_id", "node"], "left").withColumn("yes", F.coalesce("yes", F.lit(False)))
    # a coin says which kind to ask for; the other kind stands in where there is none
    wanted = chance(0.5, seed, name, F.col("sample_id"), "coin")
    asked = others.groupBy("sample_id").agg(F.min(F.struct((F.col("yes") != wanted).alias("off"), hashed(seed, name, F.col("node")).alias("h"), "node", "yes")).alias("x"))
    rows = graphs.join(start, "sample_id").join(asked.select("sample_id", "x.node", "x.yes"), "sample_id")
    question = F.format_string("Is node %s reachable from node %s by following directed edges? Answer Yes or No.", "node", "src")
    return _graph_sample(rows, name, question, F.when(F.col("yes"), "Yes").otherwise("No"), "string", src=F.col("src"), dst=F.col("node"))


@task("graph_cycle", 512, 6)
def graph_cycle(p: DataFrame, seed: int) -> DataFrame:
    """About half the graphs are acyclic; in the other half every node has a successor, so there is a cycle."""
    graphs = stored(generated(p, "graph_cycle", seed, acyclic=chance(0.5, seed, "graph_cycle", F.col("sample_id"), "dag")), "graphs")
    cyclic = graph.peel(_edge_table(graphs), ["sample_id"]).select("sample_id").distinct().withColumn("yes", F.lit("Yes"))
    rows = graphs.join(cyclic, "sample_id", "left")
    return _graph_sample(rows, "graph_cycle", F.lit("Does this directed graph contain a cycle? Answer Yes or No."), F.coalesce("yes", F.lit("No")), "string", op="cycle")


@task("graph_component_size", 512, 6)
def graph_component_size(p: DataFrame, seed: int) -> DataFrame:
    name = "graph_component_size"
    graphs = stored(generated(p, name, seed, avg_deg=1.3), "graphs")
    start = stored(_chosen(graphs.select("sample_id", F.explode("nodes").alias("node")), "node", seed, name, "start"), "starts")
    found = graph.weak_component(_edge_table(graphs), start.select("node")).groupBy(F.col("start").alias("node")).agg(F.count("*").alias("n"))
    rows = graphs.join(start, "sample_id").join(found, "node")
    question = F.format_string("How many nodes are in the connected component containing node %s (treating every edge as undirected)?", "node")
    return _graph_sample(rows, name, question, F.col("n").cast("string"), "int", node=F.col("node"))


@task("graph_max_degree", 512, 6)
def graph_max_degree(p: DataFrame, seed: int) -> DataFrame:
    graphs = stored(generated(p, "graph_max_degree", seed), "graphs")
    ends = _edge_table(graphs).select("sample_id", F.explode(F.array("u", "v")).alias("node"))
    d = ends.groupBy("sample_id", "node").agg(F.count("*").alias("degree"))
    found = d.join(d.groupBy("sample_id").agg(F.max("degree").alias("degree")), ["sample_id", "degree"])
    rows = graphs.join(found.groupBy("sample_id").agg(F.array_sort(F.collect_set("node")).alias("nodes_found"), F.max("degree").alias("degree")), "sample_id")
    question = F.lit("List the node(s) with the highest total degree (in-degree plus out-degree).")
    return _graph_sample(rows, "graph_max_degree", question, F.lit(None), "list", degree=F.col("degree"))


# Sizes -----------------------------------------------------------------------


def builder(name: str, pool, seed: int = 42) -> budget.Build:
    """The task as a function of rows (sample_id, size); ``pool`` is a list, or rows (wid, word) to deal from."""
    t = get_task(name)

    def build(rows: DataFrame) -> DataFrame:
        if isinstance(pool, DataFrame):
            words = budget.dealt_words(rows, pool, name, seed)
            rows = rows.join(words.groupBy("sample_id").agg(F.array_sort(F.collect_set("word")).alias("pool")), "sample_id")
        else:
            rows = rows.withColumn("pool", F.array(*map(F.lit, pool)))
        return t.build(rows, seed).select(*COLUMNS)

    return build


def fit_size(spark: SparkSession, name: str, budget_tokens: int, pool, seed: int = 42, grid: int = 24, count=token_count, head: str = "") -> int:
    """The largest size of a task whose sample fits the budget; the task's least size if none does."""
    return budget.fitted_size(spark, builder(name, pool, seed), budget_tokens, get_task(name).min_size, count, head, grid=grid)


def fitted(spark: SparkSession, name: str, n: int, max_tokens: int, pool, seed: int = 42, count=token_count, shots: int = 0) -> tuple[DataFrame, str]:
    """(``n`` samples with size and length, worked examples): prompts of at most ``max_tokens`` less the task's reserve.

    The worked examples are ``shots`` samples of the least size under another seed, part of every prompt.
    """
    t = get_task(name)
    head = fewshot_block(budget.within_budget(spark, builder(name, pool, seed * 7 + 1), shots, t.min_size, 0, t.min_size, count), shots) if shots else ""
    room = max_tokens - t.reserve_tokens
    size = fit_size(spark, name, room, pool, seed, count=count, head=head)
    return budget.within_budget(spark, builder(name, pool, seed), n, size, room, t.min_size, count, head), head


def samples(spark: SparkSession, name: str, n: int, size: int, pool, seed: int = 42) -> DataFrame:
    """``n`` samples of a task; ids are the task's name and a number."""
    t = get_task(name)
    return t.build(params(spark, n, max(size, t.min_size), pool), seed).select(*COLUMNS)
