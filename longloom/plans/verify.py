"""Golds recomputed from rendered text alone, by other code than made them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import median_text, rounded_mean
from ..functions.text import negative_markers, positive_markers
from ..operators import graph


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), group)


def _one(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


NUMBERED_WORD, NUMBERED_INT = r"\d+\.\s+([a-z]+)", r"\d+\.\s+(\d+)"
RECORD = r"\d+\.\s+([a-z]+) \| category: (\w+) \| value: (\d+)"


def _frequencies(samples: DataFrame, words: Column) -> DataFrame:
    exploded = samples.select("sample_id", F.posexplode(words).alias("pos", "word"))
    return exploded.groupBy("sample_id", "word").agg(F.count("*").alias("n"), F.min("pos").alias("first"))


def _ranked(counts: DataFrame, k: Column | int) -> DataFrame:
    """The most frequent words of each sample in order."""
    packed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg"), "first", "word")))
    return counts.groupBy("sample_id").agg(packed.alias("r")).select("sample_id", F.transform("r", lambda x: x["word"]).alias("ranked"))


def _strings(gold: Column) -> Column:
    return F.from_json(gold, "array<string>")


def check_words(samples: DataFrame, task: str) -> DataFrame:
    s = samples.where(F.col("task") == task)
    if task == "freq_words":
        words = F.filter(F.split("context", " "), lambda w: w != "...")
    else:
        words = _all(F.col("context"), NUMBERED_WORD)
    ranked = s.join(_ranked(_frequencies(s, words), 0), "sample_id")
    gold = _strings(F.col("gold"))
    if task == "common_words":
        ok = F.array_sort(F.slice("ranked", 1, 10)) == F.array_sort(gold)
    else:
        ok = F.slice("ranked", F.lit(1), F.size(gold)) == gold
    return ranked.select("task", "sample_id", ok.alias("ok"))


def check_counts(samples: DataFrame, task: str) -> DataFrame:
    s = samples.where(F.col("task") == task)
    words = _all(F.col("context"), NUMBERED_WORD)
    rows = s.select("task", "sample_id", "gold", _one(F.col("question"), "'([a-z]+)'").alias("t"), F.explode(words).alias("w"))
    n = F.countDistinct("w") if task == "count_distinct" else F.count_if(F.col("w") == F.col("t"))
    return rows.groupBy("task", "sample_id", "gold").agg(n.alias("n")).select("task", "sample_id", (F.col("n").cast("string") == F.col("gold")).alias("ok"))


def check_records(samples: DataFrame, task: str) -> DataFrame:
    s = samples.where(F.col("task") == task)
    text = F.col("context")
    zipped = F.arrays_zip(_all(text, RECORD, 2).alias("category"), _all(text, RECORD, 3).alias("value"))
    rows = s.select("task", "sample_id", "gold", "question", F.explode(zipped).alias("r"))
    rows = rows.select("task", "sample_id", "gold", "question", F.col("r.category").alias("category"), F.col("r.value").cast("int").alias("value"))
    if task == "count_predicate":
        q = F.col("question")
        low, high = _one(q, r"between (\d+) and"), _one(q, r"and (\d+) inclusive")
        ok = (
            F.when(F.contains(q, F.lit("greater than")), F.col("value") > _one(q, r"than (\d+)").try_cast("int"))
            .when(F.contains(q, F.lit("less than")), F.col("value") < _one(q, r"than (\d+)").try_cast("int"))
            .when(F.contains(q, F.lit("have category")), F.col("category") == _one(q, "'(\\w+)'"))
            .otherwise(F.col("value").between(low.try_cast("int"), high.try_cast("int")))
        )
        n = rows.groupBy("task", "sample_id", "gold").agg(F.count_if(ok).alias("n"))
        return n.select("task", "sample_id", (F.col("n").cast("string") == F.col("gold")).alias("ok"))
    amount = F.count("*") if task == "tally_by_category" else F.sum("value")
    groups = rows.groupBy("task", "sample_id", "gold", "category").agg(amount.alias("x"))
    found = groups.groupBy("task", "sample_id", "gold").agg(F.array_sort(F.collect_list(F.struct("category", "x"))).alias("found"))
    stated = F.array_sort(F.transform(F.map_entries(F.from_json("gold", "map<string,bigint>")), lambda e: F.struct(e["key"].alias("category"), e["value"].alias("x"))))
    return found.select("task", "sample_id", (F.col("found") == stated).alias("ok"))


def check_numbers(samples: DataFrame) -> DataFrame:
    s = samples.where("task = 'numeric_agg'")
    v = F.transform(_all(F.col("context"), NUMBERED_INT), lambda x: x.cast("int"))
    rows = s.withColumn("v", v).withColumn("agg", _one(F.col("question"), r"the (\w+) of"))
    total = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = rows.withColumn("mean", rounded_mean(total, F.size("v")))
    again = (
        F.when(F.col("agg") == "sum", total.cast("string")).when(F.col("agg") == "min", F.array_min("v").cast("string"))
        .when(F.col("agg") == "max", F.array_max("v").cast("string")).when(F.col("agg") == "mean", F.col("mean").cast("string")).otherwise(median_text(F.col("v")))
    )
    return rows.select("task", "sample_id", (again == F.col("gold")).alias("ok"))


def check_sets(samples: DataFrame) -> DataFrame:
    s = samples.where("task = 'set_ops'")
    a = F.split(_one(F.col("context"), r"(?s)Set A: (.*?)\n\n"), ", ")
    b = F.split(_one(F.col("context"), r"(?s)Set B: (.*)$"), ", ")
    again = (
        F.when(F.contains("question", F.lit("BOTH")), F.to_json(F.array_sort(F.array_intersect(a, b))))
        .when(F.contains("question", F.lit("union")), F.size(F.array_distinct(F.concat(a, b))).cast("string"))
        .otherwise(F.to_json(F.array_sort(F.array_except(a, b))))
    )
    return s.select("task", "sample_id", (again == F.col("gold")).alias("ok"))


def check_variables(samples: DataFrame, task: str) -> DataFrame:
    """Assignments parsed back and resolved in order."""
    s = samples.where(F.col("task") == task)
    lines = F.filter(F.split("context", "\n"), lambda x: F.startswith(x, F.lit("VAR ")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))

    def step(m, line):
        name, source = _one(line, r"^VAR ([A-Z]+) ="), _one(line, r"= VAR ([A-Z]+)")
        start, op, c = _one(line, r"= (\d+)$").try_cast("long"), _one(line, r"VAR [A-Z]+ ([+\-*]) \d+$"), _one(line, r"[+\-*] (\d+)$").try_cast("long")
        base = F.coalesce(start, F.element_at(m, source))
        value = F.when(op == "+", base + c).when(op == "-", base - c).when(op == "*", base * c).otherwise(base)
        return F.map_concat(m, F.map_from_arrays(F.array(name), F.array(value)))

    rows = s.withColumn("m", F.aggregate(lines, empty, step))
    if task == "variable_arithmetic":
        again = F.element_at("m", _one(F.col("question"), r"VAR ([A-Z]+)\?")).cast("string")
        ok = again == F.col("gold")
    else:
        value = _one(F.col("question"), r"value (\d+)\.").cast("long")
        ok = F.array_sort(F.map_keys(F.map_filter("m", lambda k, v: v == value))) == F.array_sort(_strings(F.col("gold")))
    return rows.select("task", "sample_id", ok.alias("ok"))


def parsed_edges(samples: DataFrame) -> DataFrame:
    pattern = r"([0-9a-f]+) -> ([0-9a-f]+)"
    zipped = F.arrays_zip(_all(F.col("context"), pattern, 1).alias("u"), _all(F.col("context"), pattern, 2).alias("v"))
    return samples.select("sample_id", F.explode(zipped).alias("e")).select("sample_id", "e.u", "e.v")


def check_graphs(samples: DataFrame, task: str) -> DataFrame:
    s = samples.where(F.col("task") == task)
    edges = parsed_edges(s)
    id_ = "([0-9a-f]{10})"
    q = F.col("question")
    ask = s.select("task", "sample_id", "gold", _one(q, f"node {id_}").alias("one"), _one(q, f"node {id_}.*node {id_}", 2).alias("two"), _one(q, r"exactly (\d+) step").try_cast("int").alias("depth"))

    def lists(found: DataFrame) -> DataFrame:
        got = found.groupBy("sample_id").agg(F.array_sort(F.collect_set("node")).alias("again"))
        joined = ask.join(got, "sample_id", "left")
        return joined.select("task", "sample_id", (F.coalesce("again", F.array().cast("array<string>")) == _strings(F.col("gold"))).alias("ok"))

    start = ask.select("sample_id", F.col("one").alias("node"))
    back = start.withColumnRenamed("node", "start")
    if task == "graph_children":
        return lists(edges.join(start.withColumnRenamed("node", "u"), ["sample_id", "u"]).select("sample_id", F.col("v").alias("node")))
    if task == "graph_parents":
        return lists(edges.join(start.withColumnRenamed("node", "v"), ["sample_id", "v"]).select("sample_id", F.col("u").alias("node")))
    if task == "graph_descendants":
        return lists(graph.reachable(edges, start.select("node")).join(back, "start"))
    if task == "graph_ancestors":
        return lists(graph.reachable(graph.reversed_edges(edges), start.select("node")).join(back, "start"))
    if task == "graph_bfs":
        return lists(graph.bfs(edges, start.select("node")).join(ask.select("sample_id", F.col("one").alias("start"), "depth"), ["start", "depth"]))
    if task == "graph_max_degree":
        d = edges.select("sample_id", F.explode(F.array("u", "v")).alias("node")).groupBy("sample_id", "node").agg(F.count("*").alias("degree"))
        return lists(d.join(d.groupBy("sample_id").agg(F.max("degree").alias("degree")), ["sample_id", "degree"]))
    if task == "graph_cycle":
        yes = graph.peel(edges, ["sample_id"]).select("sample_id").distinct().withColumn("again", F.lit("Yes"))
        joined = ask.join(yes, "sample_id", "left").withColumn("again", F.concat(F.lit('"'), F.coalesce("again", F.lit("No")), F.lit('"')))
        return joined.select("task", "sample_id", (F.col("again") == F.col("gold")).alias("ok"))
    if task == "graph_component_size":
        n = graph.weak_component(edges, start.select("node")).groupBy(F.col("start").alias("one")).agg(F.count("*").alias("n"))
        return ask.join(n, "one").select("task", "sample_id", (F.col("n").cast("string") == F.col("gold")).alias("ok"))
    # the first node named is the target in "Is node x reachable from node y"
    ends = ask.select("sample_id", "gold", "task", *([F.col("two").alias("src"), F.col("one").alias("dst")] if task == "graph_reachable" else [F.col("one").alias("src"), F.col("two").alias("dst")]))
    far = graph.bfs(edges, ends.select(F.col("src").alias("node"))).select(F.col("start").alias("src"), F.col("node").alias("dst"), "depth")
    joined = ends.join(far, ["src", "dst"], "left")
    again = F.concat(F.lit('"'), F.when(F.col("depth").isNotNull(), "Yes").otherwise("No"), F.lit('"')) if task == "graph_reachable" else F.col("depth").cast("string")
    return joined.select("task", "sample_id", F.coalesce(again == F.col("gold"), F.lit(False)).alias("ok"))


def check(samples: DataFrame, task: str) -> DataFrame:
    """(task, sample_id, ok) of the samples of one synthetic task."""
    if task.startswith("graph_"):
        return check_graphs(samples, task)
    if task in ("common_words", "freq_words", "top_k"):
        return check_words(samples, task)
    if task in ("count_occurrences", "count_distinct"):
        return check_counts(samples, task)
    if task in ("variable_tracking", "variable_arithmetic"):
        return check_variables(samples, task)
    if task == "numeric_agg":
        return check_numbers(samples)
    if task == "set_ops":
        return check_sets(samples)
    return check_records(samples, task)


def summary(checked: DataFrame) -> DataFrame:
    return checked.groupBy("task").agg(F.count_if("ok").alias("n_ok"), F.count("*").alias("n"))


# Retrieval and abstention ----------------------------------------------------

FENCED = r"(?s)Paragraph\s+(\d+):\n<<<\n(.*?)\n>>>\n(.*?)(?=\n\nParagraph\s+\d+:\n<<<|\z)"


def paragraph_verdicts(samples: DataFrame, vocabulary: Column | None = None) -> DataFrame:
    """Each fenced paragraph with its markers, and whether it is what the question asks for."""
    text = F.col("context")
    zipped = F.arrays_zip(_all(text, FENCED, 1).alias("k"), _all(text, FENCED, 2).alias("body"), _all(text, FENCED, 3).alias("marks"))
    asked = _all(_one(F.col("question"), r"marked as both (.*?)\. Begin"), r"\ban?\s+([a-z]+)")
    rows = samples.select("task", "sample_id", "gold", "answers", "question", asked.alias("asked"), F.explode(zipped).alias("p"))
    rows = rows.select("*", F.col("p.k").cast("int").alias("k"), F.col("p.body").alias("body"), positive_markers(F.col("p.marks")).alias("pos"), negative_markers(F.col("p.marks")).alias("neg"))
    if vocabulary is not None:
        rows = rows.withColumn("pos", F.array_intersect("pos", vocabulary)).withColumn("neg", F.array_intersect("neg", vocabulary))
    hit = (F.size(F.array_except("asked", "pos")) == 0) & ~F.arrays_overlap("asked", "neg")
    return rows.withColumn("hit", hit).drop("p")


def check_retrieval(samples: DataFrame) -> DataFrame:
    """Exactly one paragraph fits, it is the gold, and the answer repeats it after its prefix."""
    v = paragraph_verdicts(samples)
    one = v.groupBy("task", "sample_id", "gold", "answers", "question").agg(F.count_if("hit").alias("n"), F.max(F.when(F.col("hit"), F.col("body"))).alias("body"))
    prefix = _one(F.col("question"), r"exact string ([0-9a-f]{8})")
    answer = F.get("answers", F.lit(0))
    ok = (F.col("n") == 1) & (F.col("body") == F.col("gold")) & F.startswith(answer, prefix) & F.contains(answer, F.col("gold"))
    return one.select("task", "sample_id", ok.alias("ok"))


def bindings(samples: DataFrame) -> DataFrame:
    """(sample_id, position, attribute, marker, code) stated in the text."""
    pattern = r"The (\w+) code for the (\w+) is ([0-9A-Z][0-9A-Z-]*)\."
    text = F.col("context")
    zipped = F.arrays_zip(*(_all(text, pattern, i).alias(n) for i, n in ((1, "attribute"), (2, "marker"), (3, "code"))))
    return samples.select("sample_id", F.posexplode(zipped).alias("position", "b")).select("sample_id", "position", "b.*")


def check_abstention(samples: DataFrame, idk: str = "I don't know") -> DataFrame:
    """The letter found again from bindings and options; meta agrees on whether there is an answer."""
    last = bindings(samples).groupBy("sample_id", "attribute", "marker").agg(F.max_by("code", "position").alias("code"))
    q = F.col("question")
    pattern = r"(?m)^\(([A-Z])\)\s+(.*)$"
    ask = samples.select(
        "task", "sample_id", "gold", "meta", _one(q, r"What is the (\w+) code").alias("attribute"), _one(q, r"code for the (\w+)\?").alias("marker"),
        F.arrays_zip(_all(q, pattern, 1).alias("letter"), _all(q, pattern, 2).alias("text")).alias("options"),
    )
    joined = ask.join(last, ["sample_id", "attribute", "marker"], "left").withColumn("want", F.coalesce("code", F.lit(idk)))
    hits = F.filter("options", lambda o: o["text"] == F.col("want"))
    answerable = F.get_json_object("meta", "$.answerable") == F.col("code").isNotNull().cast("string")
    return joined.select("task", "sample_id", ((F.size(hits) == 1) & (F.get(hits, F.lit(0))["letter"] == F.col("gold")) & answerable).alias("ok"))


def check_reorder(samples: DataFrame) -> DataFrame:
    """Reading the labelled chunks in the gold's order gives the original units back."""
    chunks = _all(F.col("context"), r"(?s)\n\n\[\d+\] (.*?)(?=\n\n\[\d+\] |\z)")
    order = F.from_json("gold", "array<int>")
    again = F.transform(order, lambda k: F.element_at(chunks, k))
    return samples.select("task", "sample_id", (again == F.col("units")).alias("ok"))
