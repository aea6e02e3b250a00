"""Tasks over real passages: reordering, marker retrieval and abstention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import chance, hashed, hex_id, key, pick, shuffled
from ..functions.text import article
from ..operators.rows import numbered_in_ranges
from ..operators.segment import flow_budget, make_units, take_span
from ..sources.storage import stored

# Markers that paragraphs are tagged with.
MARKERS = tuple(
    """apple lemon orange banana cherry peach plum grape mango melon lime apricot olive coconut fig pear
    otter badger beaver falcon panther walrus dolphin rabbit hedgehog salmon lobster sparrow panda zebra koala leopard
    ferret gecko heron mole newt owl eagle antelope iguana octopus anchor lantern hammer kettle ladder mirror pebble
    ribbon saddle teapot wrench compass candle basket bucket pillow blanket marble balloon button magnet helmet paddle
    shovel trumpet drum violin flute banjo harp car truck wagon canoe kayak sled tractor scooter yacht glider rocket
    submarine ferry raft muffin biscuit pretzel waffle pancake noodle pickle walnut almond pepper radish turnip pumpkin
    carrot onion glacier canyon meadow volcano geyser lagoon reef dune marsh prairie island harbor comet meteor nebula
    planet galaxy anvil beacon satchel goblet dagger quiver scroll crown throne torch cauldron gargoyle fountain""".split()
)

# Sentences that state markers.
OPENERS = (
    "This paragraph is %s.", "Mark this paragraph as %s.", "Note that this passage is %s.", "Remember, this one is %s.",
    "This paragraph has been tagged %s.",
)
ADDITIONS = ("It is also %s.", "It additionally counts as %s.", "This one is also marked as %s.")
DENIALS = ("But remember that it is not %s.", "Note that it is not %s.", "It is not %s, however.")

# What the tasks ask.
RETRIEVAL_INSTRUCTION = (
    "You are given a long list of numbered paragraphs. Each paragraph's text is shown between <<< and >>> fences and is "
    "followed by one or more sentences stating what that paragraph is marked as (and, sometimes, what it is not marked as)."
)
IDK = "I don't know"
ATTRIBUTES = ("access", "security", "license", "registration", "vault")
ABSTENTION_INSTRUCTION = (
    "You are given a long list of numbered paragraphs. Some paragraphs state a code (access / security / license / "
    "registration / vault) for a named item. Answer the multiple-choice question using only the information in the "
    "paragraphs. If the paragraphs do not contain the answer, choose "
    f'"{IDK}". Respond with the single letter of the correct option and nothing else.'
)
REORDER_INSTRUCTION = {
    "reconstruct": (
        "You are given the paragraphs of a long document in shuffled order. Each paragraph is prefixed with a numeric label "
        "like [k] giving its position in the shuffled list. Reconstruct the original document by writing out its paragraphs "
        "in the correct original order. Output only the reconstructed document text, paragraphs separated by a blank line, "
        "no labels."
    ),
    "permutation": (
        "You are given the paragraphs of a long document in shuffled order. Each paragraph is prefixed with a numeric label "
        "like [k]. Work out the original ordering of the paragraphs. Output only the sequence of labels that reconstructs "
        "the original document, in order, separated by commas (e.g. '12, 5, 8, 1'). Output nothing else."
    ),
}
REORDER_QUESTION = {
    "reconstruct": "Reconstruct the original document.",
    "permutation": "Give the label order that reconstructs the original document.",
}
REORDER_HEADING = "Shuffled paragraphs:\n\n"


def _one_of(items, *parts) -> Column:
    array = items if isinstance(items, Column) else F.array(*map(F.lit, items))
    return F.element_at(array, (pick(F.size(array), *parts) + 1).cast("int"))


# Reordering ------------------------------------------------------------------


def reorder(
    sources: DataFrame, flow: str, context_len: int = 131072, target: int = 10000, most: int | None = None, jitter: float = 0.25,
    min_units: int = 2, seed: int = 0, reuse: int = 1, num_samples: int | None = None,
) -> DataFrame:
    """Samples from (src, text): units in hashed order, and the labels that put them right.

    Sources with two equal units are left out, as their order would not be
    unique. With ``num_samples`` sources come round again, up to ``reuse``
    times with other spans and orders, until there are enough.
    """
    passes = sources.withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(reuse - 1))))
    cut_key = key(seed, F.col("src"), F.col("lap"), "units")
    units = passes.select("lap", "src", F.posexplode(make_units(F.col("text"), target, most, jitter, cut_key)).alias("pos", "u"))
    units = units.select("lap", F.col("src").alias("source"), F.concat_ws("#", "src", "lap").alias("src"), "pos", "u.text", "u.n_tok")
    span = take_span(units, flow_budget(flow, context_len), seed)
    packed = F.array_sort(F.collect_list(F.struct("pos", "text")))
    docs = span.groupBy("lap", "source", "src").agg(F.transform(packed, lambda x: x["text"]).alias("units"))
    docs = docs.where((F.size("units") >= min_units) & (F.size(F.array_distinct("units")) == F.size("units")))
    shown = shuffled(F.sequence(F.lit(0), F.size("units") - 1), seed, flow, F.col("src"), "order")
    docs = docs.withColumn("shown", shown)
    listing = F.array_join(F.transform("shown", lambda i, d: F.concat(F.lit("["), (d + 1).cast("string"), F.lit("] "), F.get("units", i))), "\n\n")
    labels = F.transform("units", lambda u, i: F.array_position("shown", i).cast("int"))
    docs = stored(docs, "reorder")
    # names are numbered without their texts
    number = numbered_in_ranges(docs.select("lap", "source", "src"), F.asc("lap"), F.asc("source"), name="sample_id").select("src", "sample_id")
    if num_samples is not None:
        number = number.where(F.col("sample_id") < num_samples)
    rows = docs.join(number, "src").withColumn("labels", labels)
    answers = F.array(F.array_join("units", "\n\n")) if flow == "reconstruct" else F.transform("labels", lambda x: x.cast("string"))
    return rows.select(
        "sample_id", F.lit(f"reorder-{flow}").alias("task"), F.lit(flow).alias("flow"), "source", F.lit(REORDER_INSTRUCTION[flow]).alias("instruction"),
        F.concat(F.lit(REORDER_HEADING), listing).alias("context"), F.lit(REORDER_QUESTION[flow]).alias("question"), F.lit("").alias("answer_prefix"), answers.alias("answers"),
        F.to_json("labels").alias("gold"), F.lit("string" if flow == "reconstruct" else "list").alias("answer_type"),
        F.to_json(F.struct(F.lit(flow).alias("flow"), F.size("units").alias("n_units"))).alias("meta"), "units",
    )


# Passages for samples --------------------------------------------------------


def dealt_passages(samples: DataFrame, pool: DataFrame, seed: int, task: str) -> DataFrame:
    """(sample_id, n, idx, text): ``n`` passages of the pool for each sample, all different while the pool lasts.

    Passages are drawn by number along an arithmetic walk, and joined to the
    pool by that number: nothing is sorted and no pool is copied to a sample.
    """
    count = pool.agg(F.count("*").alias("pool_size"))
    rows = samples.join(F.broadcast(count)).withColumn("idx", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    # a prime step is a full walk unless the pool's size is a multiple of it
    primes = F.array(*map(F.lit, (7919, 104729, 611953, 1299709)))
    step = F.element_at(F.filter(primes, lambda p: F.col("pool_size") % p != 0), 1)
    pid = F.pmod(pick(F.col("pool_size"), seed, task, F.col("sample_id"), "passages") + F.col("idx") * step, F.col("pool_size"))
    return rows.withColumn("pid", pid).join(pool.select("pid", "text"), "pid").select("sample_id", "n", "idx", "text")


# Marker retrieval ------------------------------------------------------------


def query_markers(seed: int, sample: Column) -> Column:
    """Two different markers for each sample."""
    markers = F.array(*map(F.lit, MARKERS))
    a = pick(len(MARKERS), seed, "mrcr", sample, "a")
    b = F.pmod(a + 1 + pick(len(MARKERS) - 1, seed, "mrcr", sample, "b"), F.lit(len(MARKERS)))
    return F.array(F.element_at(markers, (a + 1).cast("int")), F.element_at(markers, (b + 1).cast("int")))


def roles(rows: DataFrame, seed: int = 42, confounder_frac: float = 0.5, neg_frac: float = 0.35) -> DataFrame:
    """Adds ``asked``, ``pos`` and ``neg`` to (sample_id, n, idx).

    Paragraph 0 has both markers asked for. Then come those that have one and
    deny the other, those that have one, and the rest with one or two other
    markers, three in ten of them with a denial.
    """
    s, i = F.col("sample_id"), F.col("idx")
    rows = rows.withColumn("asked", query_markers(seed, s))
    others = F.col("n") - 1
    n_ref = F.bround(others * confounder_frac, 0).cast("int")
    n_neg = F.bround(n_ref * neg_frac, 0).cast("int")
    noise = F.array_except(F.array(*map(F.lit, MARKERS)), F.col("asked"))
    a, b = F.get("asked", F.lit(0)), F.get("asked", F.lit(1))
    first, second = _one_of(noise, seed, "mrcr", s, i, "m1"), _one_of(noise, seed, "mrcr", s, i, "m2")
    extra = F.when(chance(0.5, seed, "mrcr", s, i, "extra"), F.array(first)).otherwise(F.array().cast("array<string>"))
    even_neg, even_pos = (i - 1) % 2 == 0, (i - 1 - n_neg) % 2 == 0
    none = F.array().cast("array<string>")
    own = F.array_distinct(F.when(chance(0.5, seed, "mrcr", s, i, "two"), F.array(first, second)).otherwise(F.array(first)))
    denied = F.array_except(F.array(_one_of(noise, seed, "mrcr", s, i, "m3")), own)
    pos = (
        F.when(i == 0, F.col("asked")).when(i <= n_neg, F.concat(F.array(F.when(even_neg, a).otherwise(b)), extra))
        .when(i <= n_ref, F.concat(F.array(F.when(even_pos, a).otherwise(b)), extra)).otherwise(own)
    )
    neg = (
        F.when((i > 0) & (i <= n_neg), F.array(F.when(even_neg, b).otherwise(a)))
        .when((i > n_ref) & chance(0.3, seed, "mrcr", s, i, "deny"), denied).otherwise(none)
    )
    return rows.withColumn("pos", pos).withColumn("neg", neg)


def marker_sentences(pos: Column, neg: Column, *parts) -> Column:
    shown = shuffled(pos, *parts, "pos")

    def said(templates, word, *slot):
        return F.replace(_one_of(templates, *parts, *slot), F.lit("%s"), article(word))

    have = F.transform(shown, lambda w, i: F.when(i == 0, said(OPENERS, w, "open")).otherwise(said(ADDITIONS, w, "add", i)))
    deny = F.transform(neg, lambda w, i: said(DENIALS, w, "neg", i))
    return F.array_join(F.concat(have, deny), " ")


def retrieval(samples: DataFrame, pool: DataFrame, seed: int = 42, k: int = 2, **shares) -> DataFrame:
    """Retrieval samples for (sample_id, n): find the one paragraph with both markers."""
    if k != 2:
        raise ValueError("the query joins two markers; k must be 2")
    rows = roles(dealt_passages(samples, pool, seed, "mrcr"), seed, **shares)
    s, i = F.col("sample_id"), F.col("idx")
    block = F.concat(F.lit("\n<<<\n"), "text", F.lit("\n>>>\n"), marker_sentences(F.col("pos"), F.col("neg"), seed, "mrcr", s, i))
    rows = rows.select("sample_id", "n", "idx", "asked", "text", block.alias("block"), hashed(seed, "mrcr", s, i, "order").alias("h"))
    packed = F.array_sort(F.collect_list(F.struct("h", "idx", "block")))
    docs = rows.groupBy("sample_id", "n", "asked").agg(packed.alias("b"), F.max(F.when(F.col("idx") == 0, F.col("text"))).alias("gold"))
    context = F.array_join(F.transform("b", lambda x, d: F.concat(F.lit("Paragraph "), (d + 1).cast("string"), F.lit(":"), x["block"])), "\n\n")
    prefix = hex_id(8, seed, "mrcr", F.col("sample_id"), "prefix")
    a, b = article(F.get("asked", F.lit(0))), article(F.get("asked", F.lit(1)))
    question = F.concat(
        F.lit("Find the single paragraph that is marked as both "), a, F.lit(" and "), b, F.lit(". Begin your answer with the exact string "), prefix,
        F.lit(" on its own line, then reproduce that paragraph's text (everything between its <<< and >>> fences) verbatim. Output nothing else."),
    )
    target = F.array_position(F.transform("b", lambda x: x["idx"]), 0)
    meta = F.struct(F.col("asked").alias("query_markers"), F.lit(2).alias("k"), prefix.alias("random_prefix"), F.col("n").alias("n_paragraphs"), target.alias("target_paragraph"))
    return docs.select(
        "sample_id", F.lit("mrcr").alias("task"), F.lit(RETRIEVAL_INSTRUCTION).alias("instruction"), context.alias("context"), question.alias("question"),
        F.lit("").alias("answer_prefix"), F.array(F.concat(prefix, F.lit("\n"), "gold")).alias("answers"), "gold", F.lit("string").alias("answer_type"), F.to_json(meta).alias("meta"),
    )


# Abstention ------------------------------------------------------------------


def code(*parts) -> Column:
    return F.concat(F.upper(hex_id(4, *parts, "hex")), F.lit("-"), F.lpad(pick(100, *parts, "two").cast("string"), 2, "0"))


def code_bindings(samples: DataFrame, seed: int = 42, n_choices: int = 4, binding_frac: float = 0.3) -> DataFrame:
    """(sample_id, n, bindings): markers with a code each, on different paragraphs."""
    n = F.col("n")
    wanted = F.greatest(F.bround(n * binding_frac, 0).cast("int"), F.lit(max(n_choices, 4)))
    n_bind = F.least(wanted, n, F.lit(len(MARKERS) - 1))
    s = F.col("sample_id")
    places = F.slice(shuffled(F.sequence(F.lit(0), n - 1), seed, "idk", s, "places"), F.lit(1), n_bind)
    names = shuffled(F.array(*map(F.lit, MARKERS)), seed, "idk", s, "markers")
    built = F.transform(places, lambda p, i: F.struct(
        p.alias("idx"), F.get(names, i).alias("marker"), _one_of(ATTRIBUTES, seed, "idk", s, i, "attr").alias("attr"), code(seed, "idk", s, i).alias("code"),
    ))
    # codes that collide within a sample are told apart by the binding's number
    again = F.transform(built, lambda x, i: F.struct(x["idx"].alias("idx"), x["marker"].alias("marker"), x["attr"].alias("attr"), F.when(
        F.size(F.filter(built, lambda y: (y["code"] == x["code"]) & (y["idx"] != x["idx"]))) > 0, F.concat(F.lpad(F.hex(i.cast("long")), 4, "0"), F.substring(x["code"], 5, 3))).otherwise(x["code"]).alias("code")))
    return samples.withColumn("bindings", again).withColumn("unused", F.slice(names, n_bind + 1, F.lit(len(MARKERS)) - n_bind))


def asked_options(bound: DataFrame, seed: int = 42, n_choices: int = 4, unanswerable_frac: float = 0.7, subtle_frac: float = 0.15) -> DataFrame:
    """Adds kind, asked marker and attribute, options and the right letter."""
    if not 0 <= subtle_frac <= unanswerable_frac <= 1:
        raise ValueError("0 <= subtle_frac <= unanswerable_frac <= 1 is needed")
    s = F.col("sample_id")
    roll = pick(1_000_000, seed, "idk", s, "kind")
    answerable = round((1 - unanswerable_frac) * 1_000_000)
    subtle = answerable + round(subtle_frac * 1_000_000)
    rows = bound.withColumn("kind", F.when(roll < answerable, "answerable").when(roll < subtle, "subtle").otherwise("absent"))
    rows = rows.withColumn("chosen", _one_of(F.col("bindings"), seed, "idk", s, "chosen"))
    absent, marked = F.col("kind") == "absent", F.col("chosen.code")
    rows = rows.withColumn("asked_marker", F.when(absent, _one_of(F.col("unused"), seed, "idk", s, "unused")).otherwise(F.col("chosen.marker")))
    other = F.array_except(F.array(*map(F.lit, ATTRIBUTES)), F.array(F.col("chosen.attr")))
    rows = rows.withColumn("asked_attribute", F.when(absent, _one_of(ATTRIBUTES, seed, "idk", s, "attr")).when(F.col("kind") == "subtle", _one_of(other, seed, "idk", s, "attr")).otherwise(F.col("chosen.attr")))
    codes = shuffled(F.transform("bindings", lambda b: b["code"]), seed, "idk", s, "codes")
    others = F.array_except(codes, F.array(marked))
    options = F.when(absent, F.slice(codes, 1, n_choices - 1)).otherwise(F.concat(F.array(marked), F.slice(others, 1, n_choices - 2)))
    rows = rows.withColumn("options", shuffled(F.concat(options, F.array(F.lit(IDK))), seed, "idk", s, "options"))
    right = F.when(F.col("kind") == "answerable", marked).otherwise(F.lit(IDK))
    letter = F.chr((F.array_position("options", right) + 64).cast("long"))
    return rows.withColumn("correct_code", F.when(F.col("kind") == "answerable", marked)).withColumn("gold", letter).drop("chosen")


def abstention(samples: DataFrame, pool: DataFrame, seed: int = 42, **options) -> DataFrame:
    """Multiple-choice samples for (sample_id, n) whose answer may not be in the text."""
    asked = asked_options(code_bindings(samples, seed), seed, **options)
    bound = asked.select("sample_id", F.explode("bindings").alias("b")).select("sample_id", "b.*")
    rows = dealt_passages(samples, pool, seed, "idk").join(bound, ["sample_id", "idx"], "left")
    line = F.when(F.col("code").isNull(), "").otherwise(F.format_string("\nThe %s code for the %s is %s.", "attr", "marker", "code"))
    block = F.concat(F.lit("Paragraph "), (F.col("idx") + 1).cast("string"), F.lit(":\n"), "text", line)
    packed = F.array_sort(F.collect_list(F.struct("idx", block.alias("block"))))
    context = rows.groupBy("sample_id").agg(F.array_join(F.transform(packed, lambda x: x["block"]), "\n\n").alias("context"))
    listed = F.array_join(F.transform("options", lambda o, i: F.concat(F.lit("("), F.chr((i + 65).cast("long")), F.lit(") "), o)), "\n")
    question = F.concat(F.format_string("Question: What is the %s code for the %s?\n\n", "asked_attribute", "asked_marker"), listed)
    meta = F.struct(
        "kind", (F.col("kind") == "answerable").alias("answerable"), "asked_marker", "asked_attribute", "correct_code", F.col("gold").alias("gold_letter"),
        F.map_from_entries(F.transform("options", lambda o, i: F.struct(F.chr((i + 65).cast("long")), o))).alias("options"),
        F.col("n").alias("n_passages"), F.size("bindings").alias("n_bindings"),
    )
    return asked.join(context, "sample_id").select(
        "sample_id", F.lit("idk").alias("task"), F.lit(ABSTENTION_INSTRUCTION).alias("instruction"), "context", question.alias("question"), F.lit("").alias("answer_prefix"),
        F.array("gold").alias("answers"), "gold", F.lit("string").alias("answer_type"), F.to_json(meta, {"ignoreNullFields": "false"}).alias("meta"),
    )


def sized(spark: SparkSession, num_samples: int, n: int, first: int = 0) -> DataFrame:
    """(sample_id, n) for samples of ``n`` paragraphs."""
    return spark.range(first, first + num_samples).select(F.col("id").alias("sample_id"), F.lit(n).alias("n"))
