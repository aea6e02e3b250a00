"""Queries over generated samples, requests and responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import hashed
from ..functions.text import clean_summary, negative_markers, positive_markers, qa_pair, words
from ..operators import segment
from ..sources.storage import stored
from . import corpus_tasks as tasks
from . import requests, shape, synth, verify, views
from .registry import query
from .views import pick_sql, table

POOL_WORDS = 600
POOL_PASSAGES = 20_000
N, SIZE = 8, 60


def _pool(spark, sf, name: str):
    """(sample_id, word): for each sample, words drawn by hash from the whole vocabulary, more than a sample uses."""
    words = stored(views.word_stream(spark, sf).select("word").distinct(), "vocabulary")
    drawn = [
        words.orderBy(hashed(42, name, F.lit(i), "pool", F.col("word")), "word").limit(POOL_WORDS).select(F.lit(i).cast("long").alias("sample_id"), "word")
        for i in range(N)
    ]
    return reduce(DataFrame.unionByName, drawn)


def _samples(spark, sf, name: str):
    return synth.samples(spark, name, N, SIZE, _pool(spark, sf, name))


def _synthetic(name: str):
    @query(f"synth_{name}")
    def build(spark, sf):
        return _samples(spark, sf, name)

    @query(f"verify_{name}", f"SELECT '{name}' AS task, CAST({N} AS BIGINT) AS n_ok, CAST({N} AS BIGINT) AS n")
    def check(spark, sf):
        return verify.summary(verify.check(_samples(spark, sf, name), name))


for _name in synth.TASKS:
    _synthetic(_name)


# Passages and samples over them -----------------------------------------------


def _passages(spark, sf):
    """Passages of all documents, cut as the surveyed operator cuts them; written once, as samples count and join them."""
    return stored(segment.passage_pool(table(spark, sf, "documents"), POOL_PASSAGES), "passages")


@query("retrieval_samples")
def retrieval_samples(spark, sf):
    return tasks.retrieval(tasks.sized(spark, 12, 20), _passages(spark, sf))


@query("verify_retrieval", "SELECT 'mrcr' AS task, CAST(12 AS BIGINT) AS n_ok, CAST(12 AS BIGINT) AS n")
def verify_retrieval(spark, sf):
    return verify.summary(verify.check_retrieval(retrieval_samples(spark, sf)))


@query("retrieval_verdicts")
def retrieval_verdicts(spark, sf):
    v = verify.paragraph_verdicts(retrieval_samples(spark, sf))
    return v.select("sample_id", "k", F.array_join("pos", ",").alias("pos"), F.array_join("neg", ",").alias("neg"), "hit")


@query("abstention_samples")
def abstention_samples(spark, sf):
    return tasks.abstention(tasks.sized(spark, 24, 20), _passages(spark, sf))


@query("verify_abstention", "SELECT 'idk' AS task, CAST(24 AS BIGINT) AS n_ok, CAST(24 AS BIGINT) AS n")
def verify_abstention(spark, sf):
    return verify.summary(verify.check_abstention(abstention_samples(spark, sf)))


def _sources(spark, sf):
    return table(spark, sf, "documents").where("n_chars >= 3000").select(F.col("doc_id").cast("string").alias("src"), "text")


@query("reorder_samples")
def reorder_samples(spark, sf):
    return tasks.reorder(_sources(spark, sf), "permutation", context_len=2500, target=100, seed=3)


@query("verify_reorder", None)
def verify_reorder(spark, sf):
    both = [tasks.reorder(_sources(spark, sf), flow, context_len=2500, target=100, seed=3) for flow in ("permutation", "reconstruct")]
    return verify.summary(verify.check_reorder(both[0].unionByName(both[1])))


@query("reorder_labels", "SELECT doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY md5('5:' || doc_id)) AS INT) AS label FROM documents")
def reorder_labels(spark, sf):
    from pyspark.sql import Window

    label = F.row_number().over(Window.partitionBy("source").orderBy(hashed(5, F.col("doc_id"))))
    return table(spark, sf, "documents").select("doc_id", label.alias("label"))


_M = "[" + ", ".join(f"'{m}'" for m in tasks.MARKERS) + "]"
_NM = len(tasks.MARKERS)


@query(
    "roles",
    f"""WITH s AS (SELECT sid, {pick_sql(_NM, "'42:mrcr:' || sid || ':a'")} AS a, {pick_sql(_NM - 1, "'42:mrcr:' || sid || ':b'")} AS b0 FROM range(50) t(sid)),
q AS (SELECT sid, {_M}[a + 1] AS a, {_M}[(a + 1 + b0) % {_NM} + 1] AS b FROM s),
r AS (SELECT sid, a, b, idx FROM q, range(20) u(idx))
SELECT CAST(sid AS BIGINT) AS sample_id, CAST(idx AS INT) AS idx,
  CASE WHEN idx = 0 THEN 'both' WHEN idx <= 4 THEN 'denied' WHEN idx <= 10 THEN 'one' ELSE 'noise' END AS role, a, b FROM r""",
)
def roles(spark, sf):
    """What each paragraph of 20 is to the query: 10 confounders by half-even rounding of 9.5, 4 of them denials."""
    rows = tasks.sized(spark, 50, 20).withColumn("idx", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    r = tasks.roles(rows)
    a, b = F.get("asked", F.lit(0)), F.get("asked", F.lit(1))
    has = F.array_contains("pos", a).cast("int") + F.array_contains("pos", b).cast("int")
    denies = F.array_contains("neg", a) | F.array_contains("neg", b)
    role = F.when(has == 2, "both").when((has == 1) & denies, "denied").when(has == 1, "one").otherwise("noise")
    return r.select("sample_id", "idx", role.alias("role"), a.alias("a"), b.alias("b"))


_BIND = f"""k AS (SELECT sid, i, upper(substr(md5('42:idk:' || sid || ':' || i || ':hex'), 1, 4)) || '-' || lpad(CAST({pick_sql(100, "'42:idk:' || sid || ':' || i || ':two'")} AS VARCHAR), 2, '0') AS code,
  ['access', 'security', 'license', 'registration', 'vault'][{pick_sql(5, "'42:idk:' || sid || ':' || i || ':attr'")} + 1] AS attr
  FROM range(50) t(sid), range(6) u(i))"""


@query("bindings", f"WITH {_BIND} SELECT CAST(sid AS BIGINT) AS sample_id, CAST(i AS INT) AS i, attr, code FROM k")
def bindings(spark, sf):
    rows = tasks.code_bindings(tasks.sized(spark, 50, 20))
    found = rows.select("sample_id", F.posexplode("bindings").alias("i", "b"))
    return found.select("sample_id", "i", F.col("b.attr").alias("attr"), F.col("b.code").alias("code"))


@query(
    "options",
    f"""WITH k AS (SELECT sid, {pick_sql(1000000, "'42:idk:' || sid || ':kind'")} AS roll FROM range(400) t(sid))
SELECT CAST(sid AS BIGINT) AS sample_id, CASE WHEN roll < 300000 THEN 'answerable' WHEN roll < 450000 THEN 'subtle' ELSE 'absent' END AS kind, CAST(4 AS INT) AS n_options,
  true AS sound FROM k""",
)
def options(spark, sf):
    """Question kinds, and whether the options hold the right one once and the bait where there should be one."""
    rows = tasks.asked_options(tasks.code_bindings(tasks.sized(spark, 400, 20)))
    right = F.element_at("options", F.ascii("gold") - 64)
    idk_once = F.size(F.filter("options", lambda o: o == tasks.IDK)) == 1
    sound = idk_once & (right == F.coalesce("correct_code", F.lit(tasks.IDK))) & (F.size(F.array_distinct("options")) == 4)
    return rows.select("sample_id", "kind", F.size("options").alias("n_options"), sound.alias("sound"))


# Parsing ------------------------------------------------------------------------

_MARKED = f"""t AS (SELECT doc_id, 'This is ' || CASE WHEN doc_id % 3 = 0 THEN 'an ' || 'apple' ELSE 'a ' || {_M}[doc_id % {_NM} + 1] END
  || '. It is not a ' || {_M}[(doc_id * 7) % {_NM} + 1] || '.' AS s FROM documents)"""


def _marked(spark, sf):
    docs, m = table(spark, sf, "documents").select("doc_id"), F.array(*map(F.lit, tasks.MARKERS))
    first = F.when(F.col("doc_id") % 3 == 0, "an apple").otherwise(F.concat(F.lit("a "), F.element_at(m, (F.col("doc_id") % _NM + 1).cast("int"))))
    second = F.element_at(m, (F.col("doc_id") * 7 % _NM + 1).cast("int"))
    return docs.select("doc_id", F.concat(F.lit("This is "), first, F.lit(". It is not a "), second, F.lit(".")).alias("s"))


@query(
    "marker_parse",
    f"""WITH {_MARKED}, n AS (SELECT doc_id, regexp_extract(s, '\\bnot\\s+an?\\s+([a-z]+)', 1) AS neg, regexp_extract(s, 'is an?\\s+([a-z]+)', 1) AS pos FROM t)
SELECT doc_id, CASE WHEN pos = neg THEN '' ELSE pos END AS pos, neg FROM n""",
)
def marker_parse(spark, sf):
    s = F.col("s")
    return _marked(spark, sf).select("doc_id", F.array_join(positive_markers(s), ",").alias("pos"), F.array_join(negative_markers(s), ",").alias("neg"))


_BOUND = f"t AS (SELECT doc_id, 'x. The vault code for the ' || {_M}[doc_id % {_NM} + 1] || ' is ' || upper(substr(md5('b:' || doc_id), 1, 4)) || '-07. y' AS s FROM documents)"


@query("binding_parse", f"WITH {_BOUND} SELECT doc_id, regexp_extract(s, 'The (\\w+) code for the (\\w+) is', 1) AS attribute, regexp_extract(s, 'The (\\w+) code for the (\\w+) is', 2) AS marker, regexp_extract(s, 'is ([0-9A-Z][0-9A-Z-]*)\\.', 1) AS code FROM t")
def binding_parse(spark, sf):
    m = F.array(*map(F.lit, tasks.MARKERS))
    text = F.concat(F.lit("x. The vault code for the "), F.element_at(m, (F.col("doc_id") % _NM + 1).cast("int")), F.lit(" is "), F.upper(F.substring(hashed("b", F.col("doc_id")), 1, 4)), F.lit("-07. y"))
    found = verify.bindings(table(spark, sf, "documents").select(F.col("doc_id").alias("sample_id"), text.alias("context")))
    return found.select(F.col("sample_id").alias("doc_id"), "attribute", "marker", "code")


_QA = """t AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'cannot generate' WHEN 1 THEN 'nothing to see' WHEN 2 THEN 'question: who ' || doc_id || '?' || chr(10) || 'ANSWER:  me ' || doc_id || ' '
  WHEN 3 THEN 'Question: Answer: x' ELSE 'Sure. Question: a ' || doc_id || chr(10) || 'b? Answer: c' || chr(10) || 'd' END AS s FROM documents)"""


@query(
    "qa_parse",
    f"""WITH {_QA}, p AS (SELECT doc_id, trim(regexp_extract(s, '(?is)Question:\\s*(.*?)\\s*Answer:\\s*(.*)', 1)) AS question, trim(regexp_extract(s, '(?is)Question:\\s*(.*?)\\s*Answer:\\s*(.*)', 2)) AS answer FROM t)
SELECT * FROM p WHERE question <> '' AND answer <> ''""",
)
def qa_parse(spark, sf):
    i = F.col("doc_id").cast("string")
    s = (
        F.when(F.col("doc_id") % 5 == 0, "cannot generate").when(F.col("doc_id") % 5 == 1, "nothing to see")
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit("question: who "), i, F.lit("?\nANSWER:  me "), i, F.lit(" ")))
        .when(F.col("doc_id") % 5 == 3, "Question: Answer: x").otherwise(F.concat(F.lit("Sure. Question: a "), i, F.lit("\nb? Answer: c\nd")))
    )
    return table(spark, sf, "documents").select("doc_id", qa_pair(s).alias("p")).where("p IS NOT NULL").select("doc_id", "p.question", "p.answer")


@query(
    "summary_clean",
    """WITH t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ' Here is the summary:  "x ' || doc_id || '" ' WHEN 1 THEN 'Summary. it is ' || doc_id WHEN 2 THEN '''' || doc_id || '''' ELSE 'plain ' || doc_id END AS s FROM documents),
u AS (SELECT doc_id, trim(regexp_replace(trim(s), '(?i)^\\s*(?:here\\s+is\\s+(?:a\\s+|the\\s+)?summary[:.]?|summary[:.]?)\\s*', '')) AS s FROM t)
SELECT doc_id, CASE WHEN length(s) >= 2 AND s[1] IN ('"', '''') AND s[1] = s[-1] THEN trim(substr(s, 2, length(s) - 2)) ELSE s END AS summary FROM u""",
)
def summary_clean(spark, sf):
    i = F.col("doc_id").cast("string")
    s = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(' Here is the summary:  "x '), i, F.lit('" ')))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("Summary. it is "), i)).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("'"), i, F.lit("'")))
        .otherwise(F.concat(F.lit("plain "), i))
    )
    return table(spark, sf, "documents").select("doc_id", clean_summary(s).alias("summary"))


# Requests and responses ---------------------------------------------------------


def _long_docs(spark, sf):
    # at least 512 words: four chunks of 128
    docs = views.corpus(spark, sf).where("token_count BETWEEN 1200 AND 6000").where(F.size(words(F.col("text"))) >= 512)
    return docs.select(F.lpad("doc_id", 12, "0").alias("doc_id"), "source", "text", F.col("token_count").alias("n_tokens"))


def _prepared(spark, sf):
    return requests.multihop_prepare(_long_docs(spark, sf), chunk=128, min_chunk=32, per_doc=5)


@query(
    "requests",
    f"""WITH {views.CORPUS}, d AS (SELECT doc_id, row_number() OVER (ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) - 1 AS k FROM v_corpus WHERE token_count BETWEEN 1200 AND 6000 AND len(regexp_extract_all(text, '\\S+')) >= 512)
SELECT 'mh-' || lpad(CAST(k AS VARCHAR), 6, '0') || '-q' || lpad(CAST(q AS VARCHAR), 2, '0') AS id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS doc_id,
  CAST({pick_sql(2, "'0:mh-' || lpad(CAST(k AS VARCHAR), 6, '0') || ':' || q || ':n'")} + 3 AS INT) AS n_chunks FROM d, range(5) t(q)""",
)
def request_rows(spark, sf):
    return _prepared(spark, sf)[0].select("id", "doc_id", F.size("chunk_ids").alias("n_chunks"))


def _assembled(spark, sf, fmt):
    asked, docs = _prepared(spark, sf)
    found, unmatched = requests.matched(requests.simulated_responses(asked), asked)
    return found, unmatched, requests.multihop_assemble(found, docs, fmt)


_KIND = f"""q AS (SELECT 'mh-' || lpad(CAST(k AS VARCHAR), 6, '0') AS doc, 'mh-' || lpad(CAST(k AS VARCHAR), 6, '0') || '-q' || lpad(CAST(q AS VARCHAR), 2, '0') AS id FROM d, range(5) t(q)),
r AS (SELECT doc, id, {pick_sql(7, "'0:' || id || ':kind'")} AS kind FROM q)"""
_LONG = f"{views.CORPUS}, d AS (SELECT doc_id, row_number() OVER (ORDER BY lpad(CAST(doc_id AS VARCHAR), 12, '0')) - 1 AS k FROM v_corpus WHERE token_count BETWEEN 1200 AND 6000 AND len(regexp_extract_all(text, '\\S+')) >= 512)"


@query(
    "assemble_pairs",
    f"WITH {_LONG}, {_KIND} SELECT doc AS id, CAST(sum(CASE WHEN kind IN (0, 3, 4) THEN 1 WHEN kind = 6 THEN 2 ELSE 0 END) AS INT) AS n_pairs FROM r GROUP BY doc HAVING n_pairs >= 1",
)
def assemble_pairs(spark, sf):
    return _assembled(spark, sf, "sft")[2].select("id", "n_pairs")


@query("unmatched_responses", f"WITH {_LONG}, {_KIND} SELECT 'x-' || id AS id FROM r WHERE kind = 5")
def unmatched_responses(spark, sf):
    return _assembled(spark, sf, "sft")[1].select("id")


@query("multihop_samples")
def multihop_samples(spark, sf):
    return _assembled(spark, sf, "pt")[2].select("id", "task", "format", "doc_id", "source", "n_pairs", "text")


@query("assemble_summary")
def assemble_summary(spark, sf):
    return requests.run_summary(*_assembled(spark, sf, "sft"))


@query(
    "assemble_last",
    """WITH t AS (SELECT c.conv_id AS doc, c.text, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations c WHERE role = 'assistant' AND trim(text) <> '')
SELECT doc, md5(text) AS h FROM t WHERE n = 1""",
)
def assemble_last(spark, sf):
    """The last turn of each conversation counts, as the last response to a request does."""
    turns = table(spark, sf, "conversations").where("role = 'assistant' AND trim(text) <> ''")
    last = turns.groupBy(F.col("conv_id").alias("doc")).agg(F.max_by("text", "turn").alias("t"))
    return last.select("doc", F.md5("t").alias("h"))


@query("summarize_samples")
def summarize_samples(spark, sf):
    asked, docs = requests.summarize_prepare(_long_docs(spark, sf), words=100)
    found, _ = requests.matched(requests.simulated_responses(asked), asked)
    return requests.summarize_assemble(found, docs, "pt").select("id", "task", "doc_id", "doc_tokens", "instruction", "summary", "text")


# Output rows --------------------------------------------------------------------


@query(
    "sample_pt",
    "SELECT doc_id, 'Read.' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'How long is it?' || chr(10) || 'It has ' || n_chars || ', characters' AS text FROM documents",
)
def sample_pt(spark, sf):
    return shape.shaped(_shaped_input(spark, sf), "pt").select("doc_id", "text")


@query(
    "sample_sft",
    "SELECT doc_id, 'user' AS role, 'Read.' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'How long is it?' AS content FROM documents UNION ALL SELECT doc_id, 'assistant', 'It has ' || n_chars || ', characters' FROM documents",
)
def sample_sft(spark, sf):
    rows = shape.shaped(_shaped_input(spark, sf), "sft").select("doc_id", F.explode("messages").alias("m"))
    return rows.select("doc_id", "m.role", "m.content")


def _shaped_input(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("context"), F.col("n_chars").cast("string").alias("n"))
    return docs.select(
        "doc_id", F.lit("Read.").alias("instruction"), "context", F.lit("How long is it?").alias("question"), F.lit("It has").alias("answer_prefix"),
        F.array("n", F.lit("characters")).alias("answers"), F.lit("list").alias("answer_type"),
    )
