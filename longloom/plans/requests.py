"""Requests for an outside text generator, and samples from its responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import hashed, pick, shuffled
from ..functions.text import clean_summary, padded, qa_pair, response_id, response_text
from ..operators.segment import word_chunks
from ..sources.storage import stored
from .shape import messages

# What the generator is told, and how it declines.
REFUSAL = "cannot generate"
MULTIHOP_SYSTEM = (
    "You are a meticulous dataset author. You will be shown several text chunks taken from the same source document. Your job "
    "is to write ONE multi-hop question-answer pair.\n\nRequirements:\n- The question must require combining information from "
    "ALL of the chunks shown. Each chunk must contribute at least one fact that is necessary to answer the question.\n- The "
    "question must NOT be answerable from any single chunk on its own.\n- The question and answer must be fully grounded in the "
    "chunks. Do not rely on outside knowledge and do not invent facts.\n- Keep the answer concise and correct.\n\nIf the chunks "
    "do not share enough common ground to support such a question — for example they are about unrelated topics, or the text is "
    "too low quality — do NOT force one. In that case reply with exactly this phrase and nothing "
    f"else:\n{REFUSAL}\n\nOtherwise reply in EXACTLY this format and nothing else:\nQuestion: <your question>\nAnswer: <your answer>"
)
SUMMARY_SYSTEM = (
    "You are an expert summarizer. The user will give you a document followed by an instruction. Write a single, faithful summary "
    "of the entire document.\n\nRequirements:\n- Cover the document's main points, key facts, and overall arc; do not fixate on just "
    "the opening sections.\n- Stay strictly faithful to the source: do not add information, opinions, or facts that are not in the "
    "document.\n- Write clear, well-organized prose. Output only the summary itself, with no preamble such as \"Here is the summary\" "
    "and no surrounding quotes or headings."
)


def summary_instruction(words: int | None = None) -> str:
    text = "Write a comprehensive, faithful summary of the document above"
    return f"{text} in approximately {words} words." if words else f"{text}."


def local_ids(docs: DataFrame, prefix: str, order: str = "doc_id") -> DataFrame:
    """Dense ids in corpus order. Only the ids go through the one-partition numbering, then join back."""
    number = F.row_number().over(Window.orderBy(order)) - 1
    ids = docs.select(order).withColumn("doc", padded(prefix, number, 6))
    return docs.join(ids, order)


def multihop_prepare(
    docs: DataFrame, chunk: int = 512, min_chunk: int = 128, min_chunks: int = 4, per_doc: int = 13, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(requests, docs): three or four chunks of a document to a request, ``per_doc`` requests each.

    ``docs`` is (doc_id, source, text, n_tokens), already within the length limits.
    """
    cut = docs.withColumn("chunks", F.transform(word_chunks(F.col("text"), chunk, min_chunk), lambda c: c["text"]))
    kept = local_ids(cut.where(F.size("chunks") >= min_chunks), "mh-")
    asked = kept.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(per_doc - 1))))
    n = pick(2, seed, F.col("doc"), F.col("q"), "n") + 3
    order = shuffled(F.sequence(F.lit(0), F.size("chunks") - 1), seed, F.col("doc"), F.col("q"), "chunks")
    asked = asked.withColumn("chunk_ids", F.array_sort(F.slice(order, F.lit(1), n.cast("int"))))
    parts = F.transform("chunk_ids", lambda c, i: F.concat(F.lit("Chunk "), (i + 1).cast("string"), F.lit(":\n"), F.get("chunks", c)))
    user = F.array_join(F.concat(F.array(F.lit("Here are the chunks from the document:\n")), parts), "\n\n")
    requests = asked.select(
        F.concat("doc", F.lit("-q"), F.lpad(F.col("q").cast("string"), 2, "0")).alias("id"), "doc", "doc_id", "chunk_ids",
        messages((F.lit("system"), F.lit(MULTIHOP_SYSTEM)), (F.lit("user"), user)).alias("messages"),
    )
    table = kept.select("doc", "doc_id", "source", F.size("chunks").alias("n_chunks"), F.col("n_tokens").alias("doc_tokens"), "text")
    return requests, table


def summarize_prepare(docs: DataFrame, words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(requests, docs): one request for each document."""
    instruction = summary_instruction(words)
    kept = local_ids(docs, "sum-")
    user = F.concat("text", F.lit("\n\n" + instruction))
    requests = kept.select(F.col("doc").alias("id"), "doc", "doc_id", messages((F.lit("system"), F.lit(SUMMARY_SYSTEM)), (F.lit("user"), user)).alias("messages"))
    return requests, kept.select("doc", "doc_id", "source", F.col("n_tokens").alias("doc_tokens"), F.lit(instruction).alias("instruction"), "text")


def matched(responses: DataFrame, requests: DataFrame, id_field: str = "id", text_field: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(responses with their request's document, responses without): rows (file, line, id, doc, reply)."""
    read = responses.select("file", "line", response_id(F.col("row"), id_field).alias("id"), response_text(F.col("row"), text_field).alias("reply"))
    # both sides below read the parsed replies, so they are parsed once
    read = stored(read, "replies")
    ids = requests.select("id", "doc").distinct()
    return read.join(ids, "id"), read.join(ids, "id", "left_anti")


def request_order(id_: Column, else_: Column) -> Column:
    return F.coalesce(F.when(F.contains(id_, F.lit("-q")), F.substring_index(id_, "-q", -1).try_cast("int")), else_)


def multihop_assemble(found: DataFrame, docs: DataFrame, fmt: str = "sft", min_pairs: int = 1, max_pairs: int = 10) -> DataFrame:
    """One row for each document with enough pairs, in the order of documents, pairs in request order; repeated answers to a request stay."""
    pairs = found.withColumn("pair", qa_pair(F.col("reply"), REFUSAL)).where("pair IS NOT NULL")
    order = F.struct(request_order(F.col("id"), F.lit(0)).alias("o"), "file", "line", "pair")
    grouped = pairs.groupBy("doc").agg(F.array_sort(F.collect_list(order)).alias("all"))
    rows = grouped.select("doc", F.slice(F.transform("all", lambda x: x["pair"]), 1, max_pairs).alias("qa_pairs")).where(F.size("qa_pairs") >= min_pairs)
    rows = rows.join(docs.select("doc", "doc_id", "source", F.coalesce("text", F.lit("")).alias("_text")), "doc", "left")
    text = F.coalesce("_text", F.lit(""))
    out = rows.select(
        F.col("doc").alias("id"), F.lit("multihop").alias("task"), F.lit(fmt).alias("format"), "doc_id", "source", F.size("qa_pairs").alias("n_pairs"), "qa_pairs", text.alias("_text")
    )
    if fmt == "pt":
        body = F.array_join(F.transform("qa_pairs", lambda p: F.concat(F.lit("Question: "), p["question"], F.lit("\nAnswer: "), p["answer"])), "\n")
        out = out.withColumn("text", F.concat("_text", F.lit("\n\n"), body))
    else:
        listed = lambda part: F.array_join(F.transform("qa_pairs", lambda p, i: F.concat((i + 1).cast("string"), F.lit(". "), p[part])), "\n")
        out = out.withColumn("messages", messages((F.lit("user"), F.concat("_text", F.lit("\n\n"), listed("question"))), (F.lit("assistant"), listed("answer"))))
    return out.drop("_text").orderBy("id")


def summarize_assemble(found: DataFrame, docs: DataFrame, fmt: str = "sft", strict: bool = False) -> DataFrame:
    """One row for each document with a summary that is not empty, in the order of documents; the last response wins."""
    cleaned = found.withColumn("summary", clean_summary(F.col("reply"), strict)).where("summary <> ''")
    last = cleaned.groupBy("doc").agg(F.max_by("summary", F.struct("file", "line")).alias("summary"))
    rows = last.join(docs.select("doc", "doc_id", "source", "doc_tokens", "instruction", F.col("text").alias("_text")), "doc", "left")
    text, ask = F.coalesce("_text", F.lit("")), F.coalesce("instruction", F.lit(summary_instruction()))
    out = rows.select(F.col("doc").alias("id"), F.lit("summarize").alias("task"), F.lit(fmt).alias("format"), "doc_id", "source", "doc_tokens", ask.alias("instruction"), "summary", text.alias("_text"))
    if fmt == "pt":
        out = out.withColumn("text", F.concat("_text", F.lit("\n\n"), "instruction", F.lit("\n"), "summary"))
    else:
        out = out.withColumn("messages", messages((F.lit("user"), F.concat("_text", F.lit("\n\n"), "instruction")), (F.lit("assistant"), F.col("summary"))))
    return out.drop("_text").orderBy("id")


def run_summary(found: DataFrame, unmatched: DataFrame, assembled: DataFrame) -> DataFrame:
    """One row of counts for a run of ``multihop_assemble``."""
    replies = found.agg(
        F.count("*").alias("matched"), F.count_if(qa_pair(F.col("reply"), REFUSAL).isNotNull()).alias("pairs_parsed"), F.count_if(qa_pair(F.col("reply"), REFUSAL).isNull()).alias("cannot_generate_or_unparsed")
    )
    docs = assembled.agg(F.count("*").alias("docs_written"), F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("pairs_written"))
    rows = replies.join(docs).join(unmatched.agg(F.count("*").alias("unmatched_ids")))
    return rows.withColumn("avg_pairs_per_doc", F.when(F.col("docs_written") > 0, F.round(F.col("pairs_written") / F.col("docs_written"), 2)).otherwise(0.0))


def simulated_responses(requests: DataFrame, seed: int = 0) -> DataFrame:
    """(file, line, row VARIANT): responses of several shapes, some refused, broken, unknown or repeated. For tests."""
    kind = pick(7, seed, F.col("id"), "kind")
    good = F.concat(F.lit("Question: what of "), "id", F.lit("?\nAnswer: that is "), hashed(seed, F.col("id")))
    text = F.when(kind == 1, REFUSAL).when(kind == 2, "no pair here").otherwise(good)
    plain = F.to_json(F.struct("id", text.alias("response")))
    chat = F.to_json(F.struct(F.col("id").alias("custom_id"), F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")))
    batch = F.to_json(F.struct("id", F.struct(F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")).alias("body")).alias("response")))
    unknown = F.to_json(F.struct(F.concat(F.lit("x-"), "id").alias("id"), text.alias("text")))
    row = F.when(kind == 3, chat).when(kind == 4, batch).when(kind == 5, unknown).otherwise(plain)
    rows = requests.select("id", row.alias("json"), F.explode(F.when(kind == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.select(F.lit("responses").alias("file"), F.concat_ws(":", "id", "copy").alias("line"), F.parse_json("json").alias("row"))
