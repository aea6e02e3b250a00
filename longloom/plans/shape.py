"""From samples to output rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_count


def prompt_input(instruction: Column, context: Column, question: Column) -> Column:
    return F.concat_ws("\n\n", instruction, context, question)


def answer_text(answers: Column, answer_type: Column) -> Column:
    """Lists and maps joined by commas; otherwise the first answer."""
    return F.when(answer_type.isin("list", "map"), F.array_join(answers, ", ")).otherwise(F.get(answers, F.lit(0)))


def shaped(samples: DataFrame, fmt: str, fewshot: Column | str = "", cue: bool = True, count=token_count) -> DataFrame:
    """Adds input, length and the trainable field: text (pt) or messages (sft).

    With ``cue`` the length counts the prompt, a line end and the answer cue;
    otherwise the input alone; ``count`` is the tokenizer's.
    """
    if fmt not in ("pt", "sft"):
        raise ValueError(f"unknown format {fmt!r}")
    fewshot = F.lit(fewshot) if isinstance(fewshot, str) else fewshot
    text = F.concat(fewshot, prompt_input(F.col("instruction"), F.col("context"), F.col("question")))
    answer = F.trim(F.concat_ws(" ", "answer_prefix", answer_text(F.col("answers"), F.col("answer_type"))))
    measured = F.concat(text, F.lit("\n"), F.col("answer_prefix")) if cue else text
    out = samples.withColumn("input", text).withColumn("format", F.lit(fmt)).withColumn("length", count(measured).cast("int"))
    if fmt == "pt":
        return out.withColumn("text", F.concat("input", F.lit("\n"), answer))
    return out.withColumn("messages", messages((F.lit("user"), F.col("input")), (F.lit("assistant"), answer)))


def messages(*turns: tuple[Column, Column]) -> Column:
    return F.array(*(F.struct(r.alias("role"), c.alias("content")) for r, c in turns))


def fewshot_block(samples: DataFrame, k: int) -> str:
    """Worked examples for the head of a prompt: the first ``k`` samples, each followed by its answer."""
    text = F.concat(
        prompt_input(F.col("instruction"), F.col("context"), F.col("question")), F.lit("\n"),
        F.trim(F.concat_ws(" ", "answer_prefix", answer_text(F.col("answers"), F.col("answer_type")))),
    )
    rows = samples.orderBy("sample_id").limit(k).select(text.alias("t")).collect()
    return "".join(r[0] + "\n\n" for r in rows)


def with_variants(rows: DataFrame) -> DataFrame:
    """gold and meta, held as JSON text, as VARIANT."""
    return rows.withColumns({c: F.parse_json(c) for c in ("gold", "meta") if c in rows.columns})
