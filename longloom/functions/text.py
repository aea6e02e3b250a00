"""Column expressions on text: token counts, splitting, stripping, templates, parsing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A token: a run of word characters, or one character that is neither word nor white space, in Unicode's sense.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{1c}-\x{1f}\x{85}\p{Z}]"
#: White space as str.strip() knows it.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def token_count(text: Column) -> Column:
    """Number of tokens of the white-space tokenizer; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def library_token_count(text: Column, spec: str) -> Column:
    """Number of tokens of ``hf:<file>`` or ``tiktoken:<rank file>``.

    A tokenizer that cannot be loaded is an error, not a silent change of unit.
    """
    kind, _, path = spec.partition(":")
    if kind == "whitespace":
        return token_count(text)
    if kind not in ("hf", "tiktoken") or not path:
        raise ValueError(f"unknown tokenizer {spec!r}: whitespace, hf:<file> or tiktoken:<file>")
    counts = _loaded(kind, path)

    @F.pandas_udf(T.LongType())
    def counted(batches):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(counts(batches.fillna("").tolist()), dtype="int64")

    counted.func.__annotations__.update({"batches": "pd.Series", "return": "pd.Series"})
    return counted(text)


def _loaded(kind: str, path: str) -> Callable[[list[str]], list[int]]:
    """A counter of batches that loads its tokenizer once in each Python worker."""
    held: dict[str, Callable[[list[str]], list[int]]] = {}

    def counts(texts: list[str]) -> list[int]:
        if "of" not in held:
            if kind == "hf":
                from tokenizers import Tokenizer

                tokenizer = Tokenizer.from_file(path)
                held["of"] = lambda ts: [len(e.ids) for e in tokenizer.encode_batch(ts, add_special_tokens=False)]
            else:
                import base64

                import tiktoken

                with open(path, "rb") as f:
                    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
                pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
                encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                held["of"] = lambda ts: [len(x) for x in encoding.encode_ordinary_batch(ts, num_threads=1)]
        return held["of"](texts)

    return counts


def strip(text: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def pieces(text: Column, pattern: str) -> Column:
    """Split by a pattern, strip, drop empty pieces."""
    return F.filter(F.transform(F.split(text, pattern), strip), lambda x: x != "")


def paragraphs(text: Column) -> Column:
    return pieces(text, r"\n\s*\n+")


def lines(text: Column) -> Column:
    return pieces(text, r"\n")


def sentences(text: Column) -> Column:
    return pieces(text, r"(?<=[.!?])\s+")


def units(text: Column) -> Column:
    """Paragraphs; where there are fewer than two, lines; where those are too few, sentences."""
    by_line = F.when(F.size(lines(text)) >= 2, lines(text)).otherwise(sentences(text))
    return F.when(F.size(paragraphs(text)) >= 2, paragraphs(text)).otherwise(by_line)


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda x: x != "")


def article(word: Column) -> Column:
    """The word with "a" or "an" before it."""
    an = F.lower(F.substring(word, 1, 1)).isin("a", "e", "i", "o", "u")
    return F.concat(F.when(an, "an ").otherwise("a "), word)


def padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def json_list(items: Column) -> Column:
    """A list of plain strings as JSON text with a blank after each comma."""
    return F.when(F.size(items) == 0, "[]").otherwise(F.concat(F.lit('["'), F.array_join(items, '", "'), F.lit('"]')))


def option_letter(index: Column) -> Column:
    return F.chr((index + 65).cast("long"))


# Parsing -------------------------------------------------------------------


def negative_markers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\bnot\s+an?\s+([a-z]+)"), 1))


def positive_markers(text: Column) -> Column:
    """Markers named with an article, less those denied."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\ban?\s+([a-z]+)"), 1))
    return F.array_except(found, negative_markers(text))


def qa_pair(text: Column, refusal: str = "cannot generate") -> Column:
    """struct(question, answer) of a reply, or null if it refuses or does not parse."""
    reply = strip(F.coalesce(text, F.lit("")))
    pattern = r"(?is)Question:\s*(.*?)\s*Answer:\s*(.*)"
    q, a = strip(F.regexp_extract(reply, pattern, 1)), strip(F.regexp_extract(reply, pattern, 2))
    ok = ~F.startswith(F.lower(reply), F.lit(refusal)) & (q != "") & (a != "") & ~F.startswith(F.lower(a), F.lit(refusal))
    return F.when(ok, F.struct(q.alias("question"), a.alias("answer")))


def clean_summary(text: Column, strict: bool = False) -> Column:
    """Without a leading preamble and one pair of quotes around it.

    Strict asks for a colon or full stop after the preamble, so that prose that
    begins with the word "Summary" stays whole.
    """
    mark = "[:.]" if strict else "[:.]?"
    s = strip(F.coalesce(text, F.lit("")))
    s = strip(F.regexp_replace(s, rf"(?i)^\s*(?:here\s+is\s+(?:a\s+|the\s+)?summary{mark}|summary{mark})\s*", ""))
    first, last = F.substring(s, 1, 1), F.substring(s, -1, 1)
    quoted = (F.length(s) >= 2) & first.isin('"', "'") & (first == last)
    return F.when(quoted, strip(s.substr(F.lit(2), F.length(s) - 2))).otherwise(s)


def response_text(row: Column, text_field: str | None = None) -> Column:
    """The generated text in a response of unknown shape, given as VARIANT; "" if there is none."""
    if text_field:
        return F.coalesce(F.try_variant_get(row, f"$.{text_field}", "string"), F.lit(""))

    def string_at(path: str) -> Column:
        v = F.try_variant_get(row, path, "variant")
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(row, path, "string"))

    plain = [F.nullif(string_at(f"$.{k}"), F.lit("")) for k in ("response", "completion", "output", "generated_text", "content", "text")]
    nested = [string_at(p) for p in (
        "$.choices[0].message.content", "$.choices[0].text", "$.response.body.choices[0].message.content",
        "$.response.choices[0].message.content",
    )]
    turns = F.try_variant_get(row, "$.messages", "array<struct<content:string>>")
    return F.coalesce(*plain, *nested, F.get(turns, F.size(turns) - 1)["content"], F.lit(""))


def response_id(row: Column, id_field: str = "id") -> Column:
    """The caller's id field, else ``id``, else ``custom_id``: the first that is not empty."""
    return F.coalesce(*(F.nullif(F.try_variant_get(row, f"$.{k}", "string"), F.lit("")) for k in (id_field, "id", "custom_id")))
