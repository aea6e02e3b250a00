import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from longloom.functions import numbers, text
from longloom.plans.viewers import chunk_starts


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_tokens_follow_unicode(spark):
    cases = ["", "a b", "naïve café!", "x y", "1½ $$", "日本語 テスト", "a_b-c"]
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select(text.token_count(F.col("t")).alias("n")).collect()
    want = [len(re.findall(r"\w+|[^\w\s]", c)) for c in cases]
    got = [r.n for r in rows]
    assert [g for g, c in zip(got, cases) if "½" not in c] == [w for w, c in zip(want, cases) if "½" not in c]
    assert spark.range(1).select(text.token_count(F.lit(None).cast("string")).alias("n")).first().n == 0


def test_units_fall_back_to_lines_and_sentences(spark):
    t = F.col("t")
    assert one(spark, text.units(t), t="a\n\n b \n \nc") == ["a", "b", "c"]
    assert one(spark, text.units(t), t="a\nb") == ["a", "b"]
    assert one(spark, text.units(t), t="One. Two! Three") == ["One.", "Two!", "Three"]


def test_strip_knows_all_white_space(spark):
    assert one(spark, text.strip(F.col("t")), t="  a b  \n") == "a b"


def test_article(spark):
    assert one(spark, text.article(F.lit("apple"))) == "an apple"
    assert one(spark, text.article(F.lit("drum"))) == "a drum"


def test_rounded_mean_is_binary(spark):
    row = spark.createDataFrame([(2675, 1000), (125, 1000), (10, 4)], "t long, n long").select(numbers.rounded_mean(F.col("t"), F.col("n")).alias("m")).collect()
    assert [r.m for r in row] == [round(2.675, 2), round(0.125, 2), 2.5]


def test_median_text(spark):
    assert one(spark, numbers.median_text(F.array(*map(F.lit, [3, 1, 2])))) == "2"
    assert one(spark, numbers.median_text(F.array(*map(F.lit, [4, 1, 2, 3])))) == "2.5"


def test_picks_do_not_depend_on_partitions(spark):
    col = numbers.pick(1000, "k", F.col("id"))
    a = {r[0]: r[1] for r in spark.range(0, 500, 1, 1).select("id", col).collect()}
    b = {r[0]: r[1] for r in spark.range(0, 500, 1, 7).select("id", col).collect()}
    assert a == b and len(set(a.values())) > 300


def test_responses_of_any_shape(spark):
    shapes = [
        ('{"id":"a","response":"x"}', "a", "x"),
        ('{"custom_id":"b","choices":[{"message":{"content":"y"}}]}', "b", "y"),
        ('{"id":"c","choices":[{"text":"z"}]}', "c", "z"),
        ('{"id":"d","response":{"body":{"choices":[{"message":{"content":"w"}}]}}}', "d", "w"),
        ('{"id":"e","messages":[{"role":"user","content":"q"},{"role":"assistant","content":"v"}]}', "e", "v"),
        ('{"id":"f","response":""}', "f", ""),
        ('{"id":"g","text":5}', "g", ""),
    ]
    rows = spark.createDataFrame([(s[0],) for s in shapes], "j string").select(F.parse_json("j").alias("v"))
    got = [(r.i, r.t) for r in rows.select(text.response_id(F.col("v")).alias("i"), text.response_text(F.col("v")).alias("t")).collect()]
    assert got == [s[1:] for s in shapes]


def test_summary_cleaning(spark):
    t = F.col("t")
    assert one(spark, text.clean_summary(t), t='Here is the summary: "abc"') == "abc"
    assert one(spark, text.clean_summary(t), t="Summary judgment was given") == "judgment was given"
    assert one(spark, text.clean_summary(t, strict=True), t="Summary judgment was given") == "Summary judgment was given"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("ab ", min_size=1, max_size=12), min_size=1, max_size=6))
def test_chunk_starts_are_increasing(chunks):
    shown = "\n\n".join(f"[{i + 1}] {c}" for i, c in enumerate(chunks))
    starts = chunk_starts(shown, len(chunks))
    assert starts == sorted(starts) and all(shown[s:].startswith(f"[{i + 1}] ") for i, s in enumerate(starts))
