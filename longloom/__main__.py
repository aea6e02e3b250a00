"""Command line: python -m longloom COMMAND --help."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _corpus(spark, a):
    from .sources.corpus import Filters, filtered, read_corpus

    f = Filters(min_tokens=a.min_doc_tokens, min_edu=a.min_edu, drop_dups=not a.keep_dups, max_docs=a.max_docs)
    return filtered(read_corpus(spark, a.input_dir), f)


def _write(rows, a, cue=True, head="", to=None):
    from .plans.budget import counter
    from .plans.shape import shaped, with_variants
    from .sources.storage import write_jsonl

    rows = rows.drop("length", "size")
    out = shaped(rows, a.format, head, cue, counter(a.tokenizer)).withColumn("seed", F.lit(a.seed)).withColumn("num_fewshot", F.lit(getattr(a, "num_fewshot", 0)))
    out = out.withColumn("id", F.concat_ws("-", "task", F.lpad(F.col("sample_id").cast("string"), 6, "0")))
    if a.max_seq_length:
        out = out.withColumn("max_seq_length", F.lit(a.max_seq_length))
    # golds of these tasks are text as it stands, those of the others JSON
    plain = F.to_json(F.array("gold"))
    gold = F.when(F.col("task").isin("mrcr", "idk"), F.substring(plain, F.lit(2), F.length(plain) - 2)).otherwise(F.to_json(F.try_parse_json("gold")))
    write_jsonl(with_variants(out.withColumn("gold", gold)).drop("units"), to or a.output_dir)


def synth(spark, a):
    from .plans import synth as s
    from .plans.budget import counter, numbered_words

    if a.list:
        print("\n".join(s.TASKS))
        return
    words = spark.read.text(a.words).select(F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]+"), 0)).alias("word"))
    pool = numbered_words(words.where(F.length("word").between(3, 12)))
    for name in s.TASKS if a.task == "all" else a.task.split(","):
        rows, head = s.fitted(spark, name, a.num_samples, a.max_seq_length, pool, a.seed, counter(a.tokenizer), a.num_fewshot)
        _write(rows, a, head=head, to=f"{a.output_dir}/{name}")


def cluster(spark, a):
    from .operators.neighbors import bundle, bundle_summary, topk
    from .sources.storage import write_summary

    vectors = spark.read.parquet(a.vectors)
    near = topk(vectors, a.topk, id_col=a.id_col, blocks=a.blocks or None)
    found = bundle(near, vectors.select(F.col(a.id_col).alias("id"), "n_tokens"), a.budget, a.floor)
    found.write.mode("overwrite").parquet(f"{a.output_dir}/clusters.parquet")
    write_summary(bundle_summary(spark.read.parquet(f"{a.output_dir}/clusters.parquet")), f"{a.output_dir}/summary.json")


def reorder_command(spark, a):
    from .plans.corpus_tasks import reorder

    docs = _corpus(spark, a).select(F.col("doc_id").alias("src"), "text")
    for flow in a.flows.split(","):
        _write(reorder(docs, flow, a.context_len, a.target_para_tokens, a.max_para_tokens, a.target_jitter, a.min_units, a.seed, a.max_reuse, a.num_samples), a, cue=False)


def _paragraph_task(spark, a, build, reserve):
    from .operators.segment import passage_pool
    from .plans.budget import counter, fitted_size, within_budget
    from .sources.storage import stored

    pool = stored(passage_pool(_corpus(spark, a), a.pool_size), "pool")
    make = lambda rows: build(rows.select("sample_id", F.col("size").alias("n")), pool, a.seed)
    count, room = counter(a.tokenizer), a.max_seq_length - reserve
    size = fitted_size(spark, make, room, a.min_size, count, cue=False)
    _write(within_budget(spark, make, a.num_samples, size, room, a.min_size, count, cue=False), a, cue=False)


def mrcr(spark, a):
    from .plans.corpus_tasks import retrieval

    _paragraph_task(spark, a, retrieval, 560)


def idk(spark, a):
    from .plans.corpus_tasks import abstention

    _paragraph_task(spark, a, abstention, 16)


def prepare(spark, a):
    from .plans import requests as r
    from .sources.corpus import within_limit

    docs = within_limit(_corpus(spark, a), a.min_doc_tokens, a.max_seq_length, a.reserve_tokens)[0]
    asked, table = r.multihop_prepare(docs, seed=a.seed) if a.kind == "multihop" else r.summarize_prepare(docs, a.summary_words)
    asked.write.mode("overwrite").json(f"{a.output_dir}/requests")
    table.write.mode("overwrite").json(f"{a.output_dir}/docs")


def assemble(spark, a):
    from .plans import requests as r
    from .sources.storage import read_jsonl

    asked, docs = spark.read.json(f"{a.input_dir}/requests"), spark.read.json(f"{a.input_dir}/docs")
    found, _ = r.matched(read_jsonl(spark, a.responses), asked, a.id_field, a.text_field)
    run = r.multihop_assemble if a.kind == "multihop" else r.summarize_assemble
    run(found, docs, a.format).write.mode("overwrite").json(a.output_dir)


def verify(spark, a):
    """Recompute every gold of written samples; ends with status 1 unless all agree."""
    from .plans import synth as s
    from .plans import verify as v
    from .sources.storage import stored

    row = F.parse_json("value")
    got = lambda path, kind="string": F.try_variant_get(row, path, kind)
    task, gold = got("$.task"), F.try_variant_get(row, "$.gold", "variant")
    text = F.when(task.isin("mrcr", "idk"), got("$.gold")).otherwise(F.to_json(gold))
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(a.input_dir)
    rows = lines.select(
        task.alias("task"), F.xxhash64("value").alias("sample_id"), got("$.context").alias("context"), got("$.question").alias("question"),
        got("$.answers", "array<string>").alias("answers"), text.alias("gold"), F.to_json(F.try_variant_get(row, "$.meta", "variant")).alias("meta"),
    )
    rows = stored(rows, "samples")
    special = {"mrcr": v.check_retrieval, "idk": v.check_abstention}
    good = True
    for name in sorted(r[0] for r in rows.select("task").distinct().collect() if r[0] in s.TASKS or r[0] in special):
        of = rows.where(F.col("task") == name)
        found = v.summary(special[name](of) if name in special else v.check(of, name)).first()
        n = of.count()
        print(f"{name}: {found.n_ok if found else 0}/{n} samples verified")
        good &= bool(found) and found.n_ok == n
    if not good:
        raise SystemExit(1)


def datagen(spark, a):
    """All offline generators over length buckets, each with its share of the totals, then a tally of what is there."""
    from .sources.storage import line_tally

    lengths = [int(x) for x in a.lengths.split(",")]
    totals = {synth: a.synth_total // 22, reorder_command: a.reorder_total // 2, mrcr: a.retrieval_total, idk: a.abstention_total}
    for at in lengths:
        for command, total in totals.items():
            if total // len(lengths):
                name = command.__name__.removesuffix("_command")
                given = {"num_samples": total // len(lengths), "max_seq_length": at, "context_len": at, "output_dir": f"{a.output_dir}/{at}/{name}"}
                shared = {k: getattr(a, k) for k in ("seed", "format", "tokenizer", "input_dir", "words")}
                options = parser().parse_args([name])
                vars(options).update({k: x for k, x in (given | shared).items() if hasattr(options, k)})
                command(spark, options)
    line_tally(spark, a.output_dir).orderBy("generator").show(100, False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("longloom")
    sub = p.add_subparsers(required=True)

    def command(f, **flags):
        c = sub.add_parser(f.__name__.removesuffix("_command"))
        c.set_defaults(run=f)
        common = {"output_dir": "out", "seed": 42, "format": "sft", "max_seq_length": 4096, "tokenizer": "whitespace"}
        for name, value in (common | flags).items():
            if isinstance(value, bool):
                c.add_argument(f"--{name}", action="store_true")
            else:
                c.add_argument(f"--{name}", default=value, type=type(value) if value is not None else int)
        return c

    reading = {"input_dir": "data", "min_doc_tokens": 400, "min_edu": 0.75, "keep_dups": False, "max_docs": None}
    paragraph = reading | {"num_samples": 20, "min_size": 6, "pool_size": 20000, "max_seq_length": 8192}
    command(synth, task="all", num_samples=10, words="words.txt", list=False, format="pt", num_fewshot=0)
    command(cluster, vectors="vectors.parquet", id_col="doc_id", topk=64, budget=131072, floor=0.35, blocks=0)
    command(reorder_command, **reading | {"min_doc_tokens": 8000, "context_len": 131072, "flows": "reconstruct,permutation", "target_para_tokens": 10000, "target_jitter": 0.25, "max_para_tokens": None, "min_units": 2, "max_reuse": 5, "num_samples": None, "seed": 0})
    command(mrcr, **paragraph)
    command(idk, **paragraph | {"min_size": 8})
    command(verify, input_dir="out")
    command(datagen, **reading | {"words": "words.txt", "lengths": "8192,32768,131072,163840", "synth_total": 400_000, "reorder_total": 300_000, "retrieval_total": 150_000, "abstention_total": 150_000})
    for f, more in ((prepare, reading | {"kind": "multihop", "reserve_tokens": 2048, "summary_words": None, "max_seq_length": 131072}), (assemble, {"input_dir": "out", "responses": "responses", "kind": "multihop", "id_field": "id"})):
        c = command(f, **more)
    c.add_argument("--text_field", default=None)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(SparkSession.builder.appName("longloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
