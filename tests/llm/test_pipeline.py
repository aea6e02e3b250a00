"""The pipeline against the brute-force steps, stage by stage."""

import numpy as np

import __spark_entry__
import corpus_pipeline
from longloom.llm import quality, rules
from longloom.llm._shared import stored, table

from .test_operators import WORD, brute_groups, brute_windows

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = stored(stage(spark, kept, SF), name)
        if name == "quality_rules":
            want = {r.doc_id for r in before if not any(x.rejects(rules.Text(np.frombuffer(r.text.encode(), np.uint8))) for x in rules.RULES)}
            assert {r.doc_id for r in kept.collect()} == want
        elif name == "quality_classifier":
            model = quality.learn(docs, table(spark, SF, "labels"))
            score = {r.doc_id: model.score(np.array([quality.figures(np.frombuffer(r.text.encode(), np.uint8))]))[0] for r in before}
            assert {r.doc_id for r in kept.collect()} == {i for i, s in score.items() if s >= 0.3}
        elif name == "minhash_dedup":
            group, _ = brute_groups([(r.doc_id, r.text) for r in before], 5)
            assert {r.doc_id for r in kept.collect()} == set(group.values())
        elif name == "substring_dedup":
            _, left = brute_windows([(r.doc_id, r.text) for r in before])
            got = {r.doc_id: r for r in kept.collect()}
            assert {i: WORD.findall(r.text) for i, r in got.items()} == {r.doc_id: w for r, w in zip(before, left)}
            assert all(r.n_chars == len(r.text) for r in got.values())
        if name != "packing":
            assert kept.columns == columns
        else:
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in before}


def test_run_on_odd_tables(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows, an extra column; then an empty table."""
    good = [r.text for r in table(spark, SF, "documents").where("length(text) > 900 AND length(text) < 4000").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t, "en", "web", len(t), "x") for i, t in enumerate(good)]
    rows += [rows[0], (None, good[1], None, None, None, None), (50, None, None, None, None, None), (51, "", "en", "web", 0, "x"), (None, None, None, None, None, None)]
    rows += [(52, " ".join(good[2:9]) + " " + "".join(reversed(good[3])) * 30, "en", "web", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _spans string"
    for name, found in (("odd", rows), ("none", [])):
        spark.createDataFrame(found, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        table(spark, SF, "labels").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    packed = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert packed and {r.doc_id for r in packed} <= {*range(12), 52, None} and sum(r.start == 0 for r in packed if r.doc_id == 0) <= 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_registered():
    found = __spark_entry__.queries()
    assert "pipeline" in found and all(any(q.startswith(f"op{n}_") for q in found) for n in range(1, 11))
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
