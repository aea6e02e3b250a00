import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from longloom import plans
from longloom.operators import graph, neighbors, segment
from longloom.plans import corpus_tasks, generated, requests, synth, verify, views
from longloom.sources import corpus, storage

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = (
    "drop_reasons", "quality_filter", "token_count", "text_by_id", "pred_between", "tally", "group_sum", "num_median", "top_k_words",
    "set_diff", "graph_bfs", "graph_maxdeg", "graph_cycle_dag", "var_arith", "word_chunks", "running_span", "packed_passages",
    "knn_topk", "roles", "options", "marker_parse", "qa_parse", "summary_clean", "assemble_pairs", "sample_sft",
)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, db, name):
    got = plans.get(name)(spark, SF).toPandas()
    want = db.sql(plans.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    key = lambda df: df[columns].astype(str).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(key(got), key(want))


def test_entry_and_registry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    with pytest.raises(KeyError, match="unknown query"):
        plans.get("nothing")


@pytest.mark.parametrize("task", ["common_words", "freq_words", "count_predicate", "numeric_agg", "top_k", "set_ops", "graph_bfs", "graph_cycle", "graph_component_size"])
def test_gold_equals_its_own_sql(spark, db, task):
    test_query_equals_its_sql(spark, db, f"gold_{task}")


def test_every_task_has_a_gold_query():
    assert {f"gold_{t}" for t in synth.TASKS} <= set(plans.ORACLE_SQL)


def test_closures_on_a_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "u string, v string")
    start = spark.createDataFrame([("a",)], "node string")
    assert {r.node for r in graph.reachable(e, start).collect()} == {"b", "c", "d"}
    assert {(r.node, r.depth) for r in graph.bfs(e, start).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert {r.node for r in graph.weak_component(e, start).collect()} == {"a", "b", "c", "d"}
    assert graph.has_cycle(e).first()[0] and not graph.has_cycle(e.where("u <> 'c'")).first()[0]


@pytest.mark.parametrize("name", ["graph_all_degrees", "graph_all_bfs", "graph_all_cycle_dag"])
def test_graphs_over_all_edges(spark, db, name):
    test_query_equals_its_sql(spark, db, name)


def test_all_edges_has_every_transition(spark, tmp_path):
    users = [1, 2, 1, 3, 1, 4, 1, 1, 5, 1, 2]
    pd.DataFrame({"ts": pd.to_datetime(range(11), unit="s"), "event_id": range(11), "user_id": users}).astype({"ts": "datetime64[us]"}).to_parquet(
        tmp_path / "events.parquet"
    )
    got = {(r.u, r.v) for r in views.all_edges(spark, str(tmp_path)).collect()}
    assert got == {(a, b) for a, b in zip(users, users[1:]) if a != b} and len([v for u, v in got if u == 1]) == 4
    degrees = {r.node: r.out_degree for r in plans.get("graph_all_degrees")(spark, str(tmp_path)).collect()}
    assert degrees == {1: 4, 2: 1, 3: 1, 4: 1, 5: 1}


def test_corpus_reading(spark, tmp_path):
    with pytest.raises(ValueError, match="no parquet"):
        corpus.read_corpus(spark, str(tmp_path / "none"))
    rows = [("a b c", [0.9], 1, 3), ("", [0.9], 1, 9), (None, None, None, 9), ("d e", [0.1], 1, 9), ("f", [0.9], 4, 9), ("g h", None, None, 9)]
    spark.createDataFrame(rows, "content string, fw_edu_scores array<double>, minhash_cluster_size int, token_count int").write.parquet(str(tmp_path / "c"))
    c = corpus.read_corpus(spark, str(tmp_path / "c"))
    assert c.select("doc_id").distinct().count() == 6
    got = {r.reason: r.n for r in corpus.reason_counts(c, corpus.Filters(min_tokens=3)).collect()}
    assert got == {"kept": 1, "empty": 2, "lowedu": 2, "dup": 1}
    spark.createDataFrame([(1,)], "n int").write.parquet(str(tmp_path / "d"))
    with pytest.raises(ValueError, match="no text column"):
        corpus.read_corpus(spark, str(tmp_path / "d"))


def test_packing_equals_a_plain_fold(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "i int, text string")
    got = {r.i: [p.n_tok for p in r.p] for r in df.select("i", segment.packed(F.split("text", "\n"), 40).alias("p")).collect()}
    import re

    for i, t in enumerate(docs):
        out, n = [], 0
        for line in t.split("\n"):
            k = len(re.findall(r"\w+|[^\w\s]", line))
            if n and n + k > 40:
                out.append(n)
                n = 0
            n += k
        assert got[i] == (out + [n] if n else out)


def test_passages_cut_oversize_paragraphs(spark):
    t = "a b\n\n" + " ".join(["w"] * 50) + "\n\nc d e"
    got = spark.createDataFrame([(t,)], "t string").select(segment.passages(F.col("t"), target=20, least=1, most=30).alias("p")).first().p
    assert [p.n_tok for p in got] == [2, 18, 18, 14, 3]


def test_neighbours_and_chains(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((40, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -9)
    near = neighbors.topk(df, 5, blocks=3)
    got = {(r.i, r.k_rank): r.j for r in near.collect()}
    assert all(got[i, k + 1] == j for i in range(40) for k, j in enumerate(np.argsort(-sim[i])[:5]))
    docs = spark.createDataFrame([(i, 100) for i in range(40)], "id long, n_tokens long")
    found = neighbors.bundle(near, docs, budget=350, floor=0.3).collect()
    assert sorted(r.id for r in found) == list(range(40))
    order = {i: [(s, j) for j, s in sorted(((j, sim[i, j]) for j in np.argsort(-sim[i])[:5]), key=lambda p: -p[1])] for i in range(40)}
    want = neighbors.chain(list(range(40)), dict.fromkeys(range(40), 100), order, 350, 0.3)
    number = {s: k for k, s in enumerate(sorted({s for s, _, _ in want}))}
    assert {(r.id, r.cluster_id, r.rank) for r in found} == {(m, number[s], k) for s, k, m in want}


def test_golds_hold_at_odd_sizes(spark):
    pool = [f"{a}{b}x" for a in "bcdfg" for b in "aeiou"]
    for name in ("top_k", "set_ops", "count_predicate", "numeric_agg", "variable_arithmetic"):
        s = synth.samples(spark, name, 10, 41, pool, seed=5)
        assert all(r.ok for r in verify.check(s, name).collect()), name


def test_size_fits_the_budget(spark):
    pool = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrs"]
    size = synth.fit_size(spark, "numeric_agg", 500, pool)
    assert 100 < size < 170
    with pytest.raises(KeyError):
        synth.get_task("nothing")


def test_samples_do_not_depend_on_partitions(spark):
    pool = ["alpha", "beta", "gamma", "delta", "kappa", "sigma", "omega"]
    p = synth.params(spark, 12, 20, pool)
    a, b = (sorted(map(tuple, synth.TASKS["group_by"].build(p.repartition(n), 1).collect())) for n in (1, 5))
    assert a == b


def test_retrieval_takes_two_markers_only(spark):
    with pytest.raises(ValueError, match="k must be 2"):
        corpus_tasks.retrieval(corpus_tasks.sized(spark, 1, 6), None, k=3)
    assert len(corpus_tasks.MARKERS) == len(set(corpus_tasks.MARKERS)) == 131


def test_last_response_wins_and_unmatched_are_counted(spark):
    docs = spark.createDataFrame([("1", "s", "text one", 5)], "doc_id string, source string, text string, n_tokens long")
    asked, kept = requests.summarize_prepare(docs)
    rows = [("a", "1", '{"id":"sum-000000","text":"Summary: old"}'), ("b", "1", '{"id":"sum-000000","text":"\\"new\\""}'), ("b", "2", '{"id":"zz","text":"x"}')]
    replies = spark.createDataFrame(rows, "file string, line string, j string").select("file", "line", F.parse_json("j").alias("row"))
    found, lost = requests.matched(replies, asked)
    out = requests.summarize_assemble(found, kept, "pt").collect()
    assert [r.summary for r in out] == ["new"] and lost.count() == 1 and out[0].text.startswith("text one\n\nWrite")


def test_stream_assembles_what_has_arrived(spark, tmp_path):
    from longloom.streaming.assemble import assemble_stream, response_stream

    docs = spark.createDataFrame([("1", "s", "text one", 5)], "doc_id string, source string, text string, n_tokens long")
    asked, kept = requests.summarize_prepare(docs)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.jsonl").write_text('{"id":"sum-000000","text":"fine"}\n\nbroken\n')
    q = assemble_stream(response_stream(spark, str(tmp_path / "in")), asked, kept, str(tmp_path / "store"), str(tmp_path / "out"), str(tmp_path / "cp"), "summarize")
    q.awaitTermination()
    assert [r.summary for r in spark.read.json(str(tmp_path / "out")).collect()] == ["fine"]


def test_jsonl_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", "t1", None), ("b", "t2", "x")], "id string, task string, note string")
    storage.write_jsonl(rows, str(tmp_path / "o"))
    back = storage.read_jsonl(spark, str(tmp_path / "o" / "*"))
    assert back.count() == 2
    assert storage.line_tally(spark, str(tmp_path / "o")).agg(F.sum("n")).first()[0] == 2
    assert storage.viewer_sample(rows, 1).count() == 2


def test_zipf_counts_are_floors(spark):
    got = {r.rank: r.n for r in plans.get("zipf_counts")(spark, SF).collect()}
    assert got[1] == math.floor(5000 / 2.612375348685488)


def test_pools_reach_the_whole_corpus(spark):
    pool = generated._pool(spark, SF, "word_count").collect()
    vocabulary = {r.word for r in views.word_stream(spark, SF).select("word").distinct().collect()}
    half = sorted(vocabulary)[len(vocabulary) // 2]
    for i in range(generated.N):
        words = {r.word for r in pool if r.sample_id == i}
        assert len(words) == generated.POOL_WORDS and words <= vocabulary
        assert 0.4 < sum(w > half for w in words) / len(words) < 0.6
    docs = views.table(spark, SF, "documents")
    longest = docs.orderBy(F.desc("n_chars")).first().text
    found = [r.text for r in generated._passages(spark, SF).collect()]
    assert len(longest) > 2000 and sum(p[:100] in " ".join(longest.split()) for p in found) > 1
    cut = docs.select(F.explode(segment.passages(F.col("text"))))
    assert len(found) == min(cut.count(), 20_000)


@pytest.mark.parametrize("spec", ["whitespace", "hf"])
def test_no_sample_exceeds_its_budget(spark, spec):
    from longloom.plans import budget

    if spec == "hf":
        spec = "hf:" + pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    words = spark.createDataFrame([(f"{a}{b}word",) for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst"], "word string")
    pool, count = budget.numbered_words(words), budget.counter(spec)
    assert sorted(r.wid for r in pool.collect()) == list(range(400))
    for task in ("numeric_agg", "graph_children") if spec == "whitespace" else ("numeric_agg",):
        most = 1200
        rows, head = synth.fitted(spark, task, 6, most, pool, count=count, shots=2 * (task == "numeric_agg"))
        assert bool(head) == (task == "numeric_agg")
        got = rows.withColumn("again", budget.length(count, head)).collect()
        least = synth.get_task(task).min_size
        assert len(got) == 6 and all(r.length == r.again and (r.length <= most - synth.get_task(task).reserve_tokens or r.size == least) for r in got)
        assert max(r.length for r in got) > 0.6 * (most - synth.get_task(task).reserve_tokens)
        assert verify.summary(verify.check(rows, task)).first().n_ok == 6


def test_samples_over_budget_shrink(spark):
    from longloom.plans import budget

    def build(rows):
        text = F.array_join(F.array_repeat(F.lit("w"), F.col("size") + 5 * F.col("sample_id").cast("int")), " ")
        blank = F.lit("")
        return rows.select("sample_id", blank.alias("instruction"), text.alias("context"), blank.alias("question"), blank.alias("answer_prefix"))

    got = {r.sample_id: (r.size, r.length) for r in budget.within_budget(spark, build, 10, 50, 60, 20, budget.counter()).collect()}
    assert got[0] == (50, 50) and got[2] == (50, 60) and got[3] == (45, 60) and got[9] == (20, 65)


def test_command_line_generates_and_verifies(spark, tmp_path, capsys):
    from longloom import __main__ as cli

    (tmp_path / "words.txt").write_text("\n".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abc"))
    a = cli.parser().parse_args(["synth", "--task", "count_distinct,set_ops", "--words", f"{tmp_path}/words.txt", "--num_samples", "4", "--max_seq_length", "900", "--output_dir", f"{tmp_path}/out"])
    cli.synth(spark, a)
    cli.verify(spark, cli.parser().parse_args(["verify", "--input_dir", f"{tmp_path}/out"]))
    said = capsys.readouterr().out
    assert "count_distinct: 4/4 samples verified" in said and "set_ops: 4/4 samples verified" in said
    assert {"verify", "datagen"} <= set(cli.parser()._subparsers._group_actions[0].choices)


def test_edges_are_found_range_by_range(spark, tmp_path):
    """The step from each event to the next one needs no task that sorts all events; nulls come last, as in the SQL."""
    rng = np.random.default_rng(5)
    n = 3000
    events = pd.DataFrame({"event_id": rng.permutation(n), "ts": pd.to_datetime(rng.integers(0, 500, n), unit="s").astype("datetime64[us]"), "user_id": rng.integers(0, 40, n)}).astype({"user_id": "Int64"})
    events.loc[events.event_id % 97 == 0, "ts"] = pd.NaT
    events.loc[events.event_id % 89 == 0, "user_id"] = pd.NA
    events.to_parquet(tmp_path / "events.parquet")
    held = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        for found, sql in ((views.all_edges, views.ALL_EDGES), (views.edges, views.EDGES)):
            got = found(spark, str(tmp_path))
            assert len(got.inputFiles()) == 7  # written range by range
            want = con.sql(f"WITH {sql} SELECT u, v FROM v_edges").fetchall()
            assert sorted(map(tuple, got.collect())) == sorted(want) and want
        assert views.all_edges(spark, str(tmp_path)).count() > 900
        empty = spark.read.parquet(str(tmp_path / "events.parquet")).where("event_id < 0")
        empty.write.parquet(str(tmp_path / "none/events.parquet"))
        assert views.all_edges(spark, str(tmp_path / "none")).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_component_of_a_long_path(spark, monkeypatch):
    """Labels settle in few rounds, however long a path is and whatever the order of its ids."""
    ids = np.random.default_rng(3).permutation(300).tolist()
    rows = [*zip(ids, ids[1:]), (900, 901), (902, 902)]
    e = spark.createDataFrame(rows, "u long, v long")
    written = []
    monkeypatch.setattr(neighbors, "stored", lambda df, name: written.append(name) or storage.stored(df, name))
    got = {r.id: r.component_id for r in neighbors.label_components(e).collect()}
    assert got == {**{i: 0 for i in ids}, 900: 900, 901: 900, 902: 902}
    assert 2 <= written.count("label") <= 8
    start = spark.createDataFrame([(ids[150],), (901,), (7777,)], "node long")
    found = {(r.start, r.node) for r in graph.weak_component(e, start).collect()}
    assert found == {(ids[150], i) for i in ids} | {(901, 900), (901, 901), (7777, 7777)}


def test_reorder_numbers_no_texts_in_one_task(spark):
    held = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        names = [f"s{i * 7919 % 1000}" for i in range(200)]
        sources = spark.createDataFrame([(n, "\n\n".join(f"{n} part {j} " + "word " * 20 for j in range(6))) for n in names], "src string, text string")
        got = corpus_tasks.reorder(sources, "permutation", context_len=1700, target=30, reuse=2)
        assert got.rdd.getNumPartitions() == 7  # rows with texts stay apart
        rows = sorted((r.sample_id, r.source) for r in got.select("sample_id", "source").collect())
        assert rows == list(enumerate(sorted(names) * 2))
        first = corpus_tasks.reorder(sources, "permutation", context_len=1700, target=30, reuse=2, num_samples=30)
        assert sorted((r.sample_id, r.source) for r in first.select("sample_id", "source").collect()) == rows[:30]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_best_columns_equal_a_whole_sort():
    rng = np.random.default_rng(1)
    for columns, k in ((50, 8), (8, 8), (3, 8), (1, 1)):
        sim = rng.integers(0, 6, (40, columns)).astype(float)  # full of ties
        sim[rng.random(sim.shape) < 0.2] = -np.inf
        sim[0] = -np.inf
        top = np.argsort(-sim, axis=1, kind="stable")[:, :k]
        want = [(r, c) for r in range(40) for c in top[r].tolist() if sim[r, c] > -np.inf]
        assert list(zip(*(x.tolist() for x in neighbors.best_columns(sim, k)))) == want
