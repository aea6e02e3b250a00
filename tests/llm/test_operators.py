"""The operators on small tables, odd cases included, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from pyspark.sql import functions as F

from longloom.llm import bpe, embeddings, html, minhash, packing, quality, rules, substring, token_counts, toxicity
from longloom.llm._shared import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, anchor int, key string, label int, id long, spans int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, near copies, columns with names the operators use inside."""
    base, long = sentence(1, 120), sentence(2, 9000)
    near = base.split(" ")
    near[5] = "changed"
    shared = sentence(3, 40)
    texts = [
        (0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, "one two"), (8, "ONE two"),
        (9, sentence(4, 60) + " " + shared), (10, shared + " " + sentence(5, 60)), (None, sentence(6, 80)), (11, sentence(7, 50)), (11, sentence(7, 50)),
        (12, "word " * 90), (13, sentence(8, 30) + "\n" + sentence(8, 30)),
    ]
    return [(i, t, "en", None, None, 1, "k", 0, 5, 2) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.createDataFrame(odd, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (6, 6), (9, 8), (8, 7), (7, 3), (2, 1)], "u long, v long")
    assert {r.id: r.component_id for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 4: 4, 5: 4}
    assert components(edges.limit(0)).count() == 0
    path = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.component_id for r in components(path).collect()} == {1}


def brute_windows(odd, size=35):
    words = [WORD.findall(t or "") for _, t, *_ in odd]
    seen = {}
    for w in words:
        for i in range(len(w) - size + 1):
            seen[tuple(w[i : i + size])] = seen.get(tuple(w[i : i + size]), 0) + 1
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append([x for x, g in zip(w, gone) if not g])
    return words, out


def test_substring_removal(docs, odd, empty):
    words, kept = brute_windows(odd)
    want = sorted((str(o[0]), len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for o, w, k in zip(odd, words, kept))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.digests(docs).collect()) == want
    cut = substring.remove(docs)
    assert cut.columns == docs.columns and sorted(" ".join(WORD.findall(r.text or "")) for r in cut.collect()) == sorted(" ".join(k) for k in kept)
    assert substring.digests(empty).count() == 0 == substring.remove(empty).count()


def test_substring_of_shared_passages(spark):
    passages = [sentence(100 + i, 60) for i in range(4)]
    rows = [(i, sentence(i, 20 + i) + " " + passages[i % 4][: 300 - 40 * (i % 3)] + "\n" + sentence(500 + i, 15), *["x"] * 1) for i in range(24)]
    rows += [(24, passages[0] + " " + passages[0], "x"), (25, passages[1] * 2, "x")]
    words, kept = brute_windows(rows)
    want = {r[0]: (len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for r, w, k in zip(rows, words, kept)}
    got = substring.digests(spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(5))
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got.collect()} == want


def brute_groups(rows, size, percent=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append((i, {tuple(w[j : j + size]) for j in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if i is not None and j is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}, sets


def test_near_duplicates(docs, odd, empty):
    group, sets = brute_groups([o[:2] for o in odd], 4)
    got = minhash.near_duplicates(docs, size=4).collect()
    assert len(got) == len(odd)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == group
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sorted((str(i), len(s)) for i, s in sets)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    kept = minhash.keep_one(docs, size=4)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, *group.values()}
    assert minhash.near_duplicates(empty).count() == 0 == minhash.keep_one(empty).count()


def test_links_across_a_bucket_are_not_lost(spark):
    """Chains of edits: neighbours pass 0.8, the ends do not; every component must be whole."""
    rows = []
    for c in range(6):
        w = sentence(c, 120).split(" ")
        for step in range(12):
            rows.append((c * 100 + 99 - 7 * step % 100, " ".join(w)))
            w[(step * 17) % 120] = f"e{c}{step}"
            w[(step * 31 + 5) % 120] = f"f{c}{step}"
    group, _ = brute_groups(rows, 4)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4, block=3).collect()
    assert {r.doc_id: r.component_id for r in got} == group


def test_a_large_group_whose_members_mostly_fail_against_their_leader(spark):
    """Edits of one text that keep 0.8 with the next few only; copies, repeated ids and other texts beside them."""
    rng = np.random.default_rng(3)
    base = sentence(7, 100).split(" ")
    rows = []
    for i in range(160):
        w = list(base)
        for j in rng.choice(100, 1 + i % 6, replace=False):
            w[j] = f"z{i}q{j}"
        rows.append((1000 - i, " ".join(w)))
    rows += [(2000 + i, rows[i % 7][1]) for i in range(20)] + [(3000 + i, sentence(900 + i, 80)) for i in range(40)]
    group, sets = brute_groups(rows, 4)
    failing = sum(100 * len(s & sets[0][1]) < 80 * len(s | sets[0][1]) for _, s in sets[:160])
    assert failing > 80
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (8, 256):
        got = minhash.near_duplicates(frame, size=4, block=block).collect()
        assert {r.doc_id: r.component_id for r in got} == group


def test_one_id_on_two_texts_joins_their_groups(spark):
    a, b = sentence(1, 40), sentence(2, 40)
    frame = spark.createDataFrame([(1, a), (5, a), (5, b), (9, b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(frame).collect()} == {(1, 1), (5, 1), (9, 1)}


def test_recall_at_default_settings(spark):
    """Pairs found on a driver table, against all pairs by brute force."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    group, _ = brute_groups([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == group


def test_vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[100:160] = x[:60] + 0.12 * rng.standard_normal((60, 16)).astype(np.float32)
    x[160:200] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, []), (905, [float("inf")] + [1.0] * 15), (906, x[7].tolist())]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, size int, codes int")
    good = [(i, np.array(v, float)) for i, v in rows if i < 900 or i == 906]
    u = np.stack([v / np.linalg.norm(v) for _, v in good])
    links = u @ u.T >= 0.95
    ids = [i for i, _ in good]
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, miss=1e-6, block=16).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links == n - 1 for i, n in zip(ids, links.sum(1)))
    parent = dict(zip(ids, ids))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in zip(*np.nonzero(links)):
        ra, rb = root(ids[a]), root(ids[b])
        parent[max(ra, rb)] = min(ra, rb)
    assert all(got[i].component_id == root(i) and got[i].kept == (root(i) == i) for i in ids)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906))
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    assert embeddings.near_duplicates(df.where("vec_id = 900")).count() == 1


def test_vectors_of_many_lengths_and_null_ids(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in range(2, 30):
        x = rng.standard_normal(n)
        rows += [(n, x.tolist()), (100 + n, (x * 3).tolist()), (200 + n, (-x).tolist())]
    rows += [(None, rows[0][1]), (None, None)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows) and sum(r.vec_id is None and r.kept and not r.n_links and r.component_id is None for r in got) == 2
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    assert all((by[n].component_id, by[100 + n].component_id, by[200 + n].component_id) == (n, n, 200 + n) for n in range(2, 30))


def test_vectors_in_double_precision(spark):
    """Two vectors that single precision cannot tell apart lie on either side of the threshold."""
    a, b = np.arccos(0.95) - 1e-9, np.arccos(0.95) + 1e-9
    rows = [(1, [1.0, 0.0]), (2, [float(np.cos(a)), float(np.sin(a))]), (3, [float(np.cos(b)), float(-np.sin(b))])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), miss=1e-9).collect()
    assert {r.vec_id: r.n_links for r in got} == {1: 1, 2: 1, 3: 0}


def test_vector_recall_at_default_settings(spark):
    """The vectors of a driver table, each with a fellow at a cosine barely above the threshold; against brute force."""
    found = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    x = np.stack([np.array(r.embedding, float) for r in found.collect()])
    x /= np.linalg.norm(x, axis=1)[:, None]
    rng = np.random.default_rng(2)
    aside = rng.standard_normal(x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    cos = rng.uniform(0.9501, 0.96, len(x))[:, None]
    x = np.vstack([x, cos * x + np.sqrt(1 - cos**2) * aside / np.linalg.norm(aside, axis=1)[:, None]]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame).collect()}
    assert want.sum() >= len(x) and all(got[i] <= n for i, n in enumerate(want))
    assert sum(got.values()) >= 0.99 * want.sum()


def test_tokens(docs, odd, empty):
    path = public.path("byte_bpe_multi_50k.tiktoken")
    theirs = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = sorted((str(i), len(ids := theirs.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in odd)
    got = bpe.digests(docs, path, public.PATTERN)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == want
    back = bpe.decode(bpe.encode(docs, path, public.PATTERN), path)
    assert sorted(bytes(r.data) for r in back.collect()) == sorted((o[1] or "").encode() for o in odd)
    counted = token_counts.token_counts(docs, path, public.PATTERN)
    assert sorted(r.n_bytes for r in counted.collect()) == sorted(len((o[1] or "").encode()) for o in odd)
    assert bpe.digests(empty, path, public.PATTERN).count() == 0 == token_counts.token_counts(empty, path, public.PATTERN).count()


def test_token_counts_equal_a_plain_viterbi(docs, odd):
    import regex

    path = public.path("byte_bpe_multi_50k.tiktoken")
    scores, found = token_counts.zipf_scores(bpe.load_ranks(path)), {}
    longest = max(map(len, scores))

    def tokens(word):
        if word not in found:
            best = [(0.0, 0)]
            for end in range(1, len(word) + 1):
                options = [(best[at][0] + scores[word[at:end]], best[at][1] - 1) for at in range(max(0, end - longest), end) if word[at:end] in scores]
                best.append(max(options))
            found[word] = -best[-1][1]
        return found[word]

    parts = [(i, [w.encode() for w in regex.findall(public.PATTERN, t or "")]) for i, t, *_ in odd]
    want = sorted((str(i), len(ws), sum(map(tokens, ws))) for i, ws in parts)
    assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in token_counts.token_counts(docs, path, public.PATTERN).collect()) == want


def test_packing(docs, odd, empty):
    from tokenizers import Tokenizer

    path = public.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {}
    for i, t, *_ in odd:
        ids.setdefault(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    rows = packing.pack(docs, path).collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(len(ids[o[0]]) for o in odd)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        n = 0
        for offset, size in sorted(parts):
            assert offset == n
            n += size
        assert n == 2048 or n < 2048 and n & (n - 1) == 0
    assert packing.pack(empty, path).count() == 0


def test_rules(docs, odd, empty):
    got = rules.measures(docs).collect()
    assert sorted(r.n_words for r in got) == sorted(len(WORD.findall(o[1] or "")) for o in odd)
    kept = rules.cascade(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert rules.measures(empty).count() == 0 == rules.cascade(empty).count()


def test_classifiers(spark, docs, odd, empty):
    labels = spark.createDataFrame([(i, int(i != 12), int(i in (6, 9))) for i in range(14)] + [(777, None, None)], "doc_id long, quality int, toxic int")
    for run in (quality.quality, toxicity.toxicity):
        rows = run(docs, labels).collect()
        assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
        assert all(r.held_out is False for r in rows if r.doc_id is None)
        assert run(empty, labels).count() == 0
        assert run(docs, labels.limit(0)).count() == len(odd)
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_held_out_quality_and_toxicity(spark):
    """Labels of the held-out fold are met without having been seen."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in scored if r.quality == 1], [r.score for r in scored if r.quality == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.9
    learn = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity.toxicity(docs, x).collect()} for x in (labels, learn))
    assert a == b


def test_held_out_quality_decisions(spark):
    """The decision at 0.3 hangs on no labelled bad text: their labels may be absent or wrong. Same for 1 and 32 partitions."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality(docs.repartition(32), labels.where("quality = 1")).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.where("quality IS NOT NULL").collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert np.mean([r.predicted for r, y in held if y == 1]) > 0.99
    whole = {r.doc_id: r.score for r in quality.quality(docs.coalesce(1), labels).collect()}
    assert max(abs(whole[i] - r.score) for i, r in got.items()) < 0.02


def test_held_out_toxicity_of_trained_dictionaries(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.join(labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).select("doc_id"), "doc_id", "left_semi")
    found = toxicity.sample_labelled(docs, labels, "toxic", {1: 1200, 0: 4000}, 20_000)
    model = toxicity.fit(found[1], found[0])
    assert all(len(d) > 500 for d in (model.ordinary, model.toxic)) and model.ordinary[:4] == model.toxic[:4] == b"\x37\xa4\x30\xec"
    distance, w = toxicity.Distance(model), np.array(model.weights)
    score = {r.doc_id: distance.figures(r.text or "") @ w[1:] + w[0] for r in some.collect()}
    by = {y: [score[r.doc_id] for r in labels.collect() if r.toxic == y and r.doc_id in score] for y in (0, 1)}
    assert np.mean([[t > o for o in by[0]] for t in by[1]]) > 0.9
    assert np.mean(np.array(by[0]) > 0) < 0.02


def test_unlabelled_sample_does_not_depend_on_the_split(spark, monkeypatch):
    docs = spark.createDataFrame([(i, sentence(i, 12)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    met = []
    monkeypatch.setattr(quality, "_figures_of", lambda sample: met.append(sample) or np.zeros((0, len(quality.FIGURES))))
    for n in (1, 7):
        quality.learn(docs.orderBy(F.desc("doc_id") if n == 7 else "doc_id").coalesce(1).repartition(n), labels, unlabelled_rows=50)
    assert len(met[1]) == 50 and met[1] == met[4]


def test_keep_one_keeps_one_row_of_each_component(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (2, b), (2, b), (3, a), (3, c), (None, a), (None, c), (None, ""), (None, None), (4, ""), (4, "")]
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [(1, a), (2, b), (3, c), (None, ""), (None, None), (4, "")]))


def test_columns_with_the_names_used_inside(spark):
    a, b = sentence(1, 60), sentence(2, 60)
    names = ("_spans", "_longloom_key", "_longloom_spans", "_longloom_of", "ok", "none", "bucket", "component_id", "n_shingles")
    for ids in ((1, 2, 3), (1, None, 2)):
        rows = [(i, t, *[7] * len(names)) for i, t in zip(ids, (a, a, b))]
        frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
        cut = substring.remove(frame)
        assert cut.columns == frame.columns and sorted(r.text for r in cut.collect()) == ["", "", b]
        kept = minhash.keep_one(frame)
        assert kept.columns == frame.columns and sorted(r.text for r in kept.collect()) == sorted([a, b])
        assert rules.cascade(frame).columns == frame.columns


def test_html(spark):
    page = lambda body: f"<body><div>Home</div><div>{body}</div><div>Contact us</div></body>"
    rows = [(i, f"http://h.example/{i}", page(f"Story {i}"), "x") for i in range(6)]
    rows += [(10, None, None, "x"), (11, "http://other.example/", "", "x"), (12, "not a url", "<p>&lt;b&gt;", "x"), (12, "not a url", "<p>&lt;b&gt;", "x")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string").coalesce(1)).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert text[2] == "Story 2" and text[10] == "" and text[12] == "<b>"
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_searches_past_copies_and_range_bounds(spark, monkeypatch):
    page = lambda body: f"<body><div>Home of the site</div><div>{body}</div><div>Contact us here</div></body>"
    story = lambda x: f"Story of {x} which is long enough to count as an article of its own"
    run = [(i, f"http://h.example/a?{i}", page(story("apples"))) for i in range(5)] + [(5, "http://h.example/b", page(story("bees")))]
    dated = [(10 + i, f"http://d.example/a{i}", f"<p>{story('figs')}</p><p>Date {i}</p>") for i in range(2)]
    pairs = [(100 + i, f"http://two{i // 2:03}.example/{i % 2}", page(story(f"no. {i}"))) for i in range(400)]
    frame = spark.createDataFrame(run + dated + pairs, "page_id long, url string, html string")
    monkeypatch.setattr(html, "partitions", lambda df: 8)
    got = {r.page_id: r.text for r in html.extract(frame).collect()}
    assert len(got) == 408
    assert all(got[i] == story("apples") for i in range(5)) and got[5] == story("bees")
    assert got[10] == f"{story('figs')}\n\nDate 0"
    assert all(got[100 + i] == story(f"no. {i}") for i in range(400))


def test_intermediate_tables_have_few_files(spark):
    """Small tables of many partitions are put together; rows stay as they are."""
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        most = 4 * spark.sparkContext.defaultParallelism
        pairs = components(spark.createDataFrame([(2 * i, 2 * i + 1) for i in range(400)], "u long, v long"))
        assert 1 <= len(pairs.inputFiles()) <= most < 61
        assert {tuple(r) for r in pairs.collect()} == {(i, i - i % 2) for i in range(800)}
        words = [" ".join(f"w{i // 2}x{j}" for j in range(40)) for i in range(400)]
        spans = substring.repeated_spans(spark.createDataFrame(list(enumerate(words)), "doc_id long, text string"))
        assert 1 <= len(spans.inputFiles()) <= most
        assert {r.doc_id for r in spans.collect()} == set(range(400))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_narrow_stages_have_few_files(spark):
    """Two partitions a core at most for a small table, the figures of texts and the first two stages of the pipeline included."""
    import corpus_pipeline
    from longloom.llm import quality
    from longloom.llm._shared import few_files

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(61)
    most = 2 * spark.sparkContext.defaultParallelism
    assert few_files(docs).rdd.getNumPartitions() == most < 61
    assert len(quality.measured(docs).inputFiles()) <= most
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.quality_classifier):
        assert stage(spark, docs, sf).rdd.getNumPartitions() <= most
