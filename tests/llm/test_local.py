"""Parts that need no session, against plain versions."""

import random

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from longloom.llm import _words, bpe, embeddings, html, minhash, packing, quality, rules, substring, token_counts, toxicity


def data(text):
    return np.frombuffer(text.encode(), np.uint8)


WORDS = st.lists(st.sampled_from(["a", "b", "the", "Éa", "中文", "x" * 40]), max_size=40)
SPACE = st.sampled_from([" ", "\n", "\t ", "\x0b", "\r\n"])


@settings(max_examples=100, deadline=None)
@given(WORDS, SPACE)
def test_equal_words_have_equal_fingerprints(words, space):
    h = _words.word_hashes(data(space.join(words)))
    assert len(h) == len(words)
    assert len(set(h.tolist())) == len(set(words))
    for n in (1, 3):
        got = _words.all_windows(h, n).tolist()
        want = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        assert len(got) == max(len(want), 0) and len(set(got)) == len(set(want))


def test_long_texts_go_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)) + " " + "z" * 3000
    whole = _words.word_hashes(data(text))
    monkeypatch.setattr(_words, "_CHUNK", 512)
    assert (_words.word_hashes(data(text)) == whole).all()


RANKS = bpe.load_ranks(public.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = bpe.TextEncoder(RANKS, public.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\tabcdetions'éüñ中!$19"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_encoding_equals_the_library(text):
    ids = ENCODER.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == THEIRS.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


def test_compatible_pairs_equal_plain_merging():
    rng, seen = random.Random(3), set()
    for round_ in range(120):
        tokens = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        base = len(tokens)
        for _ in range(rng.randint(3, 25)):
            new = rng.choice(tokens) + rng.choice(tokens)
            if new not in tokens and len(new) < 12:
                tokens.append(new)
        if round_ % 3 == 0:
            rng.shuffle(tokens)  # ranks in no order of merges
        ranks = {t: i for i, t in enumerate(tokens)}
        own = bpe.BacktrackBPE(ranks, most_pairs=rng.choice([5, 1000]))
        seen.add(own.ordered)
        built = [i for t, i in ranks.items() if own.merge(t) == [i]]
        for left in built:
            for right in built:
                assert own.compatible(left, right) == (own.merge(own.tokens[left] + own.tokens[right]) == [left, right])
        if own.ordered:
            for _ in range(60):
                word = bytes(rng.choice(b"abc"[:base]) for _ in range(rng.randint(1, 30)))
                if word not in ranks:
                    assert own.encode_word(word) == own.merge(word)
    assert seen == {True, False}


def test_words_are_encoded_without_plain_merges(monkeypatch):
    own = bpe.BacktrackBPE(RANKS)
    monkeypatch.setattr(own, "merge", None)
    for word in (" thwh", " tothndansh", " 4034987183468263", "Ntly", "\u4e2d\u00e9\u00fc\u00f1", "z" * 300):
        assert own.encode_word(word.encode()) == THEIRS.encode_ordinary(word)


def test_tasks_of_a_worker_share_one_encoder():
    path = public.path("byte_bpe_multi_50k.tiktoken")
    assert bpe._encoder(path, public.PATTERN) is bpe._encoder(path, public.PATTERN)


def test_trie_counts_equal_a_plain_viterbi():
    scores = {b"a": -1.0, b"b": -1.5, b"ab": -2.0, b"ba": -2.6, b"aba": -2.5, b"c": -3.0}
    trie = token_counts.TokenTrie(scores, most_nodes=50)
    rng = random.Random(1)
    for _ in range(300):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12)))
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(best[s][0] + scores[word[s:end]], -best[s][1] - 1) for s in range(end) if word[s:end] in scores]
            score, n = max(options)
            best.append((score, -n))
        assert trie.count(word) == best[-1][1]


def test_sum_of_squares_choice_is_the_best():
    levels = packing.Levels(16)
    rng, counts, names = random.Random(2), [0] * 16, iter(range(10_000))
    for _ in range(400):
        size = rng.randint(1, 15)

        def after(level, size=size):
            c = list(counts)
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return sum(x * x for x in c)

        options = [0] + [h for h in range(1, 17 - size) if counts[h]]
        level = levels.choose(size)
        assert level in options and after(level) == min(map(after, options))
        levels.place(size, lambda: next(names))
        if level:
            counts[level] -= 1
        if level + size < 16:
            counts[level + size] += 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_packing_keeps_every_token_once(lengths):
    pieces = list(packing.pack_partition(iter(enumerate(lengths)), 0, window=32))
    for doc, n in enumerate(lengths):
        at = 0
        for _, start, size, *_ in sorted(p for p in pieces if p[0] == doc):
            assert start == at
            at += size
        assert at == n
    sequences = {}
    for _, _, size, sequence, offset in pieces:
        sequences.setdefault(sequence, []).append((offset, size))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 32 or at < 32 and at & (at - 1) == 0


def test_packing_recuts_only_the_emptiest_windows():
    lengths = [20] * 16  # sixteen windows with a gap of 12 each
    pieces = list(packing.pack_partition(iter(enumerate(lengths)), 0, window=32))
    assert sum(size == 20 for _, _, size, *_ in pieces) >= 10
    sizes = {}
    for _, _, size, sequence, _ in pieces:
        sizes[sequence] = sizes.get(sequence, 0) + size
    assert sum(sizes.values()) == 320 and sorted(sizes.values())[0] == 32


def test_word_ids_equal_the_tokenizer():
    w = packing.WordIds(public.path("word_bpe_49k.json"), most=10)
    odd = ["", "a\x1cb", "Straße ΣΑΣ", "é x́", "don't CAN'T", "x y　z", "<|endoftext|> hi", "½a", "  a\t\tc\r\n", "ﬁ İx", "😀😀 a😀", "end.", "(see)", "\x00"]
    odd += ["<|ENDOFTEXT|> A", "J\u030c. J\u030cx", "e\u0301te\u0301 E\u0301.", "ΟΔΟΣ, ΣΑΣ'S I\u0307 İ.", "Ǆ Ⓐ 🅰b", "\u0301 \u0301a"]
    plain = [np.array(e.ids, "<u4").tobytes() for e in w.tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert w.encode(odd) == plain == w.encode(odd)


def test_rules_measure_and_order():
    t = rules.Text(data("a b c a b c\nx\n\nx\n## é"))
    assert (t.n_words, t.word_chars, t.n_symbols, t.lines, t.n_repeat_words) == (10, 11, 2, (4, 1), 6)
    empty = rules.Text(np.zeros(0, np.uint8))
    assert (empty.n_words, empty.n_repeat_words, empty.lines) == (0, 0, (0, 0)) and rules.few_words(empty)
    order = rules.ordered(rules.RULES, [(r.name, 1e-6 * (i + 1), 0.5) for i, r in enumerate(rules.RULES)])
    assert [r.name for r in order] == [r.name for r in rules.RULES]
    assert rules.estimate([], rules.OWN)[0][2] == 0


def test_non_negative_risk_learns_from_positives_and_a_mixture():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 0.5, (3000, 2)), rng.normal(-1, 0.5, (1000, 2))
    mixed = np.vstack([good[1000:], bad])
    model = quality.fit(good[:1000], mixed, bad[:0])
    assert abs(model.prior - 2 / 3) < 0.06
    assert model.score(good[:500]).mean() > 0.85 and model.score(bad[:500]).mean() < 0.2
    nothing = quality.fit(good[:0], mixed, bad[:0])
    assert (nothing.score(mixed) == 0.5).all()
    assert quality.figures(np.zeros(0, np.uint8)) == [0.0] * len(quality.FIGURES)


def test_compression_distance_tells_marked_texts():
    rng = random.Random(3)
    plain = [" ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(60)) for _ in range(300)]
    marked = [t.replace(" ", f" {rng.choice(['worthless', 'pathetic'])} ", 2) for t in plain[:150]]
    model = toxicity.fit(marked[:100], plain[150:250])
    d, w = toxicity.Distance(model), np.array(model.weights)
    score = lambda t: float(d.figures(t) @ w[1:] + w[0])
    assert np.mean([score(t) > 0 for t in marked[100:]]) > 0.9
    assert np.mean([score(t) > 0 for t in plain[250:]]) < 0.1
    assert toxicity.fit([], plain).weights[0] < -10 and (d.figures("") == 0).all()


def test_signature_is_the_smallest_shifted_rank():
    m = minhash.Circulant(4, 3, seed=1)
    found = np.array([5, 77, 12345678901], np.uint64)
    places = ((found * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(int)
    ranks = np.random.default_rng(1).permutation(minhash.D)
    assert m.signature(found).tolist() == [min(ranks[(p + k) % minhash.D] for p in places) for k in range(12)]


def test_anchors_are_the_minima_of_windows():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2**63, 200, dtype=np.uint64)
    at, found = substring.anchors(words, 12, 4)
    v = _words.all_windows(words, 4)
    want = {i for s in range(len(words) - 11) for i in range(s, s + 9) if v[i] == v[s : s + 9].min()}
    assert set(at.tolist()) == want and (v[at] == found).all()
    assert not len(substring.anchors(words[:11], 12, 4)[0])


def test_tables_reach_the_recall_asked_for():
    for n in (10, 10_000, 10_000_000):
        tables, bits = embeddings.tables_for(n, 0.95, 0.002)
        same = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - same) ** tables <= 0.002 and 2**bits * 8 >= min(n, 2**60)


def test_html_blocks():
    page = (
        "<html><head><title>T</title><script>var x='<p>no</p>'</script></head><body><header>Site</header><nav><a>Menu</a></nav>"
        "<div class='cookie-banner'>ok?</div><main><article><h1>Head &amp; more</h1><p>One<br>two &nbsp;three<p>Four <b>bold</article>"
        "<section id=comments><p>nice</p></section></main><aside>side</aside><form>f</form><footer>end"
    )
    assert [t for t, _ in html.blocks(page)] == ["Head & more", "One two three", "Four bold"]
    assert html.blocks("") == [] and html.blocks("plain < text") == [("plain < text", False)]
    assert [t for t, _ in html.blocks("<nav>menu<article><p>x</p></article>")] == ["x"]


def test_html_names_are_read_on_containers_and_closely():
    page = (
        "<article><h2 id='social-security'>Social</h2><section id='related-work'><p class='notice'>Prior <span class='ad'>art</span></p></section>"
        "<h2 id='hidden-costs'>Costs</h2><svg viewBox='0 0 1 1'/><p>Seen<math/> too</p><svg><path/>drawn</svg><p>End</p></article>"
        "<div class='related-posts'>more</div><ul class='share'><li>share</ul><section id='comment-list-2'>nice</section><div class='x adSlot'>buy</div>"
    )
    assert [t for t, _ in html.blocks(page)] == ["Social", "Prior art", "Costs", "Seen too", "End"]


def test_differencing_drops_what_neighbours_share():
    own = [("Menu", False), ("Text of a", False), ("Foot", False)]
    other = [("Menu", False), ("Text of b", False), ("Foot", False)]
    assert html.main_text(own, [other]) == "Text of a"
    assert html.main_text(own, [own]) == "Menu\n\nText of a\n\nFoot"  # a copy is no evidence
    inside = [("Shared", True)]
    assert html.main_text(inside, [inside, [("Shared", True), ("more", True)]]) == "Shared"


def test_differencing_judges_blocks_outside_and_inside_an_article():
    page = "<body><div>Home of the site</div><div>Lead of {0}, which says a lot</div><article><p>Share this story</p><p>Body of {0} and its long text</p></article></body>"
    a, b, c = (html.blocks(page.format(x)) for x in ("apples", "bees", "cedars"))
    assert html.main_text(a, []) == "Home of the site\n\nLead of apples, which says a lot\n\nShare this story\n\nBody of apples and its long text"
    assert html.main_text(a, [b]) == "Lead of apples, which says a lot\n\nShare this story\n\nBody of apples and its long text"
    assert html.main_text(a, [b, c]) == "Lead of apples, which says a lot\n\nBody of apples and its long text"
    assert html.main_text(a, [b, b]) == html.main_text(a, [b])  # copies of one neighbour count once
    dated = [*a[:3], ("1 May", True), a[3]]
    assert html.main_text(a, [dated]) == html.main_text(a, [])  # the same article with a date


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=10), st.lists(st.sampled_from("abcd"), max_size=10))
def test_common_lines_are_a_longest_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    found = sorted(html.common_lines(a, b))
    assert len(found) == table[-1][-1]
    at = 0
    for i in found:
        at = b.index(a[i], at) + 1


def test_unknown_byte_is_an_error():
    with pytest.raises(ValueError):
        bpe.BacktrackBPE({b"a": 0}).encode_word(b"ab")


def test_intersection_sizes_by_products():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64) << np.uint64(50)) for n in (0, 1, 30, 30, 80, 12)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = minhash.intersections(sets, columns=7)
    assert all(got[i][j] == want[i][j] for i in range(6) for j in range(6) if i != j)


def test_signatures_of_unrelated_long_texts_seldom_agree():
    m = minhash.Circulant(36, 7, places=1 << minhash.PLACE_BITS)
    rng = np.random.default_rng(9)
    a, b = (m.signature(rng.integers(0, 1 << 63, 1_000_000).astype(np.uint64)) for _ in range(2))
    assert (a == b).mean() < 0.25


def test_the_cascade_counts_what_is_left():
    """A rule that rejects only what a cheaper one has rejected comes last, however much that is."""
    slow = lambda t: sum(range(3000)) > 0 and t.n_words < 3
    few = lambda t: sum(range(9000)) > 0 and b"z" in t.data.tobytes()
    mine = (rules.Rule("all", lambda t: t.n_words < 4), rules.Rule("inside", slow), rules.Rule("few", few))
    sample = [b"a b"] * 80 + [b"a b c d z"] * 5 + [b"a b c d e"] * 15
    assert [r.name for r in rules.chained(mine, sample)] == ["all", "few", "inside"]


def _batches(texts, rows=10_000):
    import pyarrow as pa

    return iter(pa.RecordBatch.from_arrays([pa.array(range(len(texts[i : i + rows])), pa.int64()), pa.array(texts[i : i + rows], pa.string())], ["doc_id", "text"]) for i in range(0, len(texts), rows))


def test_pieces_are_whole_and_bounded():
    texts = ["a" * 30, None, "", "b" * 500, "é" * 20, *["c"] * 7]
    got = list(_words.pieces(_batches(texts, 9), "text", 60))
    assert [t for p in got for t in p.column("text").to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("text").to_pylist()) <= 60 for p in got)


def test_anchors_of_a_large_batch_come_in_parts():
    """What a worker of the substring step holds does not grow with its Arrow batch."""
    texts = [" ".join(random.Random(i).choices("abcdefghij", k=5000)) for i in range(1000)]
    got = list(substring._anchor_rows(_batches(texts), 35, 8))
    assert len(got) > 1 and max(b.num_rows for b in got) < sum(b.num_rows for b in got) / 2
    assert [i for b in got for i in dict.fromkeys(b.column("doc_id").to_pylist())] == list(range(1000))


def test_packing_leaves_no_table_behind(monkeypatch):
    """A pipeline's workers keep no word ids once a task is done; the pieces are the same."""
    import pyspark

    class Context:
        @staticmethod
        def get():
            return Context

        partitionId = staticmethod(lambda: 3)  # noqa: N815

    monkeypatch.setattr(pyspark, "TaskContext", Context)
    path = public.path("word_bpe_49k.json")
    texts = [" ".join(f"w{i}{j}" for j in range(40 + 97 * i % 300)) for i in range(50)] + [None, ""]
    rows = lambda size, keep: [r for b in packing._token_pieces(_batches(texts, 20), path, 128, size, keep) for r in b.to_pylist()]
    kept = rows(4_000_000, True)
    assert packing._word_ids(path).chunks
    assert rows(500, False) == kept and not packing._word_ids(path).chunks
