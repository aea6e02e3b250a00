"""Filters, joins, aggregates, sets and graphs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import hashed, median_text, pick, rounded_mean
from ..functions.text import lines, token_count
from ..operators import graph, neighbors, rows, segment
from ..sources import corpus as source
from . import views
from .registry import ORACLE_SQL, query
from .views import ALL_EDGES, CORPUS, EDGES, RECORDS, VECTORS, WORDS, pick_sql, table

_REASON = """CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN token_count < 200 THEN 'short'
  WHEN minhash_cluster_size > 1 THEN 'dup' WHEN coalesce(quality, 0) < 0.75 THEN 'lowedu' ELSE 'kept' END"""


# Corpus ----------------------------------------------------------------------


@query("drop_reasons", f"WITH {CORPUS} SELECT {_REASON} AS reason, count(*) AS n FROM v_corpus GROUP BY 1")
def drop_reasons(spark, sf):
    return source.reason_counts(views.corpus(spark, sf))


@query(
    "quality_filter",
    f"WITH {CORPUS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(token_count AS BIGINT) AS n_tokens FROM v_corpus WHERE {_REASON} = 'kept'",
)
def quality_filter(spark, sf):
    return source.filtered(views.corpus(spark, sf)).select("doc_id", "n_tokens")


@query(
    "token_count",
    "SELECT doc_id, CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) AS BIGINT) AS n_tokens FROM documents",
)
def token_counts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", token_count(F.col("text")).alias("n_tokens"))


@query("char_clip", "SELECT doc_id, substr(text, 1, 100) AS text, CAST(length(substr(text, 1, 100)) AS BIGINT) AS n FROM documents")
def char_clip(spark, sf):
    clip = F.substring("text", 1, 100)
    return table(spark, sf, "documents").select("doc_id", clip.alias("text"), F.length(clip).cast("long").alias("n"))


@query("first_docs", "SELECT doc_id FROM documents WHERE n_chars >= 2000 ORDER BY doc_id LIMIT 25")
def first_docs(spark, sf):
    """max_docs: the first survivors in order."""
    return table(spark, sf, "documents").where("n_chars >= 2000").orderBy("doc_id").limit(25).select("doc_id")


@query(
    "filtered_clip",
    f"WITH {CORPUS} SELECT CAST(doc_id AS VARCHAR) AS doc_id, substr(text, 1, 120) AS text FROM v_corpus WHERE {_REASON} = 'kept'",
)
def filtered_clip(spark, sf):
    """The corpus reader's own cap on characters."""
    return source.filtered(views.corpus(spark, sf), source.Filters(char_cap=120)).select("doc_id", "text")


@query(
    "filtered_first",
    f"WITH {CORPUS} SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM (SELECT doc_id FROM v_corpus WHERE {_REASON} = 'kept' ORDER BY doc_id LIMIT 25)",
)
def filtered_first(spark, sf):
    """The corpus reader's own cap on documents: the first survivors in file order."""
    return source.filtered(views.corpus(spark, sf), source.Filters(max_docs=25)).select("doc_id")


@query(
    "rounded_means",
    f"WITH {RECORDS} SELECT category, round(avg(value), 2) AS mean FROM v_records GROUP BY category",
)
def rounded_means(spark, sf):
    found = views.records(spark, sf).groupBy("category").agg(F.sum("value").alias("total"), F.count("*").alias("n"))
    return found.select("category", rounded_mean(F.col("total"), F.col("n")).alias("mean"))


@query(
    "median_texts",
    f"""WITH {RECORDS}, p AS (SELECT CAST(split_part(name, '-', 1) AS BIGINT) AS list, value FROM v_records)
SELECT list, CASE WHEN count(*) % 2 = 1 THEN CAST(CAST(median(value) AS BIGINT) AS VARCHAR) ELSE CAST(CAST(median(value) AS DOUBLE) AS VARCHAR) END AS median FROM p GROUP BY list""",
)
def median_texts(spark, sf):
    """Medians as text of many short lists: the records of each order."""
    parts = views.records(spark, sf).select(F.split("name", "-")[0].cast("long").alias("list"), "value")
    return parts.groupBy("list").agg(median_text(F.collect_list("value")).alias("median"))


@query(
    "length_window",
    f"""WITH {CORPUS} SELECT CASE WHEN token_count < 400 THEN 'short' WHEN token_count > 2048 - 512 THEN 'long' ELSE 'kept' END AS reason,
    count(*) AS n FROM v_corpus GROUP BY 1""",
)
def length_window(spark, sf):
    docs = views.corpus(spark, sf).withColumnRenamed("token_count", "n_tokens")
    return source.within_limit(docs, 400, 2048, 512)[1]


# Joins -----------------------------------------------------------------------


@query("id_semi", "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def id_semi(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_semi").select("doc_id", "n_chars")


@query("id_anti", "SELECT doc_id, n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def id_anti(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id", "n_chars")


@query("member_inner", "SELECT d.doc_id, n_chars, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def member_inner(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "n_chars", "quality")


@query("doc_left", "SELECT d.doc_id, coalesce(quality, -1) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def doc_left(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("text_by_id", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def text_by_id(spark, sf):
    needed = table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("doc_id"))
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("doc_id").alias("position"))
    return source.texts_by_id(docs, needed)


# Records ---------------------------------------------------------------------


@query("pred_gt", f"WITH {RECORDS} SELECT count(*) AS n FROM v_records WHERE value > 30")
def pred_gt(spark, sf):
    return rows.count_where(views.records(spark, sf), F.col("value") > 30)


@query("pred_lt", f"WITH {RECORDS} SELECT count(*) AS n FROM v_records WHERE value < 12")
def pred_lt(spark, sf):
    return rows.count_where(views.records(spark, sf), F.col("value") < 12)


@query("pred_eq", f"WITH {RECORDS} SELECT count(*) AS n FROM v_records WHERE category = 'R'")
def pred_eq(spark, sf):
    return rows.count_where(views.records(spark, sf), F.col("category") == "R")


@query("pred_between", f"WITH {RECORDS} SELECT count(*) AS n FROM v_records WHERE value BETWEEN 10 AND 25")
def pred_between(spark, sf):
    return rows.count_where(views.records(spark, sf), F.col("value").between(10, 25))


@query("tally", f"WITH {RECORDS} SELECT category, count(*) AS n FROM v_records GROUP BY category")
def tally(spark, sf):
    return rows.tally(views.records(spark, sf))


@query("group_sum", f"WITH {RECORDS} SELECT category, CAST(sum(value) AS BIGINT) AS total FROM v_records GROUP BY category")
def group_sum(spark, sf):
    return rows.sums(views.records(spark, sf))


def _numeric(name: str, spark_sql: str, sql: str) -> None:
    @query(name, f"WITH {RECORDS} SELECT {sql} AS result FROM v_records")
    def run(spark, sf):
        return views.records(spark, sf).agg(F.expr(spark_sql).alias("result"))


_numeric("num_sum", "sum(value)", "CAST(sum(value) AS BIGINT)")
_numeric("num_min", "min(value)", "min(value)")
_numeric("num_max", "max(value)", "max(value)")
_numeric("num_mean", "avg(value)", "avg(value)")
_numeric("num_median", "median(value)", "median(value)")


@query(
    "record_lines",
    f"""WITH {RECORDS} SELECT CAST(row_number() OVER (ORDER BY name) AS INT) AS line, name FROM v_records WHERE value = 50""",
)
def record_lines(spark, sf):
    return rows.numbered(views.records(spark, sf).where("value = 50").select("name"), "name").select("line", "name")


# Words -----------------------------------------------------------------------


@query("distinct_words", f"WITH {WORDS} SELECT count(DISTINCT word) AS n FROM v_words")
def distinct_words(spark, sf):
    return views.word_stream(spark, sf).agg(F.countDistinct("word").alias("n"))


@query("word_occurrences", f"WITH {WORDS} SELECT count(*) AS n FROM v_words WHERE word = 'the'")
def word_occurrences(spark, sf):
    return rows.count_where(views.word_stream(spark, sf), F.col("word") == "the")


_TOP = """SELECT word, count(*) AS n, min(struct_pack(a := doc_id, b := pos)) AS first FROM v_words {where} GROUP BY word"""


@query("top_k_words", f"WITH {WORDS}, t AS ({_TOP.format(where='')}) SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, first) AS INT) AS rank FROM t ORDER BY n DESC, first LIMIT 5")
def top_k_words(spark, sf):
    return rows.top_words(views.word_stream(spark, sf), 5)


@query(
    "freq_no_noise",
    f"WITH {WORDS}, t AS ({_TOP.format(where=chr(10) + ' WHERE word <> ' + chr(39) + 'the' + chr(39))}) SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, first) AS INT) AS rank FROM t ORDER BY n DESC, first LIMIT 3",
)
def freq_no_noise(spark, sf):
    return rows.top_words(views.word_stream(spark, sf), 3, noise="the")


@query(
    "common_words",
    f"WITH {WORDS}, t AS ({_TOP.format(where='')}) SELECT string_agg(word, ',' ORDER BY word) AS words FROM (SELECT word FROM t ORDER BY n DESC, first LIMIT 10)",
)
def common_words(spark, sf):
    return rows.common_words(views.word_stream(spark, sf), 10)


@query("first_seen_words", f"WITH {WORDS} SELECT word, min(doc_id) AS doc_id FROM v_words GROUP BY word")
def first_seen_words(spark, sf):
    return rows.ordered_distinct(views.word_stream(spark, sf), "word", "doc_id")


_SETS = f"WITH {WORDS}, a AS (SELECT DISTINCT word FROM v_words WHERE doc_id % 10 < 5), b AS (SELECT DISTINCT word FROM v_words WHERE doc_id % 10 >= 3)"


def _vocabularies(spark, sf):
    words = views.word_stream(spark, sf)
    return rows.vocabulary(words, F.col("doc_id") % 10 < 5), rows.vocabulary(words, F.col("doc_id") % 10 >= 3)


@query("set_intersect", f"{_SETS} SELECT word FROM a INTERSECT SELECT word FROM b")
def set_intersect(spark, sf):
    a, b = _vocabularies(spark, sf)
    return a.intersect(b)


@query("set_union_size", f"{_SETS} SELECT count(*) AS n FROM (SELECT word FROM a UNION SELECT word FROM b)")
def set_union_size(spark, sf):
    a, b = _vocabularies(spark, sf)
    return a.union(b).distinct().agg(F.count("*").alias("n"))


@query("set_diff", f"{_SETS} SELECT word FROM a EXCEPT SELECT word FROM b")
def set_diff(spark, sf):
    a, b = _vocabularies(spark, sf)
    return a.exceptAll(b)


@query(
    "union_sources",
    "SELECT 0 AS ord, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE n_chars >= 4000 UNION ALL SELECT 1 AS ord, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE n_chars >= 8000",
)
def union_sources(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "n_chars")
    first = docs.where("n_chars >= 4000").select(F.lit(0).alias("ord"), "id")
    return first.unionByName(docs.where("n_chars >= 8000").select(F.lit(1).alias("ord"), "id"))


@query("zipf_counts", "SELECT CAST(r AS BIGINT) AS rank, CAST(floor(5000.0 * pow(r, -1.5) / 2.612375348685488) AS BIGINT) AS n FROM range(1, 251) t(r)")
def zipf_counts(spark, sf):
    return rows.zipf_counts(spark.range(1, 251).withColumnRenamed("id", "rank"), 5000)


# Graphs ----------------------------------------------------------------------

_START = "start AS (SELECT min(u) AS s FROM v_edges)"
_REACH = f"""WITH RECURSIVE {EDGES}, {_START},
r(node) AS (SELECT v FROM v_edges, start WHERE u = s UNION SELECT v FROM r JOIN v_edges ON u = node)"""
_DEPTH = f"""WITH RECURSIVE {EDGES}, {_START},
r(node, depth) AS (SELECT s, 0 FROM start UNION SELECT v, depth + 1 FROM r JOIN v_edges ON u = node WHERE depth < 20),
d AS (SELECT node, min(depth) AS depth FROM r GROUP BY node)"""


def _start(edges):
    return edges.agg(F.min("u").alias("node"))


@query("graph_children", f"WITH {EDGES}, {_START} SELECT v AS node FROM v_edges, start WHERE u = s")
def graph_children(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return e.join(_start(e).withColumnRenamed("node", "u"), "u", "left_semi").select(F.col("v").alias("node"))


@query("graph_parents", f"WITH {EDGES}, {_START} SELECT u AS node FROM v_edges, start WHERE v = s")
def graph_parents(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return e.join(_start(e).withColumnRenamed("node", "v"), "v", "left_semi").select(F.col("u").alias("node"))


@query("graph_bfs", f"{_DEPTH} SELECT node FROM d WHERE depth = 3")
def graph_bfs(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return graph.layer(e, _start(e), 3).select("node")


@query("graph_desc", f"{_REACH} SELECT node FROM r, start WHERE node <> s")
def graph_desc(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return graph.reachable(e, _start(e)).select("node")


@query(
    "graph_anc",
    f"""WITH RECURSIVE {EDGES}, {_START},
r(node) AS (SELECT u FROM v_edges, start WHERE v = s UNION SELECT u FROM r JOIN v_edges ON v = node) SELECT node FROM r, start WHERE node <> s""",
)
def graph_anc(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return graph.reachable(graph.reversed_edges(e), _start(e)).select("node")


@query("graph_sp", f"{_DEPTH} SELECT s AS src, node AS dst, depth AS length FROM d, start WHERE node = (SELECT max(v) FROM v_edges)")
def graph_sp(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return graph.shortest_path(e, e.agg(F.min("u").alias("src"), F.max("v").alias("dst")))


@query("graph_reach", f"{_REACH} SELECT CASE WHEN count(*) > 0 THEN 'Yes' ELSE 'No' END AS answer FROM r WHERE node = (SELECT max(v) FROM v_edges)")
def graph_reach(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    found = graph.reachable(e, _start(e)).join(e.agg(F.max("v").alias("node")), "node")
    return found.agg(F.when(F.count("*") > 0, "Yes").otherwise("No").alias("answer"))


_CYCLE = """r(a, b) AS (SELECT u, v FROM e UNION SELECT a, v FROM r JOIN e ON u = b)
SELECT count(*) > 0 AS has_cycle FROM r WHERE a = b"""


@query("graph_cycle", f"WITH RECURSIVE {EDGES}, e AS (SELECT u, v FROM v_edges), {_CYCLE}")
def graph_cycle(spark, sf, edges=views.edges):
    return graph.has_cycle(edges(spark, sf))


@query("graph_cycle_dag", f"WITH RECURSIVE {EDGES}, e AS (SELECT u, v FROM v_edges WHERE u < v), {_CYCLE}")
def graph_cycle_dag(spark, sf, edges=views.edges):
    return graph.has_cycle(edges(spark, sf).where("u < v"))


@query(
    "graph_component",
    f"""WITH RECURSIVE {EDGES}, {_START}, e AS (SELECT u, v FROM v_edges UNION SELECT v, u FROM v_edges),
r(node) AS (SELECT s FROM start UNION SELECT v FROM r JOIN e ON u = node) SELECT count(*) AS n FROM r""",
)
def graph_component(spark, sf, edges=views.edges):
    e = edges(spark, sf)
    return graph.weak_component(e, _start(e)).agg(F.count("*").alias("n"))


@query(
    "graph_maxdeg",
    f"""WITH {EDGES}, d AS (SELECT node, count(*) AS degree FROM (SELECT u AS node FROM v_edges UNION ALL SELECT v FROM v_edges) GROUP BY node)
SELECT node, degree FROM d WHERE degree = (SELECT max(degree) FROM d)""",
)
def graph_maxdeg(spark, sf, edges=views.edges):
    return graph.max_degree(edges(spark, sf))


@query(
    "graph_degrees",
    f"""WITH {EDGES}, x AS (SELECT u AS node, 1 AS o, 0 AS i FROM v_edges UNION ALL SELECT v, 0, 1 FROM v_edges)
SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, count(*) AS degree FROM x GROUP BY node""",
)
def graph_degrees(spark, sf, edges=views.edges):
    return graph.degrees(edges(spark, sf))


def _over_all_edges(f):
    sql = ORACLE_SQL[f.__name__].replace(EDGES, ALL_EDGES)

    @query(f.__name__.replace("graph_", "graph_all_"), sql)
    def build(spark, sf):
        return f(spark, sf, views.all_edges)


for _f in (
    graph_children, graph_parents, graph_bfs, graph_desc, graph_anc, graph_sp, graph_reach, graph_cycle, graph_cycle_dag, graph_component,
    graph_maxdeg, graph_degrees,
):
    _over_all_edges(_f)


# Chains of variables ---------------------------------------------------------

_CHAINS = f"""chains AS (
  SELECT c, h, md5('var:' || c || ':' || h) AS name, CASE {pick_sql(3, "'op:' || c || ':' || h")} WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '*' END AS op,
    1 + {pick_sql(9, "'c:' || c || ':' || h")} AS k
  FROM range(200) a(c), range(5) b(h)
)"""


def _chains(spark):
    pairs = spark.range(200).select(F.col("id").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("h"))
    return pairs.select(
        "c", "h", hashed("var", F.col("c"), F.col("h")).alias("name"),
        F.element_at(F.array(F.lit("+"), F.lit("-"), F.lit("*")), (pick(3, "op", F.col("c"), F.col("h")) + 1).cast("int")).alias("op"),
        (pick(9, "c", F.col("c"), F.col("h")) + 1).alias("k"),
    )


@query(
    "var_closure",
    f"""WITH RECURSIVE {_CHAINS}, copies AS (SELECT a.name AS dst, b.name AS src FROM chains a JOIN chains b ON a.c = b.c AND a.h = b.h + 1),
r(root, name) AS (SELECT c, name FROM chains WHERE h = 0 UNION SELECT root, dst FROM r JOIN copies ON src = name)
SELECT CAST(root AS BIGINT) AS root, name FROM r""",
)
def var_closure(spark, sf):
    """Names that a value reaches through copies, however long a chain is."""
    chains = _chains(spark)
    later = chains.select("c", (F.col("h") - 1).alias("h"), F.col("name").alias("v"))
    copies = chains.select("c", "h", F.col("name").alias("u")).join(later, ["c", "h"]).select("u", "v")
    first = chains.where("h = 0").select(F.col("c").alias("root"), F.col("name").alias("start"))
    found = graph.bfs(copies, first.select(F.col("start").alias("node"))).select("start", F.col("node").alias("name"))
    return found.join(first, "start").select("root", "name")


@query(
    "var_arith",
    f"""WITH RECURSIVE {_CHAINS}, r(c, h, value) AS (
  SELECT c, 0, 1 + {pick_sql(20, "'start:' || c")} FROM range(200) a(c)
  UNION ALL
  SELECT r.c, r.h + 1, CASE op WHEN '+' THEN value + k WHEN '-' THEN value - k ELSE value * k END
  FROM r JOIN chains x ON x.c = r.c AND x.h = r.h + 1
) SELECT CAST(c AS BIGINT) AS c, CAST(value AS BIGINT) AS value FROM r WHERE h = 4""",
)
def var_arith(spark, sf):
    """The last value of a chain of assignments, folded in order."""
    steps = _chains(spark).where("h > 0").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("h", "op", "k"))).alias("steps"))

    def step(acc, s):
        return F.when(s["op"] == "+", acc + s["k"]).when(s["op"] == "-", acc - s["k"]).otherwise(acc * s["k"])

    return steps.select("c", F.aggregate("steps", pick(20, "start", F.col("c")) + 1, step).alias("value"))


# Segments --------------------------------------------------------------------


@query(
    "word_chunks",
    """WITH w AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws FROM documents))
SELECT doc_id, CAST(pos // 128 AS INT) AS chunk, string_agg(word, ' ' ORDER BY pos) AS text FROM w GROUP BY doc_id, pos // 128
HAVING len(regexp_extract_all(string_agg(word, ' ' ORDER BY pos), '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) >= 32""",
)
def word_chunks(spark, sf):
    chunks = segment.word_windows(F.col("text"), 128)
    found = table(spark, sf, "documents").select("doc_id", F.posexplode(chunks).alias("chunk", "text"))
    return found.where(token_count(F.col("text")) >= 32)


_LINES = """l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS ls FROM documents)),
u AS (SELECT doc_id, pos, line, len(regexp_extract_all(line, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]')) AS n FROM l)"""


@query("line_units", f"WITH {_LINES} SELECT doc_id, CAST(pos AS INT) AS pos, CAST(n AS BIGINT) AS n_tok FROM u")
def line_units(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    return found.select("doc_id", "pos", token_count(F.col("line")).alias("n_tok"))


@query(
    "running_span",
    f"""WITH {_LINES}, r AS (SELECT doc_id, pos, sum(n + 3) OVER (PARTITION BY doc_id ORDER BY pos DESC) AS back FROM u),
s AS (SELECT doc_id, max(pos) FILTER (WHERE back > 300) AS last FROM r GROUP BY doc_id),
t AS (SELECT u.doc_id, pos, n, CASE WHEN last IS NULL THEN 0 ELSE CAST('0x' || substr(md5('7:' || u.doc_id || ':start'), 1, 8) AS BIGINT) % (last + 1) END AS start
  FROM u JOIN s USING (doc_id)),
f AS (SELECT doc_id, pos, start, sum(n + 3) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM t WHERE pos >= start)
SELECT doc_id, CAST(min(pos) AS INT) AS first, count(*) AS n_units FROM f WHERE run <= 300 OR pos = start GROUP BY doc_id""",
)
def running_span(spark, sf):
    span = segment.take_span(line_units(spark, sf), 300, 7, source="doc_id")
    return span.groupBy("doc_id").agg(F.min("pos").alias("first"), F.count("*").alias("n_units"))


@query(
    "packed_passages",
    f"""WITH RECURSIVE {_LINES}, p(doc_id, pos, pack, held) AS (
  SELECT doc_id, pos, 0, n FROM u WHERE pos = 0
  UNION ALL
  SELECT u.doc_id, u.pos, CASE WHEN held > 0 AND held + n > 64 THEN pack + 1 ELSE pack END, CASE WHEN held > 0 AND held + n > 64 THEN n ELSE held + n END
  FROM p JOIN u ON u.doc_id = p.doc_id AND u.pos = p.pos + 1
)
SELECT doc_id, CAST(pack AS INT) AS pack, CAST(max(held) AS BIGINT) AS n_tok FROM p GROUP BY doc_id, pack""",
)
def packed_passages(spark, sf):
    packs = segment.packed(lines(F.col("text")), 64, joiner="\n")
    found = table(spark, sf, "documents").select("doc_id", F.posexplode(packs).alias("pack", "p"))
    return found.select("doc_id", "pack", F.col("p.n_tok").alias("n_tok"))


# Neighbours and bundles ------------------------------------------------------

_KNN = """n AS (SELECT a.vec_id AS i, b.vec_id AS j,
  list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
  / sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])))
  / sqrt(list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS sim
  FROM v_vec a JOIN v_vec b ON a.vec_id <> b.vec_id),
k AS (SELECT i, j, sim, row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS k_rank FROM n)"""


@query("knn_topk", f"WITH {VECTORS}, {_KNN} SELECT i, j, CAST(k_rank AS INT) AS k_rank, round(sim, 6) AS sim FROM k WHERE k_rank <= 5")
def knn_topk(spark, sf):
    found = neighbors.topk(views.vectors(spark, sf), 5)
    return found.select("i", "j", "k_rank", F.round("sim", 6).alias("sim"))


def _bundles(spark, sf):
    vec = views.vectors(spark, sf)
    near = neighbors.topk(vec, 8)
    return neighbors.bundle(near, vec.select(F.col("vec_id").alias("id"), F.col("n_tokens").cast("long")), 8000)


@query("bundle_chain")
def bundle_chain(spark, sf):
    return _bundles(spark, sf)


@query("bundle_stats")
def bundle_stats(spark, sf):
    return neighbors.bundle_summary(_bundles(spark, sf))


@query(
    "token_percentiles",
    f"""WITH {CORPUS} SELECT CAST(quantile_cont(token_count, 0.5) AS INT) AS p50, CAST(trunc(quantile_cont(token_count, 0.9)) AS INT) AS p90,
  max(token_count) AS max, CAST(sum(token_count) AS BIGINT) AS total FROM v_corpus""",
)
def token_percentiles(spark, sf):
    n = F.col("token_count")
    return views.corpus(spark, sf).agg(
        F.percentile(n, F.lit(0.5)).cast("int").alias("p50"), F.percentile(n, F.lit(0.9)).cast("int").alias("p90"),
        F.max(n).alias("max"), F.sum(n).alias("total"),
    )
