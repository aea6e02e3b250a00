"""The gold answer of every synthetic task beside SQL that draws the same samples and answers them on its own.

The SQL goes from the draws (hashes of seed, task, sample and slot) to the
answer by counting, sorting and recursion over rows; it shares no step with the
array expressions and graph operators that make the samples.
"""

from __future__ import annotations

from .generated import POOL_WORDS, SIZE, N, _samples
from .registry import query
from .synth import CATEGORIES, TASKS
from .views import WORDS, pick_sql

SEED = 42
S = f"s AS (SELECT sid FROM range({N}) t(sid))"
_CATS = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"


def _slot(name: str, *slots: str) -> str:
    """The key of a draw; a slot is an SQL expression of text or number."""
    return f"'{SEED}:{name}:' || sid" + "".join(f" || ':' || {s}" for s in slots)


def _drawn(n: str | int, name: str, *slots: str) -> str:
    return pick_sql(n, _slot(name, *slots))


def _word(name: str, n: int, slot: str, upper: bool) -> str:
    return " || ".join(f"chr(CAST({_drawn(26, name, *slot.split('|'), f"'letter{j}'")} AS INT) + {65 if upper else 97})" for j in range(n))


def _json_list(value: str, order: str) -> str:
    return f"""coalesce('[' || string_agg('"' || {value} || '"', ',' ORDER BY {order}) || ']', '[]')"""


def _records(name: str) -> str:
    cat = f"{_CATS}[{_drawn(len(CATEGORIES), name, "'cat'", 'i')} + 1]"
    return f"r AS (SELECT sid, i, {cat} AS cat, {_drawn(999, name, "'value'", 'i')} + 1 AS v FROM s, range({SIZE}) u(i))"


def _walk(name: str, n: str) -> str:
    """w(sid, i, word): ``n`` words of each sample's pool, walked round with a step that visits every word."""
    return f"""{WORDS}, vocabulary AS (SELECT DISTINCT word FROM v_words), {S},
pool AS (SELECT sid, word, row_number() OVER (PARTITION BY sid ORDER BY word) - 1 AS place FROM (
  SELECT sid, word, row_number() OVER (PARTITION BY sid ORDER BY md5('{SEED}:{name}:' || sid || ':pool:' || word), word) AS nth FROM vocabulary, s)
  WHERE nth <= {POOL_WORDS}),
sizes AS (SELECT sid, count(*) AS m FROM pool GROUP BY sid),
turns AS (SELECT sid, m, {_drawn('m', name, "'start'")} AS first, {_drawn('(m - 1)', name, "'step'")} + 1 AS step FROM sizes),
steps AS (SELECT sid, m, first, coalesce(min_by((step + j) % m, j) FILTER (gcd((step + j) % m, m) = 1), 1) AS step FROM turns, range(61) u(j) GROUP BY ALL),
w AS (SELECT sid, i, word FROM (SELECT sid, i, (first + i * step) % m AS place FROM steps, range({n}) u(i)) JOIN pool USING (sid, place))"""


def _graph(name: str, avg_deg: float = 2.5, acyclic: str = "false") -> str:
    """g(sid, u, v): the edges of each sample's graph by node names, and nodes(sid, node)."""
    n, target = max(6, SIZE), int(max(6, SIZE) * avg_deg)
    own = f"SELECT sid, i AS ord, i AS u, (i + 1 + {_drawn(n - 1, name, "'own'", 'i')}) % {n} AS v FROM s, range({n}) t(i)"
    more = f"SELECT sid, {n} + i, {_drawn(n, name, "'u'", 'i')}, {_drawn(n, name, "'v'", 'i')} FROM s, range({5 * target + 11}) t(i)"
    return f"""{S}, drawn AS ({own} UNION ALL {more}), dag AS (SELECT sid, {acyclic} AS dag FROM s),
turned AS (SELECT sid, ord, CASE WHEN dag AND u > v THEN v ELSE u END AS u, CASE WHEN dag AND u > v THEN u ELSE v END AS v FROM drawn JOIN dag USING (sid) WHERE u <> v),
once AS (SELECT sid, u, v, row_number() OVER (PARTITION BY sid ORDER BY min(ord)) AS nth FROM turned GROUP BY sid, u, v),
names AS (SELECT sid, i, substr(md5({_slot(name, "'node'", 'i')}), 1, 10) AS node FROM s, range({n}) t(i)),
nodes AS (SELECT sid, node FROM names),
g AS (SELECT o.sid, a.node AS u, b.node AS v FROM once o JOIN names a ON a.sid = o.sid AND a.i = o.u JOIN names b ON b.sid = o.sid AND b.i = o.v WHERE nth <= {max(target, n)})"""


def _start(name: str, of: str) -> str:
    return f"start AS (SELECT sid, min_by(node, md5('{SEED}:{name}:start:' || sid || ':' || node)) AS node FROM ({of}) GROUP BY sid)"


def _layers(along: str = "SELECT sid, u, v FROM g") -> str:
    """d(sid, node, depth): nodes at their fewest steps from the start, itself left out."""
    return f"""e AS ({along}), walk(sid, node, depth) AS (
  SELECT sid, node, 0 FROM start UNION SELECT w.sid, e.v, w.depth + 1 FROM walk w JOIN e ON e.sid = w.sid AND e.u = w.node WHERE w.depth < {max(6, SIZE)}),
d AS (SELECT sid, node, min(depth) AS depth FROM walk GROUP BY sid, node HAVING min(depth) > 0)"""


_BACK = "SELECT sid, v AS u, u AS v FROM g"
_BOTH = f"SELECT sid, u, v FROM g UNION {_BACK}"
_END = {"u": "SELECT sid, u AS node FROM g", "v": "SELECT sid, v AS node FROM g", "all": "SELECT sid, node FROM nodes"}


def _out(gold: str, rest: str) -> str:
    return f"SELECT CAST(sid AS BIGINT) AS sample_id, {gold} AS gold {rest}"


def _neighbours(name: str, near: str, far: str) -> str:
    return f"WITH {_graph(name)}, {_start(name, _END[near])} " + _out(
        _json_list("x", "x"), f"FROM (SELECT DISTINCT g.sid, g.{far} AS x FROM g JOIN start ON start.sid = g.sid AND start.node = g.{near}) GROUP BY sid"
    )


def _closure(name: str, near: str, along: str) -> str:
    return f"WITH RECURSIVE {_graph(name)}, {_start(name, _END[near])}, {_layers(along)} " + _out(
        _json_list("d.node", "d.node"), "FROM start LEFT JOIN d USING (sid) GROUP BY sid"
    )


def _numeric_agg() -> str:
    n = "numeric_agg"
    return f"""WITH {S}, v AS (SELECT sid, {_drawn(999, n, 'i')} + 1 AS x FROM s, range(1, {SIZE + 1}) u(i)), a AS (SELECT sid, {_drawn(5, n, "'agg'")} AS agg FROM s)
SELECT CAST(sid AS BIGINT) AS sample_id, CASE agg WHEN 0 THEN CAST(sum(x) AS VARCHAR) WHEN 1 THEN CAST(min(x) AS VARCHAR) WHEN 2 THEN CAST(max(x) AS VARCHAR)
  WHEN 3 THEN CAST(round(avg(x), 2) AS VARCHAR) ELSE CAST(median(x) AS VARCHAR) END AS gold FROM v JOIN a USING (sid) GROUP BY sid, agg"""


def _variable_arithmetic() -> str:
    n, value = "variable_arithmetic", f"{_drawn(20, 'variable_arithmetic', "'first'")} + 1"
    ctes = [f"t0 AS (SELECT sid, {value} AS x FROM s)"]
    for i in range(4):
        op, c = _drawn(3, n, "'op'", f"'{i}'"), f"({_drawn(9, n, "'c'", f"'{i}'")} + 1)"
        ctes.append(f"t{i + 1} AS (SELECT sid, CASE {op} WHEN 0 THEN x + {c} WHEN 1 THEN x - {c} ELSE x * {c} END AS x FROM t{i})")
    return f"WITH {S}, {', '.join(ctes)} " + _out("CAST(x AS VARCHAR)", "FROM t4")


def _variable_tracking() -> str:
    """The chain as rows, followed from the value to every name that gets it."""
    n = "variable_tracking"
    last = f"chr(CAST(({_drawn(26, n, "'last'")} + i) % 26 AS INT) + 65)"
    name = _word(n, 4, "'var'|i", True)
    return f"WITH RECURSIVE {S}, names AS (SELECT sid, i, {name} || {last} AS name FROM s, range(5) u(i)), told AS (SELECT a.sid, a.name, a.i, b.name AS of FROM names a LEFT JOIN names b ON b.sid = a.sid AND b.i = a.i - 1), known(sid, name, i) AS (SELECT sid, name, i FROM told WHERE of IS NULL UNION SELECT t.sid, t.name, t.i FROM told t JOIN known k ON k.sid = t.sid AND k.name = t.of) " + _out(
        _json_list("name", "i"), "FROM known GROUP BY sid"
    )


def _freq_words() -> str:
    n, size = "freq_words", max(SIZE, TASKS["freq_words"].min_size)
    return f"""WITH {S}, c AS (SELECT sid, i, {_word(n, 6, 'i', False)} AS word, floor({size} * power(i + 1.0, -1.5) / 2.612375348685488) AS times FROM s, range({max(20, size // 20)}) u(i)),
k AS (SELECT sid, word, i, row_number() OVER (PARTITION BY sid ORDER BY times DESC, i) AS nth FROM c WHERE i > 0) """ + _out(_json_list("word", "nth"), "FROM k WHERE nth <= 3 GROUP BY sid")


def _count_predicate() -> str:
    n = "count_predicate"
    asked = f"""q AS (SELECT sid, {_drawn(4, n, "'kind'")} AS kind, {_drawn(601, n, "'t'")} + 200 AS t, {_drawn(301, n, "'low'")} + 100 AS low, {_drawn(401, n, "'high'")} + 500 AS high,
  {_CATS}[{_drawn(len(CATEGORIES), n, "'asked'")} + 1] AS c FROM s)"""
    hit = "CASE kind WHEN 0 THEN v > t WHEN 1 THEN v < t WHEN 2 THEN cat = c ELSE v BETWEEN low AND high END"
    return f"WITH {S}, {_records(n)}, {asked} " + _out(f"CAST(count(*) FILTER ({hit}) AS VARCHAR)", "FROM r JOIN q USING (sid) GROUP BY sid")


def _by_category(name: str, value: str) -> str:
    return f"WITH {S}, {_records(name)}, a AS (SELECT sid, cat, {value} AS n FROM r GROUP BY sid, cat) " + _out(
        """'{' || string_agg('"' || cat || '":' || n, ',' ORDER BY cat) || '}'""", "FROM a GROUP BY sid"
    )


def _counted(name: str, n: str, times: str, k: str) -> str:
    """The ``k`` words that ``times`` makes most frequent; equal ones in the order of the walk."""
    return f"""WITH {_walk(name, n)}, kept AS (SELECT sid, word, min(i) AS pos FROM w GROUP BY sid, word), o AS (SELECT sid, word, row_number() OVER (PARTITION BY sid ORDER BY pos) - 1 AS i FROM kept),
c AS (SELECT sid, word, i, {times} AS times, {k} AS k FROM o), b AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY times DESC, i) AS nth FROM c) """ + _out(
        _json_list("word", "nth"), "FROM b WHERE nth <= k GROUP BY sid"
    )


def _top_k() -> str:
    n, base = "top_k", max(SIZE // 3, 6)
    k = f"CASE WHEN {_drawn(2, n, "'k'")} = 0 THEN 3 ELSE 5 END"
    text = _counted(n, str(5 + max(5, SIZE // 2)), f"CASE WHEN i < {k} THEN {base} + 3 * ({k} - i) ELSE {_drawn(2, n, "'n'", 'i')} + 1 END", k)
    return text


def _count_occurrences() -> str:
    n = "count_occurrences"
    planted = f"{_drawn(max(3, SIZE // 20) - 1, n, "'planted'")} + 2"
    return f"WITH {_walk(n, str(max(10, SIZE // 4)))}, one AS (SELECT sid, word FROM w WHERE i = 0), stream AS (SELECT sid, word FROM (SELECT DISTINCT sid, word FROM w) d JOIN s USING (sid), range({max(3, SIZE // 20) + 2}) u(j) WHERE j < {planted} AND EXISTS (SELECT 1 FROM one WHERE one.sid = d.sid AND one.word = d.word)) " + _out(
        "CAST(count(*) AS VARCHAR)", "FROM stream GROUP BY sid"
    )


def _set_ops() -> str:
    n, size = "set_ops", max(4, SIZE // 2)
    half = size // 2
    return f"""WITH {_walk(n, str(2 * size))}, a AS (SELECT sid, word FROM w WHERE i < {size}), b AS (SELECT sid, word FROM w WHERE i < {half} OR i BETWEEN {size} AND {2 * size - half - 1}),
q AS (SELECT sid, {_drawn(3, n, "'op'")} AS op FROM s),
x AS (SELECT sid, word FROM q JOIN (SELECT * FROM a INTERSECT SELECT * FROM b) USING (sid) WHERE op = 0 UNION ALL SELECT sid, word FROM q JOIN (SELECT * FROM a EXCEPT SELECT * FROM b) USING (sid) WHERE op = 2),
n AS (SELECT sid, count(*) AS n FROM q JOIN (SELECT * FROM a UNION SELECT * FROM b) USING (sid) WHERE op = 1 GROUP BY sid)
SELECT CAST(sid AS BIGINT) AS sample_id, {_json_list('word', 'word')} AS gold FROM x GROUP BY sid UNION ALL SELECT CAST(sid AS BIGINT), CAST(n AS VARCHAR) FROM n"""


def _bfs() -> str:
    n = "graph_bfs"
    return f"WITH RECURSIVE {_graph(n)}, {_start(n, _END['u'])}, {_layers()}, q AS (SELECT sid, min_by(depth, md5('{SEED}:{n}:depth:' || sid || ':' || depth)) AS depth FROM (SELECT DISTINCT sid, depth FROM d) GROUP BY sid) " + _out(
        _json_list("node", "node"), "FROM d JOIN q USING (sid, depth) GROUP BY sid"
    )


def _shortest_path() -> str:
    n = "graph_shortest_path"
    return f"WITH RECURSIVE {_graph(n)}, {_start(n, _END['u'])}, {_layers()} " + _out(
        f"CAST(min_by(depth, md5('{SEED}:{n}:dst:' || sid || ':' || node)) AS VARCHAR)", "FROM d GROUP BY sid"
    )


def _reachable() -> str:
    n = "graph_reachable"
    wanted = f"({_drawn(1_000_000, n, "'coin'")} < 500000)"
    return f"""WITH RECURSIVE {_graph(n)}, {_start(n, _END['all'])}, {_layers()},
o AS (SELECT nodes.sid AS sid, nodes.node AS node, d.node IS NOT NULL AS yes FROM nodes JOIN start ON start.sid = nodes.sid AND start.node <> nodes.node LEFT JOIN d ON d.sid = nodes.sid AND d.node = nodes.node),
p AS (SELECT sid, yes, row_number() OVER (PARTITION BY sid ORDER BY yes <> {wanted}, md5('{SEED}:{n}:' || node)) AS nth FROM o) """ + _out(
        """CASE WHEN yes THEN '"Yes"' ELSE '"No"' END""", "FROM p WHERE nth = 1"
    )


def _cycle() -> str:
    n = "graph_cycle"
    dag = f"({_drawn(1_000_000, n, "'dag'")} < 500000)"
    return f"""WITH RECURSIVE {_graph(n, acyclic=dag)}, closure(sid, a, b) AS (SELECT sid, u, v FROM g UNION SELECT c.sid, c.a, g.v FROM closure c JOIN g ON g.sid = c.sid AND g.u = c.b) """ + _out(
        """CASE WHEN max(CASE WHEN a = b THEN 1 ELSE 0 END) = 1 THEN '"Yes"' ELSE '"No"' END""", "FROM closure GROUP BY sid"
    )


def _component_size() -> str:
    n = "graph_component_size"
    return f"WITH RECURSIVE {_graph(n, 1.3)}, {_start(n, _END['all'])}, {_layers(_BOTH)} " + _out("CAST(count(d.node) + 1 AS VARCHAR)", "FROM start LEFT JOIN d USING (sid) GROUP BY sid")


def _max_degree() -> str:
    n = "graph_max_degree"
    return f"WITH {_graph(n)}, k AS (SELECT sid, node, count(*) AS n FROM (SELECT sid, u AS node FROM g UNION ALL SELECT sid, v FROM g) GROUP BY sid, node), m AS (SELECT *, max(n) OVER (PARTITION BY sid) AS most FROM k) " + _out(
        _json_list("node", "node"), "FROM m WHERE n = most GROUP BY sid"
    )


GOLDS: dict[str, str] = {
    "common_words": _counted("common_words", str(10 + max(10, SIZE)), "CASE WHEN i < 10 THEN 30 ELSE 3 END", "10"),
    "freq_words": _freq_words(),
    "variable_tracking": _variable_tracking(),
    "variable_arithmetic": _variable_arithmetic(),
    "count_occurrences": _count_occurrences(),
    "count_distinct": f"WITH {_walk('count_distinct', str(max(5, SIZE // 4)))} " + _out("CAST(count(DISTINCT word) AS VARCHAR)", "FROM w GROUP BY sid"),
    "count_predicate": _count_predicate(),
    "tally_by_category": _by_category("tally_by_category", "count(*)"),
    "group_by": _by_category("group_by", "sum(v)"),
    "numeric_agg": _numeric_agg(),
    "top_k": _top_k(),
    "set_ops": _set_ops(),
    "graph_children": _neighbours("graph_children", "u", "v"),
    "graph_parents": _neighbours("graph_parents", "v", "u"),
    "graph_descendants": _closure("graph_descendants", "u", "SELECT sid, u, v FROM g"),
    "graph_ancestors": _closure("graph_ancestors", "v", _BACK),
    "graph_bfs": _bfs(),
    "graph_shortest_path": _shortest_path(),
    "graph_reachable": _reachable(),
    "graph_cycle": _cycle(),
    "graph_component_size": _component_size(),
    "graph_max_degree": _max_degree(),
}


def _registered(name: str) -> None:
    @query(f"gold_{name}", GOLDS[name])
    def gold(spark, sf):
        return _samples(spark, sf, name).select("sample_id", "gold")


for _name in TASKS:
    _registered(_name)
