"""Independent DuckDB SQL for every registered query (the correctness oracle).

Views ``documents part supplier lineitem ...`` are registered by the caller.
DuckDB wants ``lambda x: ...`` for list lambdas, lists are 1-based, and a
bare ``0.1`` is a DECIMAL, hence the ``::DOUBLE`` casts.  Integer sums are
cast to BIGINT to match Spark's types.  Regular expressions are given as
SQL literals without escape processing, so ``\\t`` reaches RE2 as written.
"""

from __future__ import annotations

from textgraph.workloads import (
    ADJ_ITERS,
    ALPHA,
    EDGE_ITERS,
    FILE_BLOCK,
    FILES,
    HEAVY_WORD,
    INDEX_FILES,
    LINE_BLOCK,
    LIST_BLOCK,
    POSTING_BLOCK,
    RANK_DIGITS,
    RANK_UNIT,
    SEARCH_ITERS,
    SEARCH_SOURCE,
    SPLIT_BYTES,
    WORD_PARTITIONS,
)

_TOKENS = r"""
t AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS tk
  FROM documents)"""

_LINES_IN = r"""(len(regexp_split_to_array(text, '\r\n|\n|\r'))
   - CASE WHEN text = '' OR regexp_matches(text, '(\r\n|\n|\r)$') THEN 1 ELSE 0 END)"""

_PAIRS = r"""list_transform(generate_series(1, len(tk) - 1), lambda i: tk[i] || ' ' || tk[i + 1])"""

_POSTINGS = f"""WITH {_TOKENS},
p AS (SELECT w AS word, doc_id, CAST(count(*) AS BIGINT) AS n
      FROM (SELECT doc_id, unnest(tk) AS w FROM t) GROUP BY w, doc_id)"""

# the documents as files: the line end that each is followed by belongs to the file
_FILE_TOKENS = rf"""
f AS (SELECT doc_id, coalesce(text, '') || chr(10) AS text, 'docs-' || lpad(coalesce(doc_id % {FILES}, 0)::VARCHAR, 5, '0') AS file
      FROM documents),
ft AS (SELECT file, doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda x: x <> '') AS tk FROM f),
fw AS (SELECT file, doc_id, text, unnest(generate_series(1, len(tk))) AS pos, unnest(tk) AS word FROM ft)"""
_MD5_32 = "CAST('0x' || substr(md5(word), 1, 8) AS BIGINT)"

FILE_SQL = {
    "file_lines": f"""WITH {_FILE_TOKENS}
SELECT file, sum(strlen(text))::BIGINT AS bytes, ceil(sum(strlen(text)) / {SPLIT_BYTES})::BIGINT AS splits,
       sum({_LINES_IN})::BIGINT AS n FROM ft GROUP BY file""",

    "file_words": f"""WITH {_FILE_TOKENS}
SELECT word, file, count(*) AS n FROM fw GROUP BY word, file""",

    "file_bigrams": f"""WITH {_FILE_TOKENS},
p AS (SELECT word || ' ' || lead(word) OVER (PARTITION BY file ORDER BY doc_id NULLS FIRST, text, pos) AS bigram FROM fw)
SELECT bigram, count(*) AS n FROM p WHERE bigram IS NOT NULL GROUP BY bigram
UNION ALL
SELECT 'zzzzzzzzz Times Map task lanched: ', sum(splits)::BIGINT
FROM (SELECT ceil(sum(strlen(text)) / {SPLIT_BYTES}) AS splits FROM ft GROUP BY file)""",

    "file_index": f"""WITH {_FILE_TOKENS},
names AS (SELECT file, row_number() OVER (ORDER BY file) - 1 AS i FROM (SELECT DISTINCT file FROM fw)),
p AS (SELECT word, file, i, count(*) AS n FROM fw JOIN names USING (file) GROUP BY word, file, i)
SELECT 'part-r-' || lpad(({_MD5_32} % {INDEX_FILES})::VARCHAR, 5, '0') AS file,
       word || chr(9) || string_agg(file || ':' || n || ';', '' ORDER BY file) AS value
FROM p GROUP BY word, i // {FILE_BLOCK}""",

    "word_files": f"""WITH {_TOKENS}
SELECT w AS word, count(*) AS n, true AS ordered FROM (SELECT unnest(tk) AS w FROM t) GROUP BY w""",

    "word_partitions": f"""WITH {_TOKENS},
w AS (SELECT doc_id, unnest(tk) AS word FROM t),
c AS (SELECT word, count(*) AS n, sum(count(*)) OVER ()::DOUBLE * {HEAVY_WORD!r}::DOUBLE AS most FROM w GROUP BY word),
h AS (SELECT word, CASE WHEN n > most THEN least(ceil(n / most), {WORD_PARTITIONS})::BIGINT ELSE 1 END AS fan FROM c)
SELECT word, ({_MD5_32} + CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) % fan) % {WORD_PARTITIONS} AS part,
       count(*) AS n
FROM w JOIN h USING (word) GROUP BY ALL""",
}

TEXT_SQL = {
    "tokenize": f"""WITH {_TOKENS}
SELECT doc_id, CAST(pos AS BIGINT) AS pos, token FROM (
  SELECT doc_id, unnest(generate_series(0, len(tk) - 1)) AS pos, unnest(tk) AS token FROM t)""",

    "word_count": f"""WITH {_TOKENS}
SELECT w AS word, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(tk) AS w FROM t) GROUP BY w""",

    "line_count": f"""SELECT CAST(coalesce(sum({_LINES_IN}), 0) AS BIGINT) AS n FROM documents""",

    "word_count_with_total": f"""WITH {_TOKENS}
SELECT word, CAST(sum(v) AS BIGINT) AS n FROM (
  SELECT unnest(tk) AS word, 1 AS v FROM t
  UNION ALL
  SELECT 'zzzzzzzzzzzzzzzzzzzz' AS word, {_LINES_IN} AS v FROM documents)
GROUP BY word""",

    "bigram_count": f"""WITH {_TOKENS}
SELECT b AS bigram, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest({_PAIRS}) AS b FROM t WHERE len(tk) >= 2)
GROUP BY b""",

    # same rows as bigram_count: the line-stream plan must stitch pairs
    # across lines and emulated splits back into whole-text pairs
    "bigram_count_lines": f"""WITH {_TOKENS}
SELECT b AS bigram, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT unnest({_PAIRS}) AS b FROM t WHERE len(tk) >= 2)
GROUP BY b""",

    "input_unit_count": """SELECT CAST(count(DISTINCT doc_id) AS BIGINT) AS n FROM documents""",

    "bigram_count_with_total": f"""WITH {_TOKENS}
SELECT bigram, CAST(sum(v) AS BIGINT) AS n FROM (
  SELECT unnest({_PAIRS}) AS bigram, 1 AS v FROM t WHERE len(tk) >= 2
  UNION ALL
  SELECT 'zzzzzzzzz Times Map task lanched: ', count(DISTINCT doc_id) FROM documents)
GROUP BY bigram""",

    "term_postings": f"""{_POSTINGS}
SELECT word, doc_id, n FROM p""",

    "inverted_index": f"""{_POSTINGS}
SELECT word, CAST(floor(doc_id / {POSTING_BLOCK}) AS BIGINT) AS block,
       string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR) || ';', '' ORDER BY doc_id) AS postings
FROM p GROUP BY word, floor(doc_id / {POSTING_BLOCK})""",

    "postings_sorted": f"""{_POSTINGS}
SELECT word, doc_id, n FROM p ORDER BY word, doc_id""",

    "word_count_text": f"""WITH {_TOKENS}
SELECT w || chr(9) || CAST(count(*) AS VARCHAR) AS value
FROM (SELECT unnest(tk) AS w FROM t) GROUP BY w""",

    "bigram_count_lines_with_total": f"""WITH {_TOKENS},
sp AS (SELECT CAST(sum(ceil({_LINES_IN} / {LINE_BLOCK}::DOUBLE)) AS BIGINT) AS k FROM documents)
SELECT bigram, CAST(sum(v) AS BIGINT) AS n FROM (
  SELECT unnest({_PAIRS}) AS bigram, 1 AS v FROM t WHERE len(tk) >= 2
  UNION ALL
  SELECT 'zzzzzzzzz Times Map task lanched: ', k FROM sp) GROUP BY bigram""",

    "index_text": f"""{_POSTINGS}
SELECT word || chr(9) || string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR) || ';', ''
                                    ORDER BY doc_id) AS value
FROM p GROUP BY word, floor(doc_id / {POSTING_BLOCK})""",
}


# --- graph ------------------------------------------------------------------

_GRAPH = """
pc AS (SELECT count(*) AS c FROM part),
sc AS (SELECT count(*) AS c FROM supplier),
e AS (
  SELECT (SELECT c FROM pc) + l_suppkey + 1 AS src, l_partkey + 1 AS dst, l_quantity
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL
  SELECT l_partkey + 1, (SELECT c FROM pc) + l_suppkey + 1, l_quantity
  FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'A'
  UNION ALL
  SELECT (SELECT c FROM pc) + s_suppkey + 1, (SELECT c FROM pc) + (SELECT c FROM sc) + s_nationkey + 1, 1.0
  FROM supplier),
ids AS (
  SELECT p_partkey + 1 AS id FROM part
  UNION ALL SELECT (SELECT c FROM pc) + s_suppkey + 1 FROM supplier),
nn AS (SELECT CAST((SELECT c FROM pc) + (SELECT c FROM sc) + (SELECT count(*) FROM nation) AS BIGINT) AS n),
de AS (SELECT DISTINCT src, dst FROM e),
v AS (SELECT src AS id FROM de UNION SELECT dst FROM de),
nv AS (SELECT count(*) AS n FROM v),
r0 AS (SELECT id, 1.0::DOUBLE / (SELECT n FROM nv) AS rank FROM v),
ddeg AS (SELECT src, count(*) AS outdeg FROM de GROUP BY src)"""

_R = f"{RANK_DIGITS}"
_A = f"{ALPHA!r}::DOUBLE"
_KEEP = f"{1.0 - ALPHA!r}::DOUBLE"


def _edge_rank_sql() -> str:
    """Edge-list form, unrolled: r1..rK from r0."""
    steps = []
    for k in range(1, EDGE_ITERS + 1):
        p = f"r{k - 1}"
        steps.append(f"""r{k} AS (
  SELECT v.id, {_KEEP} * (coalesce(c.s, 0) + m.mass / nv.n) + {_A} / nv.n AS rank
  FROM v CROSS JOIN nv
  CROSS JOIN (SELECT coalesce(sum(rank), 0) AS mass FROM {p}
              WHERE id NOT IN (SELECT src FROM ddeg)) m
  LEFT JOIN (SELECT de.dst AS id, sum(x.rank / ddeg.outdeg) AS s
             FROM de JOIN ddeg USING (src) JOIN {p} x ON x.id = de.src
             GROUP BY de.dst) c ON c.id = v.id)""")
    return f"""WITH {_GRAPH},
{(",".join(steps))}
SELECT id, round(rank, {_R}) AS rank FROM r{EDGE_ITERS}"""


_ADJ = """
em AS (SELECT src, dst, count(*) AS mult FROM e GROUP BY src, dst),
deg AS (SELECT src, sum(mult) AS outdeg FROM em GROUP BY src),
u AS (
  SELECT id, bool_or(isrow) AS row0, bool_or(tgt) AS tgt,
         (id BETWEEN 1 AND (SELECT n FROM nn)) AS in_range
  FROM (SELECT id, true AS isrow, false AS tgt FROM ids
        UNION ALL SELECT src, true, false FROM em
        UNION ALL SELECT dst, false, true FROM em
        UNION ALL SELECT unnest(range(1, n + 1)), false, false FROM nn)
  GROUP BY id),
s0 AS (SELECT u.id, u.row0 AS present,
              CASE WHEN u.row0 THEN 1.0::DOUBLE / nn.n END AS rank FROM u, nn)"""


def _adj_step(k: int) -> str:
    p = f"s{k - 1}"
    share = "(u.in_range AND m.nd > 0)"
    present = f"(x.present OR u.tgt OR {share})"
    return f"""s{k} AS (
  SELECT u.id, {present} AS present,
         CASE WHEN {present} THEN {_KEEP} * (coalesce(c.s, 0)
              + CASE WHEN {share} THEN m.mass / nn.n ELSE 0 END) + {_A} / nn.n END AS rank
  FROM u JOIN {p} x ON x.id = u.id CROSS JOIN nn
  CROSS JOIN (SELECT coalesce(sum(rank), 0) AS mass, count(*) AS nd FROM {p}
              WHERE present AND id NOT IN (SELECT src FROM deg)) m
  LEFT JOIN (SELECT em.dst AS id, sum(y.rank / deg.outdeg * em.mult) AS s
             FROM em JOIN deg USING (src) JOIN {p} y ON y.id = em.src AND y.present
             GROUP BY em.dst) c ON c.id = u.id)"""


# rows and edges of the parts alone
_PART_GRAPH = _GRAPH + """,
pe AS (SELECT * FROM e WHERE src <= (SELECT c FROM pc)),
pids AS (SELECT p_partkey + 1 AS id FROM part)"""


def _adj_sql(final: str, graph: str = _GRAPH, adj: str = _ADJ) -> str:
    steps = ",\n".join(_adj_step(k) for k in range(1, ADJ_ITERS + 1))
    return f"""WITH {graph},{adj},
{steps}
{final}"""


_SCATTER = f"""WITH {_GRAPH},{_ADJ},
c AS (SELECT em.dst AS id, sum(y.rank / deg.outdeg * em.mult) AS s
      FROM em JOIN deg USING (src) JOIN s0 y ON y.id = em.src AND y.present GROUP BY em.dst),
m AS (SELECT coalesce(sum(rank), 0) AS mass, count(*) AS nd FROM s0
      WHERE present AND id NOT IN (SELECT src FROM deg))
SELECT u.id, round(coalesce(c.s, 0), {_R}) AS rank
FROM u JOIN s0 x ON x.id = u.id LEFT JOIN c ON c.id = u.id
WHERE x.present OR u.tgt
UNION ALL
SELECT CAST(-1 AS BIGINT), round(mass, {_R}) FROM m WHERE nd > 0"""


def _search_sql(weight: str) -> str:
    steps = []
    for k in range(1, SEARCH_ITERS + 1):
        p = f"t{k - 1}"
        steps.append(f"""t{k} AS (
  SELECT x.id, least(x.dist, o.offer) AS dist,
         greatest(CASE WHEN x.color = 1 THEN 2 ELSE x.color END,
                  CASE WHEN o.offer IS NOT NULL THEN 1 END) AS color,
         x.present OR o.offer IS NOT NULL AS present
  FROM {p} x LEFT JOIN (
    SELECT we.dst AS id, min(f.dist + we.w) AS offer
    FROM {p} f JOIN we ON we.src = f.id WHERE f.color = 1 GROUP BY we.dst) o ON o.id = x.id)""")
    return f"""WITH {_GRAPH},
we AS (SELECT src, dst, {weight} AS w FROM e GROUP BY src, dst),
t0 AS (
  SELECT id, CAST(CASE WHEN id = {SEARCH_SOURCE} THEN 0 END AS BIGINT) AS dist,
         CASE WHEN id = {SEARCH_SOURCE} THEN 1 ELSE 0 END AS color, bool_or(isrow) AS present
  FROM (SELECT id, true AS isrow FROM ids UNION ALL SELECT dst, false FROM we)
  GROUP BY id),
{{steps}}
SELECT id, dist, CASE color WHEN 0 THEN 'WHITE' WHEN 1 THEN 'GRAY' ELSE 'BLACK' END AS color
FROM t{{last}} WHERE present""".replace("{steps}", ",\n".join(steps))


def _search(weight: str, iters: int) -> str:
    return _search_sql(weight).replace("{last}", str(iters))


def _search_history(weight: str) -> str:
    head, _, _ = _search_sql(weight).rpartition("SELECT id, dist, CASE color")
    return head + "\nUNION ALL\n".join(
        f"SELECT CAST({k} AS BIGINT) AS iteration, id, dist, CASE color WHEN 0 THEN 'WHITE' WHEN 1 THEN 'GRAY' "
        f"ELSE 'BLACK' END AS color FROM t{k} WHERE present" for k in range(1, SEARCH_ITERS + 1))


# Graph text: a line per node and block of LIST_BLOCK target ids.
_RANKED = f"""rk AS (SELECT src AS id, count(*)::DOUBLE / {RANK_UNIT} AS rank FROM de GROUP BY src),
lone AS (SELECT DISTINCT dst AS id FROM de WHERE dst NOT IN (SELECT src FROM de))"""
_RANGE = f"""q AS (SELECT src, dst, min(CAST(l_quantity AS INTEGER)) AS least, max(CAST(l_quantity AS INTEGER)) AS most
      FROM e GROUP BY src, dst)"""
_DIST = f"CASE WHEN src = {SEARCH_SOURCE} THEN '0|GRAY' ELSE 'Integer.MAX_VALUE|WHITE' END"

_WEIGHT = "CAST(min(CAST(l_quantity AS INTEGER)) AS BIGINT)"

GRAPH_SQL = {
    "edge_list": f"WITH {_GRAPH} SELECT src, dst FROM e",
    "distinct_edges": f"WITH {_GRAPH} SELECT src, dst FROM de",
    "out_degree": f"WITH {_GRAPH} SELECT src AS id, CAST(count(*) AS BIGINT) AS out_degree FROM de GROUP BY src",
    "dangling_nodes": f"WITH {_GRAPH} SELECT dst AS id FROM e EXCEPT SELECT src FROM e",
    "node_count": f"WITH {_GRAPH} SELECT CAST(n AS BIGINT) AS n FROM nv",
    "implicit_nodes": f"WITH {_GRAPH} SELECT DISTINCT dst AS id FROM e WHERE dst NOT IN (SELECT id FROM ids)",
    "rank_init": f"WITH {_GRAPH} SELECT id, round(rank, {_R}) AS rank FROM r0",
    "rank_contributions": f"""WITH {_GRAPH}
SELECT de.dst AS id, round(sum(r0.rank / ddeg.outdeg), {_R}) AS contrib
FROM de JOIN ddeg USING (src) JOIN r0 ON r0.id = de.src GROUP BY de.dst""",
    "dangling_mass": f"""WITH {_GRAPH}
SELECT round(coalesce(sum(rank), 0), {_R}) AS mass FROM r0 WHERE id NOT IN (SELECT src FROM ddeg)""",
    "pagerank_scatter": _SCATTER,
    "pagerank_adjacency": _adj_sql(
        f"SELECT id, round(rank, {_R}) AS rank FROM s{ADJ_ITERS} WHERE present"),
    "pagerank_history": _adj_sql("\nUNION ALL\n".join(
        f"SELECT CAST({k} AS BIGINT) AS iteration, id, round(rank, {_R}) AS rank FROM s{k} WHERE present"
        for k in range(1, ADJ_ITERS + 1))),
    "pagerank_edges": _edge_rank_sql(),
    "adjacency_blocks": f"""WITH {_GRAPH}
SELECT id, count(dst) AS targets, max(dst) AS largest, true AS fits FROM ids LEFT JOIN e ON e.src = ids.id GROUP BY id""",
    "pagerank_files": _adj_sql(f"SELECT id, round(rank, {_R}) AS rank FROM s{ADJ_ITERS} WHERE present"),
    "implicit_suppliers": f"""WITH {_PART_GRAPH}
SELECT DISTINCT dst AS id, dst IN (SELECT src FROM e) AS source FROM pe WHERE dst NOT IN (SELECT id FROM pids)""",
    "pagerank_part_rows": _adj_sql(f"SELECT id, round(rank, {_R}) AS rank FROM s{ADJ_ITERS} WHERE present", _PART_GRAPH,
                                   _ADJ.replace("FROM e GROUP", "FROM pe GROUP").replace("FROM ids", "FROM pids")),
    "frontier_step": _search(_WEIGHT, 1),
    "frontier_search": _search(_WEIGHT, SEARCH_ITERS),
    "bfs_hops": _search("CAST(1 AS BIGINT)", SEARCH_ITERS),
    "frontier_history": _search_history(_WEIGHT),
    "adjacency_text": f"""WITH {_GRAPH},{_RANKED}
SELECT src || chr(9) || string_agg(dst::VARCHAR, ',' ORDER BY dst) || '|' || any_value(rank) AS value
FROM de JOIN rk ON rk.id = de.src GROUP BY src, dst // {LIST_BLOCK}
UNION ALL SELECT id || chr(9) || 'NULL|0.0' FROM lone""",
    "adjacency_parse": f"""WITH {_GRAPH},{_RANKED}
SELECT src AS id, rank, dst FROM de JOIN rk ON rk.id = de.src
UNION ALL SELECT id, 0.0::DOUBLE, NULL FROM lone""",
    "search_text": f"""WITH {_GRAPH},{_RANGE}
SELECT src || chr(9) || string_agg(dst || ',' || dst || ',', '' ORDER BY dst) || '|'
       || string_agg(least || ',' || most || ',', '' ORDER BY dst) || '|' || {_DIST} AS value
FROM q GROUP BY src, dst // {LIST_BLOCK}""",
    "search_parse": f"""WITH {_GRAPH},{_RANGE}
SELECT src AS id, dst, CAST(w AS BIGINT) AS w,
       CASE WHEN src = {SEARCH_SOURCE} THEN 0::BIGINT END AS dist,
       CASE WHEN src = {SEARCH_SOURCE} THEN 'GRAY' ELSE 'WHITE' END AS color
FROM (SELECT src, dst, least AS w FROM q UNION ALL SELECT src, dst, most FROM q)""",
    "first_weight_edges": f"WITH {_GRAPH},{_RANGE} SELECT src, dst, CAST(least AS BIGINT) AS w FROM q",
    "rank_tuple_text": f"WITH {_GRAPH},{_RANKED} SELECT '(' || id || ',' || rank || ')' AS value FROM rk",
}


def all_sql() -> dict[str, str]:
    return {**TEXT_SQL, **FILE_SQL, **GRAPH_SQL}
