"""One registered query per operator, each over its whole table with the
operator's default parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm import (
    brown,
    conversations,
    licenses,
    mixing,
    packing,
    pivots,
    quality,
    scan,
    sharding,
    simhash,
    sketch,
    toxicity,
    urls,
)
from textgraph.llm.common import documents
from textgraph.sources.tables import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_fingerprints(documents(spark, sf_dir))


def op3_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_documents(documents(spark, sf_dir))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_vector_bin_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_pivot_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_embeddings(table(spark, sf_dir, "embeddings"))


def op10_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op11_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan.rank_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_threshold_sketch, op3_simhash_bktree, op4_karmarkar_karp_packing, op5_brown_lm,
        op6_source_mixing, op7_vector_bin_sharding, op8_ordinal_toxicity, op9_pivot_embeddings, op10_url_markov,
        op11_automaton_search, op12_auction_repair, op13_license_join, pipeline)}


# --- SQL (DuckDB) of the queries that SQL can express ------------------------

_MIXING = f"""WITH RECURSIVE
d AS (SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'),
                                              lambda w: w <> '')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS DOUBLE) AS weight
      FROM d GROUP BY source),
shares AS (
  SELECT 0.0::DOUBLE AS share
  UNION
  SELECT (SELECT (sum(source_size) - coalesce(sum(CASE WHEN weight * x.share > {mixing.MOST} * source_size
                                                       THEN {mixing.MOST} * source_size END), 0))::DOUBLE
                 / sum(CASE WHEN weight * x.share <= {mixing.MOST} * source_size THEN weight END) FROM s)
  FROM shares x),
t AS (SELECT source, source_size,
             least(weight * (SELECT max(share) FROM shares), {mixing.MOST}.0::DOUBLE * source_size) AS target FROM s),
r AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
               / {float(1 << 52)!r}::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM (
  SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM r)"""


def _rule_case() -> str:
    whens = []
    for rule, _ in sorted(urls.RULES, key=lambda r: -len(r[0])):
        name, slash, rest = rule.partition("/")
        whens.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + rest}') THEN '{rule}'")
    return "CASE " + " ".join(whens) + " END"


def _level(k: int) -> str:
    if k == 1:
        p = [f"({v} + 1) / (c_{v} + {len(urls.SYMBOLS)})::DOUBLE AS p_{v}" for v in ("allow", "block")]
        return f"l1 AS (SELECT gram, {', '.join(p)}, ln(p_allow) - ln(p_block) AS inc FROM g JOIN c USING (ctx) WHERE length(gram) = 1)"
    p = [f"(g.{v} + {urls.BACKOFF}::DOUBLE * b.p_{v}) / (c.c_{v} + {urls.BACKOFF}::DOUBLE) AS p_{v}" for v in ("allow", "block")]
    return f"""l{k} AS (SELECT gram, p_allow, p_block, (ln(p_allow) - ln(p_block)) - (ln(q_allow) - ln(q_block)) AS inc FROM (
  SELECT g.gram, {', '.join(p)}, b.p_allow AS q_allow, b.p_block AS q_block
  FROM g JOIN c USING (ctx) JOIN l{k - 1} b ON b.gram = substr(g.gram, 2) WHERE length(g.gram) = {k}))"""


_VERDICT = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in urls.RULES) + " END"
_URLS = f"""WITH u AS (
  SELECT url, n, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         '{"^" * (urls.ORDERS - 1)}' || regexp_replace(regexp_replace(lower(coalesce(url, '')), '[0-9]', '0', 'g'),
                                                      '[^a-z0/._?=&%#:+~-]', '*', 'g') || '$' AS symbols
  FROM (SELECT url, count(*) AS n FROM pages GROUP BY url)),
v AS (SELECT *, {_VERDICT} AS verdict FROM (SELECT *, {_rule_case()} AS rule FROM u)),
ends AS (SELECT symbols, verdict, n, unnest(range({urls.ORDERS}, length(symbols) + 1)) AS e FROM v),
gr AS (SELECT symbols, verdict, n, substr(symbols, e - k + 1, k) AS gram FROM ends, range(1, {urls.ORDERS + 1}) o(k)),
g AS (SELECT gram, substr(gram, 1, length(gram) - 1) AS ctx, sum(CASE WHEN verdict = 'allow' THEN n ELSE 0 END) AS allow,
             sum(CASE WHEN verdict = 'block' THEN n ELSE 0 END) AS block FROM gr GROUP BY gram),
c0 AS (SELECT ctx, sum(allow) AS c_allow, sum(block) AS c_block FROM g GROUP BY ctx),
c AS (SELECT c0.* FROM c0, (SELECT c_allow AS t_allow, c_block AS t_block FROM c0 WHERE ctx = '')
      WHERE c_allow > 0 AND c_allow * {urls.CONTEXT_SHARE} >= t_allow OR c_block > 0 AND c_block * {urls.CONTEXT_SHARE} >= t_block),
{", ".join(_level(k) for k in range(1, urls.ORDERS + 1))},
m AS ({" UNION ALL ".join(f"SELECT gram, inc FROM l{k}" for k in range(1, urls.ORDERS + 1))}),
sums AS (SELECT symbols, sum(inc) AS ratio FROM (SELECT x.symbols, gram FROM (SELECT DISTINCT symbols FROM v) x,
         range({urls.ORDERS}, length(x.symbols) + 1) q(e), range(1, {urls.ORDERS + 1}) o(k),
         LATERAL (SELECT substr(x.symbols, (e - k + 1)::BIGINT, k::BIGINT) AS gram)) JOIN m USING (gram) GROUP BY symbols),
z AS (SELECT v.*, coalesce(ratio, 0) / (length(v.symbols) - {urls.ORDERS - 1}) AS mean
      FROM v LEFT JOIN sums ON sums.symbols = v.symbols),
mo AS (SELECT verdict, sum(mean * n) / sum(n) AS mu, sum(mean * mean * n) / sum(n) AS sq FROM z WHERE verdict IS NOT NULL GROUP BY verdict),
ms AS (SELECT max(mu) FILTER (verdict = 'allow') AS am, max(mu) FILTER (verdict = 'block') AS bm,
              sqrt(max(greatest(sq - mu * mu, 1e-12)) FILTER (verdict = 'allow')) AS asd,
              sqrt(max(greatest(sq - mu * mu, 1e-12)) FILTER (verdict = 'block')) AS bsd FROM mo),
cut AS (SELECT coalesce((am * bsd + bm * asd) / (asd + bsd), 0) AS cut FROM ms)
SELECT page_id, p.url, host, path, rule,
       coalesce(verdict, CASE WHEN mean >= cut THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN rule IS NULL THEN round(mean - cut, 6) END AS score
FROM pages p JOIN z ON p.url IS NOT DISTINCT FROM z.url, cut"""

# every pair of a label by brute force: the index must have found all of them
_EMBEDDINGS = f"""WITH RECURSIVE
e AS (SELECT row_number() OVER () AS i, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
f AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL
      AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.i, b.i AS j, b.vec_id AS other FROM f a JOIN f b ON a.label = b.label AND a.i <> b.i
          AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {pivots.COSINE}),
reach AS (SELECT i, i AS j FROM e UNION SELECT r.i, l.j FROM reach r JOIN links l ON l.i = r.j),
least AS (SELECT r.i, min(e.vec_id) AS component_id FROM reach r JOIN e ON e.i = r.j GROUP BY r.i)
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE links.i = e.i) AS BIGINT) AS n_links, component_id,
       coalesce(vec_id = component_id, false) AS kept
FROM e JOIN least ON least.i = e.i"""


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SEARCH = f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT count(*)::BIGINT AS nn, sum(len(ts))::BIGINT AS ll FROM t WHERE len(ts) > 0),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM t) GROUP BY r, term),
q AS (SELECT i, item_id, term, count(*)::BIGINT AS k
      FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY i, item_id, term),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY term, nn),
s AS (SELECT i, item_id, t.r, t.doc_id,
             sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(ts) * nn) // ll))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN t ON t.r = tf.r, c GROUP BY i, item_id, t.r, t.doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= {scan.TOP}"""

# the cheapest repairs by dynamic programming over the rows: per state the least (cost, edits)
_SPACE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_REPAIR = rf"""WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) x(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                            lambda c: ascii(c)::BIGINT),
                             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {conversations.RULE} AS h
      FROM conversations, tab),
x AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE h <> 0),
y AS (SELECT *, row_number() OVER () AS one FROM x),
o AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, one) > 1 AS again,
             rtrim(text, {_SPACE}) AS shown FROM y
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, one)),
f AS (SELECT *, CASE WHEN shown = '' THEN 1 WHEN again THEN 2 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
             before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM o),
ids AS (SELECT DISTINCT conv_id FROM conversations),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
             count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
             count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
      FROM f GROUP BY conv_id),
moves(st, role, nxt) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
walks AS (
  SELECT conv_id, 0::BIGINT AS k, {{c: 0, a: '', st: 0, l: []::VARCHAR[]}} AS best, 0 AS st FROM ids
  UNION ALL
  SELECT conv_id, k, min({{c: c, a: a, st: st, l: l}}), st FROM (
    SELECT conv_id, k + 1 AS k, c + cost AS c, a || edit AS a, nxt AS st, CASE WHEN line IS NULL THEN l ELSE l || [line] END AS l
    FROM (
      SELECT p.*, f.role, f.text, f.fault, unnest([
        {{edit: 'D', cost: 2, nxt: p.st, line: NULL}},
        {{edit: CASE WHEN fault IN (0, 3) THEN 'R' END, cost: 1 + CASE fault WHEN 3 THEN 5 ELSE 0 END, nxt: m.nxt, line: m.role || ':' || f.text}},
        {{edit: CASE WHEN fault IN (0, 3) AND (left(f.role, 1) = left(m.role, 1) OR left(f.role, 1) = 's' AND p.st = 0) THEN 'K' END,
          cost: CASE fault WHEN 3 THEN 5 ELSE 0 END, nxt: CASE WHEN left(f.role, 1) = 's' THEN 1 ELSE m.nxt END, line: f.role || ':' || f.text}}
      ], recursive := true)
      FROM (
        SELECT conv_id, k, best.c AS c, best.a AS a, st, best.l AS l FROM walks
        UNION ALL SELECT conv_id, k, best.c + 5, best.a || 'I', nxt, best.l || [role || ':'] FROM walks JOIN moves USING (st)
        UNION ALL SELECT conv_id, k, best.c + 10, best.a || 'II', 3, best.l || ['user:', 'assistant:'] FROM walks WHERE st IN (0, 1)
      ) p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.k = p.k + 1 JOIN moves m ON m.st = p.st)
    WHERE edit IS NOT NULL) GROUP BY conv_id, k, st),
ends AS (
  SELECT w.conv_id, min(CASE w.st WHEN 0 THEN {{c: best.c, a: best.a, l: best.l}} WHEN 3 THEN {{c: best.c, a: best.a, l: best.l}}
                         WHEN 1 THEN {{c: best.c + 10, a: best.a || 'II', l: best.l || ['user:', 'assistant:']}}
                         ELSE {{c: best.c + 5, a: best.a || 'I', l: best.l || ['assistant:']}} END) AS e
  FROM walks w LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.k = coalesce(s.n, 0) GROUP BY w.conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.c::BIGINT AS cost, e.a AS audit,
       sha256(array_to_string(e.l, chr(10))) AS repaired_sha256
FROM ends LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM ends.conv_id"""

_SETS = ", ".join(f"('{label}', {words!r}, {need})" for label, words, need in licenses.template_sets())
_PLACES = " || ".join(
    "[{s: i, k: %d, l: '%s'} FOR i IN range(0, len(ws) - %d) IF %s]" % (
        len(p.split()), label, len(p.split()) - 1, " AND ".join(f"ws[i + {j + 1}] = '{w}'" for j, w in enumerate(p.split())))
    for p, label in licenses.PHRASES)
_LICENSES = rf"""WITH templates(label, words, need) AS (VALUES {_SETS}),
d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array({_LOW}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM documents),
b AS (SELECT r, ws[s + 1:s + {licenses.BLOCK}] AS block
      FROM (SELECT r, ws, unnest(range(0, greatest(len(ws) - {licenses.STEP}, 1), {licenses.STEP})) AS s FROM d)),
m AS (SELECT r, label, max(common / len(words)) AS share
      FROM (SELECT r, label, words, need, len(list_intersect(words, block)) AS common FROM b, templates)
      WHERE common >= need GROUP BY r, label),
f AS (SELECT r, list(label) AS found, max(share) AS share FROM m GROUP BY r),
p AS (SELECT *, {_PLACES} AS places FROM d)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min([x.s FOR x IN places])::BIGINT AS first_word,
       list_max([x.s FOR x IN places])::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct([x.l FOR x IN places])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct([x.l FOR x IN places] || coalesce(found, []))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0) END AS score
FROM p LEFT JOIN f ON f.r = p.r"""


def all_sql() -> dict[str, str]:
    return {"op6_source_mixing": _MIXING, "op9_pivot_embeddings": _EMBEDDINGS, "op10_url_markov": _URLS,
            "op11_automaton_search": _SEARCH,
            "op12_auction_repair": _REPAIR, "op13_license_join": _LICENSES}
