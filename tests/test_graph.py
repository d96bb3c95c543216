"""Graph operators on the sample graph (G1), synthetic fixtures (G2, G3,
F1-F3) and invariants; golden values were computed independently."""

import re

import pytest
from pyspark.sql import functions as F

from textgraph.functions.graph import BLACK, GRAY, WHITE
from textgraph.operators import graph as gr
from textgraph.operators import rank as rk
from textgraph.operators import search as se
from textgraph.sinks.text import adjacency_lines, search_lines
from textgraph.sources.graph_text import parse_adjacency, parse_edge_list, parse_search_graph
from textgraph.sources.lines import read_lines

G1 = {
    1: [0.116, 0.206, 0.206, 0.146, 0.326],
    2: [0.15488, 0.20708, 0.24758, 0.10928, 0.28118],
    3: [0.1489184, 0.2186144, 0.2421044, 0.1342604, 0.2561024],
    5: [0.1478183682, 0.2110026486, 0.2411586246, 0.1261657590, 0.2738545998],
    10: [0.1454637341, 0.2109221572, 0.2404778192, 0.1287444076, 0.2743918820],
    50: [0.1455364571, 0.2110278628, 0.2404989954, 0.1287812249, 0.2741554598],
}


def _ranks(df):
    return {r["id"]: r["rank"] for r in df.collect()}


def _close(got, want, tol=1e-9):
    assert set(got) == set(want), (sorted(got), sorted(want))
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=tol), (k, got[k], v)


@pytest.fixture(scope="module")
def g1_edges(spark):
    import os
    p = os.path.join(os.path.dirname(__file__), "data", "graph", "edges.txt")
    return parse_edge_list(read_lines(spark, p)).cache()


@pytest.fixture(scope="module")
def g1_nodes(spark):
    import os
    p = os.path.join(os.path.dirname(__file__), "data", "graph", "adjacency.txt")
    return parse_adjacency(read_lines(spark, p)).cache()


@pytest.mark.parametrize("iters", [1, 2, 3, 5, 10])
def test_g1_edge_list_form(g1_edges, iters):
    _close(_ranks(rk.pagerank_edges(g1_edges, iters, 0.1)), dict(zip(range(1, 6), G1[iters])))


@pytest.mark.parametrize("iters", [1, 2, 3, 10])
def test_g1_adjacency_form(g1_nodes, iters):
    got = rk.pagerank_adjacency(g1_nodes, 5, 0.1, iters)
    _close(_ranks(got), dict(zip(range(1, 6), G1[iters])))
    out = {r.id: r.out for r in got.collect()}
    assert out[3] is None and out[5] == [1, 2, 3]


def test_g1_fifty_iterations_and_sum(g1_edges):
    got = _ranks(rk.pagerank_edges(g1_edges, 50, 0.1))
    _close(got, dict(zip(range(1, 6), G1[50])))
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-12)


def test_g1_scatter(g1_nodes):
    rows = g1_nodes.select("id", "rank")
    got = _ranks(rk.pagerank_scatter(rows, rk.adjacency_edges(g1_nodes), 5))
    _close(got, {1: 0.2 / 3, 2: 0.2 / 2 + 0.2 / 3, 3: 0.2 / 2 + 0.2 / 3, 4: 0.1, 5: 0.3, -1: 0.2})
    assert sum(got.values()) == pytest.approx(1.0)


def test_g1_forms_agree_and_history(g1_edges, g1_nodes, tmp_path):
    a = _ranks(rk.pagerank_edges(g1_edges, 4, 0.1))
    b = _ranks(rk.pagerank_adjacency(g1_nodes, 5, 0.1, 4))
    _close(a, b, 1e-12)
    snap = str(tmp_path / "snap")
    h = rk.pagerank_adjacency(g1_nodes, 5, 0.1, 3, history=True, snapshot_path=snap)
    per = {}
    for r in h.collect():
        per.setdefault(r.iteration, {})[r.id] = r.rank
    assert sorted(per) == [1, 2, 3]
    for k in (1, 2, 3):
        _close(per[k], dict(zip(range(1, 6), G1[k])))


def test_g2_duplicates_and_implicit_rows(spark):
    nodes = spark.createDataFrame([(1, [2, 2, 3], 0.5), (2, None, 0.5)],
                                  "id bigint, out array<bigint>, rank double")
    _close(_ranks(rk.pagerank_adjacency(nodes, 4, 0.2, 1)),
           {1: 0.15, 2: 0.41666667, 3: 0.28333333, 4: 0.15}, 1e-8)
    _close(_ranks(rk.pagerank_adjacency(nodes, 4, 0.2, 2)), {1: 0.22, 2: 0.3, 3: 0.26, 4: 0.22}, 1e-8)


def test_g3_no_dangling_row_at_first(spark):
    nodes = spark.createDataFrame([(1, [2], 0.5), (2, [1, 3], 0.5)], "id bigint, out array<bigint>, rank double")
    got1 = _ranks(rk.pagerank_adjacency(nodes, 4, 0.2, 1))
    _close(got1, {1: 0.25, 2: 0.45, 3: 0.25})
    assert sum(got1.values()) == pytest.approx(0.95)
    got2 = _ranks(rk.pagerank_adjacency(nodes, 4, 0.2, 2))
    _close(got2, {1: 0.28, 2: 0.3, 3: 0.28, 4: 0.1})
    assert gr.implicit_nodes(nodes, rk.adjacency_edges(nodes)).collect()[0].id == 3


def test_edge_list_form_quirks(spark):
    """ids up to 12 (text maximum is not the numeric one), no dangling node,
    a node without in-edges keeps its row."""
    e = spark.createDataFrame([(12, 9), (9, 10), (10, 12), (1, 9)], "src bigint, dst bigint")
    got = _ranks(rk.pagerank_edges(e, 3, 0.1))
    assert sorted(got) == [1, 9, 10, 12]
    assert got[1] == pytest.approx(0.1 / 4)
    assert gr.node_count(e).first().n == 4
    assert gr.dangling_nodes(e).count() == 0
    assert sum(got.values()) == pytest.approx(1.0)


def test_salting_gives_same_result(spark):
    """Forcing every source to be split (one target per group) changes
    nothing in the result."""
    rows = [(s, (s * 7 + k) % 40 + 1) for s in range(1, 41) for k in range(s % 9)]
    rows += [(1, d) for d in range(2, 41)]                      # a hot source
    e = spark.createDataFrame(rows, "src bigint, dst bigint")
    a = _ranks(rk.pagerank_edges(e, 5, 0.15))
    b = _ranks(rk.pagerank_edges(e, 5, 0.15, group_edges=2))
    _close(a, b, 1e-12)
    w = e.withColumn("w", (F.col("src") + F.col("dst")) % 5 + 1)
    st = spark.range(1, 41).select("id", F.when(F.col("id") == 1, F.lit(0)).cast("bigint").alias("dist"),
                                   F.when(F.col("id") == 1, F.lit(GRAY)).otherwise(F.lit(WHITE)).alias("color"))
    x = sorted(tuple(r) for r in se.frontier_search(st, w, 4).collect())
    y = sorted(tuple(r) for r in se.frontier_search(st, w, 4, group_edges=1).collect())
    assert x == y


def _search_rows(spark, edges, source=1, ids=None):
    ids = ids or sorted({s for s, _, _ in edges} | {d for _, d, _ in edges})
    st = spark.createDataFrame([(i, 0 if i == source else None, GRAY if i == source else WHITE) for i in ids],
                               "id bigint, dist bigint, color int")
    e = spark.createDataFrame(edges, "src bigint, dst bigint, w bigint")
    return st, e


F1 = [(1, 2, 1), (1, 3, 10), (2, 3, 1), (2, 4, 5), (3, 4, 1), (4, 1, 1)]


def test_f1_re_expansion(spark):
    st, e = _search_rows(spark, F1)
    names = {WHITE: "W", GRAY: "G", BLACK: "B"}

    def run(k):
        return {r.id: (r.dist, names[r.color]) for r in se.frontier_search(st, e, k).collect()}
    assert run(1) == {1: (0, "B"), 2: (1, "G"), 3: (10, "G"), 4: (None, "W")}
    assert run(2) == {1: (0, "B"), 2: (1, "B"), 3: (2, "B"), 4: (6, "G")}
    assert run(3) == {1: (0, "B"), 2: (1, "B"), 3: (2, "B"), 4: (6, "B")}
    assert run(7) == run(3)
    hops = {r.id: r.dist for r in se.bfs_hops(st, e, 3).collect()}
    assert hops == {1: 0, 2: 1, 3: 1, 4: 2}


def test_f2_sink_and_target_without_row(spark):
    st = spark.createDataFrame([(1, 0, GRAY), (2, None, WHITE)], "id bigint, dist bigint, color int")
    e = spark.createDataFrame([(1, 2, 2), (1, 9, 4)], "src bigint, dst bigint, w bigint")
    got = {r.id: (r.dist, r.color) for r in se.frontier_search(st, e, 2).collect()}
    assert got == {1: (0, BLACK), 2: (2, BLACK), 9: (4, BLACK)}
    assert {r.id for r in se.frontier_search(st, e, 0).collect()} == {1, 2}


def test_f3_search_text_round_trip(spark, tmp_path):
    text = ["1\t2,3,|1,10,|0|GRAY", "4\t1,|1,|Integer.MAX_VALUE|WHITE", "5\t||Integer.MAX_VALUE|WHITE"]
    lines = spark.createDataFrame([(t,) for t in text], "value string")
    nodes = parse_search_graph(lines)
    assert sorted(r[0] for r in nodes.select(search_lines(nodes)).collect()) == sorted(text)
    r = {x.id: x for x in nodes.collect()}
    assert r[4].dist is None and r[1].color == GRAY and [tuple(o) for o in r[1].out] == [(2, 1), (3, 10)]
    res = se.frontier_search_nodes(nodes, 2)
    got = {x.id: (x.dist, x.color) for x in res.collect()}
    assert got[2] == (1, BLACK) and got[3] == (10, BLACK) and got[4] == (None, WHITE)


def test_search_first_occurrence_weight(spark):
    lines = spark.createDataFrame([("1\t2,3,2,|5,1,9,|0|GRAY",)], "value string")
    got = {(r.src, r.dst, r.w) for r in se.search_edges(parse_search_graph(lines)).collect()}
    assert got == {(1, 2, 5), (1, 3, 1)}


def test_adjacency_text_round_trip(spark, g1_nodes):
    got = sorted(r[0] for r in g1_nodes.select(adjacency_lines(g1_nodes)).collect())
    assert got == ["1\t2,4|0.2", "2\t3,5|0.2", "3\tNULL|0.2", "4\t5|0.2", "5\t1,2,3|0.2"]
    again = parse_adjacency(g1_nodes.select(adjacency_lines(g1_nodes).alias("value")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, g1_nodes.collect()))


def test_lenient_parsing_drops_bad_rows(spark):
    lines = spark.createDataFrame([("1 2",), ("x 3",), ("",), ("4 5 extra",)], "value string")
    assert sorted(map(tuple, parse_edge_list(lines, strict=False).collect())) == [(1, 2), (4, 5)]
    with pytest.raises(Exception):
        parse_edge_list(lines).collect()


def test_gray_without_distance_fails(spark):
    st = spark.createDataFrame([(1, None, GRAY)], "id bigint, dist bigint, color int")
    e = spark.createDataFrame([(1, 2, 1)], "src bigint, dst bigint, w bigint")
    with pytest.raises(Exception):
        se.frontier_search(st, e, 1).collect()


def test_search_monotone_over_iterations(spark):
    """Distances never rise and colours never lighten from one iteration to
    the next (driver tables, smallest scale)."""
    import os
    from textgraph import workloads as wl
    from textgraph.sources import tables as tb
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("driver tables not present")
    st, e = wl._search_state(spark, sf), tb.weighted_edges(spark, sf)
    prev = None
    for k in range(0, 5):
        cur = {r.id: (r.dist, r.color) for r in se.frontier_search(st, e, k).collect()}
        if prev is not None:
            for i, (d, c) in prev.items():
                d2, c2 = cur[i]
                assert c2 >= c
                assert d is None or (d2 is not None and d2 <= d)
        prev = cur


def test_rank_independent_of_partitions(spark, g1_nodes):
    want = _ranks(rk.pagerank_adjacency(g1_nodes, 5, 0.1, 3))
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            _close(_ranks(rk.pagerank_adjacency(g1_nodes, 5, 0.1, 3)), want, 1e-15)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def _exchanges(df):
    """Shuffle exchanges of the statically planned query, counted on the
    physical tree (a cached relation is a leaf there)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "InMemoryTableScanExec":      # a cached input: its own plan ran before
            return 0
        kids = node.children()
        n = 1 if name == "ShuffleExchangeExec" else 0
        return n + sum(walk(kids.apply(i)) for i in range(kids.size()))
    return walk(root)


@pytest.mark.parametrize("group_edges", [100_000, 1])
def test_loop_moves_only_node_side(spark, group_edges):
    """One iteration exchanges the salted node values and the per-target
    sums -- never the cached edge layout or the node state."""
    e = spark.createDataFrame([(s, d) for s in range(1, 30) for d in range(1, 30) if (s * d) % 7 == 1],
                              "src bigint, dst bigint")
    g = rk.prepare(None, e, None, 0.1, dedupe=True, share_to_range=False, group_edges=group_edges)
    try:
        assert _exchanges(rk.step(g, g.state, g.mass, g.n_dangling)) == 2
    finally:
        g.release()
    st = spark.range(1, 30).select("id", F.when(F.col("id") == 1, F.lit(0)).cast("bigint").alias("dist"),
                                   F.when(F.col("id") == 1, F.lit(GRAY)).otherwise(F.lit(WHITE)).alias("color"))
    layout, states = se._prepare(st, e.withColumn("w", F.lit(1).cast("bigint")), group_edges)
    try:
        touched = se._touched(layout, states.frontier)
        assert _exchanges(touched) <= 3 and _exchanged_scans(touched) == {"frontier"}
        rows = spark.createDataFrame(touched.collect(), touched.schema)
        old = states.of(rows, se.FEW_NODES + 1)          # too many for a filter by ids: joined by buckets
        assert "base" not in _exchanged_scans(old)
    finally:
        layout.release()


def _exchanged_scans(df) -> set:
    """What the files scanned below a shuffle of the static plan hold."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = set()

    def walk(node, below, joined):
        name = node.getClass().getSimpleName()
        if name == "FileSourceScanExec" and below and not joined:
            text = node.toString()
            found.add("edges" if re.search(r"\bsalt#", text) else "frontier" if "EqualTo(color,1)" in text else "base")
        kids = node.children()
        below = below or name == "ShuffleExchangeExec"
        joined = name.endswith("JoinExec") or (joined and name != "ShuffleExchangeExec")
        for i in range(kids.size()):
            walk(kids.apply(i), below, joined)
    walk(root, False, False)
    return found


def test_string_ids(spark, g1_edges):
    """Ids may be strings; results equal those on numbers."""
    s = g1_edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    got = {int(k): v for k, v in _ranks(rk.pagerank_edges(s, 3, 0.1)).items()}
    _close(got, dict(zip(range(1, 6), G1[3])))
    st = spark.createDataFrame([("1", 0, GRAY), ("2", None, WHITE)], "id string, dist bigint, color int")
    e = spark.createDataFrame([("1", "2", 3), ("2", "x", 4)], "src string, dst string, w bigint")
    got = {r.id: r.dist for r in se.frontier_search(st, e, 3).collect()}
    assert got == {"1": 0, "2": 3, "x": 7}


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "src bigint, dst bigint")
    assert rk.pagerank_edges(e, 3).count() == 0
    assert gr.node_count(e).first().n == 0
    rows = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id bigint, rank double")
    got = _ranks(rk.pagerank_rows(rows, e, 2, 0.2, 1))       # all dangling
    _close(got, {1: 0.5, 2: 0.5})
    st = spark.createDataFrame([(1, 0, GRAY)], "id bigint, dist bigint, color int")
    we = spark.createDataFrame([], "src bigint, dst bigint, w bigint")
    assert [tuple(r) for r in se.frontier_search(st, we, 3).collect()] == [(1, 0, BLACK)]


def test_layout_is_kept_for_a_later_run(spark, g1_edges, g1_nodes, tmp_path):
    """A layout with a path is built once; a second run opens it (its edges
    are not read) and still exchanges the node side only."""
    want = dict(zip(range(1, 6), G1[3]))
    path = str(tmp_path / "layout")
    settings = {k: v for k, v in spark.conf.getAll.items()}
    _close(_ranks(rk.pagerank_edges(g1_edges, 3, 0.1, layout_path=path, edge_partitions=3)), want)
    nothing = g1_edges.where(F.raise_error(F.lit("read again")).cast("string").isNull())
    _close(_ranks(rk.pagerank_edges(nothing, 3, 0.1, layout_path=path)), want)
    assert {k: v for k, v in spark.conf.getAll.items()} == settings        # no setting touched
    g = rk.prepare(None, nothing, None, 0.1, dedupe=True, share_to_range=False, layout_path=path)
    try:
        assert g.layout.partitions == 3
        plan = rk._contributions(g, g.state)
        assert "edges" not in _exchanged_scans(plan)
    finally:
        g.release()
    _close(_ranks(rk.pagerank_edges(nothing, 3, 0.1, layout_path=path)), want)     # released, still there
    with pytest.raises(ValueError):
        se.frontier_search(spark.createDataFrame([(1, 0, GRAY)], "id bigint, dist bigint, color int"),
                           g1_edges.withColumn("w", F.lit(1)), 1, layout_path=path)


def test_layout_opens_in_another_application(g1_edges, tmp_path):
    import os
    import subprocess
    import sys
    path = str(tmp_path / "layout")
    want = _ranks(rk.pagerank_edges(g1_edges, 3, 0.1, layout_path=path))
    code = """
import sys
from textgraph.session import local_session
from textgraph.operators import rank as rk
spark = local_session(cpus=1, shuffle_partitions=2)
none = spark.createDataFrame([], "src bigint, dst bigint")
print({r.id: r.rank for r in rk.pagerank_edges(none, 3, 0.1, layout_path=sys.argv[1]).collect()})
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, path], cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    _close(eval(out.stdout.strip().splitlines()[-1]), want)


def test_empty_edge_field_is_dangling(spark):
    lines = spark.createDataFrame([("1 |0.5",), ("2\t1,|0.5",)], "value string")
    nodes = {r.id: r for r in parse_adjacency(lines).collect()}
    assert nodes[1].out is None and nodes[2].out == [1]
    got = _ranks(rk.pagerank_adjacency(parse_adjacency(lines), 2, 0.2, 1))
    _close(got, {1: 0.8 * (0.5 + 0.25) + 0.1, 2: 0.8 * 0.25 + 0.1})


def test_zero_iterations(g1_edges):
    assert rk.pagerank_edges(g1_edges, 0, 0.1, history=True).count() == 0
    _close(_ranks(rk.pagerank_edges(g1_edges, 0, 0.1)), {i: 0.2 for i in range(1, 6)})


def test_strict_parsing_without_ansi(spark):
    lines = spark.createDataFrame([("1 2",), ("x 3",)], "value string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            parse_edge_list(lines).collect()
        bad = spark.createDataFrame([("1\t2,y,|1,1,|0|GRAY",)], "value string")
        with pytest.raises(Exception):
            parse_search_graph(bad).collect()
        assert parse_edge_list(lines, strict=False).count() == 1
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_search_independent_of_partitions(spark):
    st, e = _search_rows(spark, F1)
    want = sorted(tuple(r) for r in se.frontier_search(st, e, 3).collect())
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert sorted(tuple(r) for r in se.frontier_search(st, e, 3).collect()) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


_MALFORMED = [
    (parse_edge_list, "7"), (parse_edge_list, "x 3"), (parse_edge_list, "3 y"),
    (parse_adjacency, "7"), (parse_adjacency, "7 2,3"), (parse_adjacency, "7 2,x|0.5"), (parse_adjacency, "7 2|z"),
    (parse_adjacency, "z 2|0.5"),
    (parse_search_graph, "7 2,|1,|0|GRAY"), (parse_search_graph, "7\t2,3,|5,|0|GRAY"),
    (parse_search_graph, "7\t2,|5,6,|0|GRAY"), (parse_search_graph, "7\t2,x,|5,6,|0|GRAY"),
    (parse_search_graph, "7\t2,|y,|0|GRAY"), (parse_search_graph, "7\t2,|1,|q|GRAY"),
    (parse_search_graph, "7\t2,|1,|0|PINK"), (parse_search_graph, "7\t2,|1,|0"), (parse_search_graph, "7\t2,|1,"),
    (parse_search_graph, "x\t2,|1,|0|GRAY"),
]
_GOOD = {parse_edge_list: "1 2", parse_adjacency: "1\t2|0.5", parse_search_graph: "1\t2,|3,|Integer.MAX_VALUE|WHITE"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_rows_fail_or_are_dropped_whole(spark, ansi):
    """Strict readers fail on each, also when only another column is read;
    lenient ones drop the row and keep the good one and blank lines out."""
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for parse, good in _GOOD.items():
            bad = [line for p, line in _MALFORMED if p is parse]
            lines = spark.createDataFrame([(x,) for x in [good, "", " \t ", *bad]], "value string").coalesce(1)
            assert parse(lines, strict=False).count() == 1
            assert parse(lines.where(F.col("value") == good)).count() == 1
            last = parse(lines).columns[-1]
            for line in bad:
                with pytest.raises(Exception, match="malformed row"):
                    parse(lines.where(F.col("value") == line)).select(last).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_search_edges_is_linear(spark):
    nodes = spark.range(1).select(F.lit(1).cast("bigint").alias("id"), F.transform(
        F.sequence(F.lit(1), F.lit(60_000)),
        lambda i: F.struct((i % 40_000).cast("bigint").alias("dst"), i.cast("bigint").alias("w"))).alias("out"))
    got = se.search_edges(nodes)
    assert got.count() == 40_000 and got.where("w > 40000").count() == 0       # the first occurrence's weight


def test_snapshots_are_replaced_and_resumed(spark, g1_edges, g1_nodes, tmp_path):
    path = str(tmp_path / "ranks")
    run = lambda **kw: sorted(map(tuple, rk.pagerank_adjacency(
        g1_nodes, 5, 0.1, 4, history=True, snapshot_path=path, **kw).collect()))
    first = run()
    assert len(first) == 20 and run() == first                       # the same path again
    resumed = run(resume_from=2)
    assert [r[:2] for r in resumed] == [r[:2] for r in first]
    assert all(abs(a[2] - b[2]) < 1e-15 for a, b in zip(first, resumed))
    st, e = _search_rows(spark, F1)
    path = str(tmp_path / "search")
    find = lambda **kw: sorted(map(tuple, se.frontier_search(st, e, 4, history=True, **kw).collect()))
    whole = find()
    assert len(whole) == 16 and find(snapshot_path=path) == whole == find(snapshot_path=path)
    assert find(snapshot_path=path, resume_from=2) == whole
    one = {r[1:] for r in whole if r[0] == 1}
    assert one == {tuple(r) for r in se.frontier_step(st, e).collect()}
    with pytest.raises(ValueError):
        find(resume_from=1)


def test_hot_sources_beyond_the_broadcast_bound(spark):
    from textgraph.plans.skew import salted_layout
    e = spark.createDataFrame([(1, d, 1) for d in range(2, 60)] + [(d, 1, 1) for d in range(2, 60)],
                              "src bigint, dst bigint, mult bigint")
    layout = salted_layout(e, ["mult"], {"outdeg": F.sum("mult")}, group_edges=10, broadcast_rows=0,
                           partitions=2)
    try:
        rows = layout.edges.collect()
        assert len(rows) == 116 and len({r.salt for r in rows if r.src == 1}) > 1
        groups = layout.edges.groupBy("src", "salt").count().agg(F.max("count")).first()[0]
        assert groups < 25
    finally:
        layout.release()


def test_nothing_is_cached_during_the_loop(spark, g1_edges):
    g1_edges.count()                # the fixture's own cache
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    g = rk.prepare(None, g1_edges, None, 0.1, dedupe=True, share_to_range=False)
    try:
        assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
        assert not spark.catalog.listTables()
    finally:
        g.release()


def test_history_is_one_pruned_scan(spark, g1_nodes, tmp_path):
    """Whatever the number of iterations, and only those of this run."""
    path = str(tmp_path / "ranks")
    for iters in (6, 2):
        h = rk.pagerank_adjacency(g1_nodes, 5, 0.1, iters, history=True, snapshot_path=path)
        plan = h._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan and f"<= {iters}" in plan
        assert {r.iteration for r in h.select("iteration").distinct().collect()} == set(range(1, iters + 1))


def _chain(spark, n: int):
    """A path of n nodes and n/2 nodes beside it: every frontier is one node."""
    e = spark.range(1, n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).cast("bigint").alias("w"))
    st = spark.range(1, n + n // 2).select("id", F.when(F.col("id") == 1, 0).cast("bigint").alias("dist"),
                                          F.when(F.col("id") == 1, GRAY).otherwise(WHITE).alias("color"))
    return st, e


def test_delta_search_writes_what_the_frontier_changes(spark):
    st, e = _chain(spark, 4000)
    layout, states = se._prepare(st, e, 100_000)
    try:
        for i in range(1, 5):
            se._advance(layout, states, i)
        rows = {r.iteration: r["count"] for r in states.changes().groupBy("iteration").count().collect()}
        assert rows == {1: 2, 2: 2, 3: 2, 4: 2}                      # one turns BLACK, one GRAY
        base = states.base.frame                     # a lookup of one node reads one bucket
        assert base.where(F.col("id").isin([7])).rdd.getNumPartitions() == 1 < base.rdd.getNumPartitions()
    finally:
        layout.release()


def test_delta_search_compacts_and_keeps_history(spark, monkeypatch):
    st, e = _chain(spark, 40)
    monkeypatch.setattr(se, "COMPACT_ROUNDS", 2)
    h = se.frontier_search(st, e, 6, history=True)
    per = {(r.iteration, r.color): r["count"] for r in h.groupBy("iteration", "color").count().collect()}
    assert all(per[i, GRAY] == 1 and per[i, BLACK] == i for i in range(1, 7)) and h.count() == 6 * 59
    monkeypatch.setattr(se, "FEW_GRAY", -1)                          # every lookup joined by buckets
    got = {r.id: r.dist for r in se.frontier_search(st, e, 6).collect() if r.dist is not None}
    assert got == {i: i - 1 for i in range(1, 8)}


def test_each_line_is_split_once(spark, tmp_path):
    """In the physical plan, with a filter behind the reader: one split a level."""
    spark.range(3).select(F.lit("1\t2,3,|4,5,|0|GRAY").alias("value")).write.text(str(tmp_path / "lines"))
    lines = spark.read.text(str(tmp_path / "lines"))
    for df, splits in ((parse_edge_list(lines, strict=False).where("src > 1 and dst > 1"), 1),
                       (parse_adjacency(lines, strict=False).where("id > 1 and rank > 0 and size(out) > 1"), 3),
                       (parse_search_graph(lines, strict=False).where("id > 1 and dist > 0 and color = 1 and size(out) > 1"), 4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("split(") == splits, plan


def test_blocks_never_grow_with_a_node(spark, tmp_path):
    """A hub with 300,000 targets, one edge of it repeated 5,000 times: rows of
    at most 1,000 targets, through text and back, ranked as the plain edges are."""
    from textgraph.operators import blocks as bl
    n = 300_000
    edges = (spark.range(2, n + 2).select(F.lit(1).cast("bigint").alias("src"), F.col("id").alias("dst"))
             .unionByName(spark.range(5000).select(F.lit(1).cast("bigint").alias("src"), F.lit(9).cast("bigint").alias("dst")))
             .unionByName(spark.range(2, 100).select(F.col("id").alias("src"), F.lit(1).cast("bigint").alias("dst"))))
    ranks = spark.range(1, 120).select("id", F.lit(0.25).alias("rank"))
    blocks = bl.adjacency_blocks(edges, ranks, 1000)
    path = str(tmp_path / "blocks")
    bl.write_adjacency_blocks(blocks, path, 3)
    back = bl.read_adjacency_blocks(spark, path, 1 << 18)
    assert back.agg(F.max(F.size("out"))).first()[0] <= 1000
    assert back.where("out is null").count() == 20 and back.where("id = 1").count() >= 305
    key = ["src", "dst"]
    assert bl.block_edges(back).groupBy(*key).count().exceptAll(edges.groupBy(*key).count()).count() == 0
    assert bl.block_edges(back).count() == edges.count()
    got = bl.pagerank_blocks(back, n + 1, 0.1, 2)
    want = rk.pagerank_rows(ranks, edges, n + 1, 0.1, 2).withColumnRenamed("rank", "r")
    met = got.join(want, "id", "full")
    assert met.where("rank is null or r is null or abs(rank - r) > 1e-12").count() == 0 and met.count() == n + 1
    assert bl.with_ranks(blocks, got).where("id = 1 and size(out) > 1000").count() == 0


def test_scatter_carries_the_edges(spark, g1_nodes):
    got = {r.id: (r.out, r.rank) for r in rk.pagerank_scatter(
        g1_nodes, rk.adjacency_edges(g1_nodes)).collect()}
    assert got[1][0] == [2, 4] and got[3][0] is None and got[-1][0] is None and abs(got[-1][1] - 0.2) < 1e-12
