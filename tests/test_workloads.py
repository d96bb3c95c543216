"""Registered queries: the driver contract, FIXTURES counts on the driver's
tables, and the DuckDB oracle on the smallest scale."""

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
have = pytest.mark.skipif(not os.path.exists(SF001), reason="driver tables not present")


@have
def test_entry_and_registry(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    assert df.columns == ["word", "block", "postings"]
    assert df.count() > 0
    q, s = ent.queries(), ent.oracle_sql()
    assert set(s) <= set(q) and len(ent._wl.all_queries()) == len(ent._oracle.all_sql())
    assert len(q) >= 26


@have
def test_fixture_counts_sf001(spark):
    from textgraph import workloads as wl
    assert wl.q_line_count(spark, SF001).first().n == 9344
    wc = wl.q_word_count(spark, SF001)
    assert wc.count() == 93796 and wc.agg(F.sum("n")).first()[0] == 390171
    bc = wl.q_bigram_count(spark, SF001)
    assert bc.count() == 267359 and bc.agg(F.sum("n")).first()[0] == 389171
    assert wl.q_node_count(spark, SF001).first().n == 2125
    assert wl.q_distinct_edges(spark, SF001).count() == 55331
    assert wl.q_dangling_nodes(spark, SF001).count() == 25
    assert wl.q_implicit_nodes(spark, SF001).count() == 25
    assert wl.q_edge_list(spark, SF001).count() == 60_100      # every line item and supplier


@have
def test_frontier_counts_sf001(spark):
    from textgraph import workloads as wl
    from textgraph.operators import search as se
    from textgraph.sources import tables as tb
    st, e = wl._search_state(spark, SF001), tb.weighted_edges(spark, SF001)
    h = se.frontier_search(st, e, 6, history=True).groupBy("iteration", "color").count().collect()
    c = {(r.iteration, r.color): r["count"] for r in h}
    for k, want in ((1, (2076, 23, 1)), (2, (267, 1823, 24)), (3, (190, 77, 1847)), (4, (0, 201, 1924)), (6, (0, 0, 2125))):
        assert tuple(c.get((k, x), 0) for x in range(3)) == want, k


@have
def test_oracle_sf0001(spark):
    from oracle_check import compare

    from textgraph import workloads as wl
    res = compare(spark, SF0001, list(wl.all_queries()), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] == "MISMATCH"}
    assert not bad


@have
def test_oracle_types_sf0001(spark):
    """Column names and types of every query equal those of its SQL."""
    import __spark_entry__ as ent
    from oracle_check import duck

    from textgraph import workloads as wl
    con = duck(SF0001)
    names = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    for name, q in wl.all_queries().items():
        got = {f.name: names.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in q(spark, SF0001).schema.fields}
        want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ent.oracle_sql()[name]}").fetchall()}
        assert got == want, name


@have
def test_lineitem_is_scanned_once_per_edge_frame(spark):
    from textgraph import workloads as wl
    from textgraph.operators import graph as gr
    from textgraph.sources import tables as tb
    e = tb.edge_rows(spark, SF0001)
    for df in (e, gr.node_ids(e), gr.distinct_edges(e)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 1 and "Filter (isnotnull(l_" not in plan
    assert "implicit_nodes" in wl.all_queries()


def test_coarse_inputs_are_spread_within_a_byte_bound(spark, tmp_path):
    from textgraph.plans.partitioning import spread_coarse
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan(spread_coarse(df, ["id"]))
    assert "RepartitionByExpression" not in plan(spread_coarse(df, ["id"], most_bytes=10))
