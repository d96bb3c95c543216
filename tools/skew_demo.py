"""How salting spreads a hot source over the edge layout.

    python tools/skew_demo.py [sf_dir]

Edges: the workload graph plus, for every line item with return flag 'N',
an edge from node 1 to a node of its own (a third of all line items, so
node 1 holds about a third of all edges).  The edge layout is built with
salting off (one group per source) and on, and the rows per partition of
the cached layout are reported, plus one PageRank iteration's wall time
and a check that both give the same ranks.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from textgraph.operators import rank as rk
    from textgraph.session import local_session
    from textgraph.sources import tables as tb

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=32)
    base = tb.edge_rows(spark, sf)
    n = tb.node_total(spark, sf)
    hot = (tb.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "N")
           .select(F.lit(1).cast("bigint").alias("src"),
                   (F.lit(n + 1) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("dst")))
    edges = base.unionByName(hot)
    total = edges.count()
    print(f"edges {total}, from node 1: {edges.where('src = 1').count()}")
    ranks = {}
    for label, group in (("no salting", 10 ** 12), ("salting, 20k edges per group", 20_000)):
        g = rk.prepare(None, edges, None, 0.1, dedupe=True, share_to_range=False, group_edges=group)
        sizes = sorted(r["count"] for r in g.layout.edges.groupBy(F.spark_partition_id()).count().collect())
        t = time.time()
        s, m, nd = rk._materialize_observed(rk.step(g, g.state, g.mass, g.n_dangling))
        took = time.time() - t
        ranks[label] = {r.id: r.rank for r in s.select("id", "rank").collect()}
        print(f"{label}: partitions {len(sizes)}, rows per partition max {sizes[-1]}, "
              f"median {sizes[len(sizes) // 2]}, max/median {sizes[-1] / sizes[len(sizes) // 2]:.1f}; "
              f"one iteration {took:.2f}s")
        g.release()
    a, b = ranks.values()
    print("same ranks:", a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12)


if __name__ == "__main__":
    main()
