"""Print the physical plans of the main query shapes (for plan review).

    python tools/show_plans.py [sf_dir] > docs/PLANS.txt

Text queries are explained directly.  For the loops, the plan of one
iteration is explained after the inputs are prepared (that preparation
runs jobs).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from textgraph import workloads as wl
    from textgraph.operators import rank as rk
    from textgraph.operators import search as se
    from textgraph.session import local_session
    from textgraph.sources import tables as tb

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    qs = wl.all_queries()
    for name in ("word_count", "bigram_count_with_total", "inverted_index", "edge_list", "dangling_nodes"):
        print(f"===== {name} =====", flush=True)
        qs[name](spark, sf).explain()

    print("===== PageRank (edge-list form): one iteration =====", flush=True)
    g = rk.prepare(None, tb.edge_rows(spark, sf), None, 0.1, dedupe=True, share_to_range=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rk.step(g, g.state, g.mass, g.n_dangling).explain()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    g.release()

    print("===== frontier search: one iteration =====", flush=True)
    layout, s, _ = se._prepare(wl._search_state(spark, sf), tb.weighted_edges(spark, sf), 100_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    se._step(layout, s).explain()
    layout.release()


if __name__ == "__main__":
    main()
