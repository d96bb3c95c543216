"""textgraph: text counting, inverted indexes, PageRank and frontier search
as Spark DataFrame operators.

Main entry points::

    from textgraph.sources.lines import read_lines            # text files -> lines
    from textgraph.operators.text import word_count, bigram_count_lines
    from textgraph.operators.index import term_postings, inverted_index
    from textgraph.operators.rank import pagerank_edges, pagerank_adjacency
    from textgraph.operators.search import frontier_search, bfs_hops

See README.md for the full operator list and docs/SCALE.md for how each
operator is planned on a large cluster.
"""

__version__ = "0.1.0"
