"""The registered queries: each operator applied to the driver's tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names and types equal those of the matching SQL in
:mod:`textgraph.oracle_sql`.  They run over the whole tables; nothing is
sampled, capped or filtered by id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.functions.graph import GRAY, WHITE, color_name
from textgraph.operators import blocks as bl
from textgraph.operators import files as fl
from textgraph.operators import graph as gr
from textgraph.operators import index as ix
from textgraph.operators import rank as rk
from textgraph.operators import search as se
from textgraph.operators import text as tx
from textgraph.plans.heavy import with_partition
from textgraph.plans.lineage import materialize
from textgraph.session import checkpoint_dir
from textgraph.sinks import text as sk
from textgraph.sinks.files import write_partitions
from textgraph.sources import graph_text as gt
from textgraph.sources import tables as tb
from textgraph.sources.lines import lines_of_texts, read_lines

# Parameters of the registered queries (fixed, shared with the SQL oracle).
POSTING_BLOCK = 256          # documents per posting-list row
ALPHA = 0.1                  # jump probability (the reference's run uses 0.1)
ADJ_ITERS = 4                # the adjacency form's default iteration count
EDGE_ITERS = 10              # iterations of the edge-list form's run
SEARCH_ITERS = 6             # frontier iterations
SEARCH_SOURCE = 1            # the node marked GRAY with distance 0
RANK_DIGITS = 10             # ranks are compared after rounding (sum order differs)
LINE_BLOCK = 8               # lines per emulated input split (line-stream bigrams)
LIST_BLOCK = 8               # targets per row of the graph text queries
FILES = 6                    # text files that the documents are written to
SPLIT_BYTES = 1 << 16        # input splits that they are read by
COUNT_FILES = 4              # files of the sorted word counts
INDEX_FILES = 3              # files of the index, partitioned by word (the reference's run has 3)
FILE_BLOCK = 2               # files per posting block of that index
WORD_PARTITIONS = 16         # partitions that words are dealt to
HEAVY_WORD = 1 / 256         # a word with a larger share of all tokens goes to several
BLOCK_TARGETS = 16           # targets per row of the blocked adjacency lists
GRAPH_FILES = 4              # text files that they are written to
RANK_UNIT = 8                # their ranks are out-degree / 8: exact in text on either engine


# --- text -------------------------------------------------------------------

def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.tokenize(tb.documents(spark, sf_dir), "text", keep=["doc_id"])


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.word_count(tb.documents(spark, sf_dir), "text")


def q_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.line_count(tb.documents(spark, sf_dir), "text", rows_are_lines=False)


def q_word_count_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.word_count_with_total(tb.documents(spark, sf_dir), "text", rows_are_lines=False)


def q_bigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.bigram_count(tb.documents(spark, sf_dir), "text")


def _split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a "file" read as lines, cut into input splits of
    ``LINE_BLOCK`` lines."""
    return (lines_of_texts(tb.documents(spark, sf_dir), "text", keep=["doc_id"])
            .withColumn("split", F.floor(F.col("line_no") / F.lit(LINE_BLOCK))))


def q_bigram_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line-stream form: pairs are stitched across lines and splits and
    must equal the whole-text bigram count."""
    return tx.bigram_count_lines(_split_lines(spark, sf_dir), "value", file="doc_id", block="split", rid="line_no")


def q_bigram_count_lines_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the number of input splits under its key."""
    return tx.bigram_count_lines_with_total(
        _split_lines(spark, sf_dir), "value", file="doc_id", block="split", rid="line_no")


def q_input_unit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.input_unit_count(tb.documents(spark, sf_dir), ["doc_id"])


def q_bigram_count_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.bigram_count_with_total(tb.documents(spark, sf_dir), "text", ["doc_id"])


def q_term_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.term_postings(tb.documents(spark, sf_dir), "text", "doc_id")


def q_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = ix.term_postings(tb.documents(spark, sf_dir), "text", "doc_id")
    return ix.inverted_index(posts, "doc_id", block_size=POSTING_BLOCK)


def q_postings_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = ix.term_postings(tb.documents(spark, sf_dir), "text", "doc_id")
    return ix.postings_sorted(posts, "doc_id")


def q_word_count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    wc = tx.word_count(tb.documents(spark, sf_dir), "text")
    return wc.select(sk.key_value_lines(wc, "word", "n").alias("value"))


def q_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = q_inverted_index(spark, sf_dir)
    return idx.select(sk.index_lines(idx).alias("value"))


# --- text files ---------------------------------------------------------------
# The documents as text files in the shared folder: document d in file d modulo
# FILES, documents in order, each followed by a line end.  The files are read
# back by byte ranges, as any input would be.

def _shared(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _document_files(spark: SparkSession, sf_dir: str) -> str:
    docs = tb.table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.pmod("doc_id", F.lit(FILES)), F.lit(0)).cast("int").alias("part"))
    path = _shared(spark, "document-files")
    write_partitions(docs, F.col("text"), "part", ["doc_id", "text"], path, FILES, prefix="docs-")
    return path


def q_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _document_files(spark, sf_dir)
    lines = fl.line_count_files(read_lines(spark, path, SPLIT_BYTES))
    return (fl.input_splits(spark, path, SPLIT_BYTES).join(lines, "file", "left")
            .select("file", "bytes", "splits", F.coalesce("n", F.lit(0)).alias("n")))


def q_file_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.word_count_files(read_lines(spark, _document_files(spark, sf_dir), SPLIT_BYTES))


def q_file_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.bigram_count_files(spark, _document_files(spark, sf_dir), SPLIT_BYTES)


def q_file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in, index files out: each line of the index and the file it is in."""
    # stored, as the index reads them twice
    posts = materialize(ix.term_postings(read_lines(spark, _document_files(spark, sf_dir), SPLIT_BYTES)))
    path = _shared(spark, "index-files")
    sk.write_index_by_word(ix.inverted_index(posts, block_size=FILE_BLOCK), path, INDEX_FILES)
    return read_lines(spark, path, SPLIT_BYTES).select("file", "value")


def q_word_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word counts as sorted files of ascending ranges, read back in (file, position) order."""
    path = _shared(spark, "word-files")
    sk.write_key_values(tx.word_count(tb.documents(spark, sf_dir), "text"), "word", "n", path, COUNT_FILES)
    pair = F.split("value", "\t")
    rows = read_lines(spark, path, SPLIT_BYTES).withColumn("word", pair[0]).withColumn("n", pair[1].cast("bigint"))
    return fl.with_order_check(rows, "word").select("word", "n", "ordered")


def q_word_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences per word and the partition they are dealt to."""
    each = tx.tokenize(tb.documents(spark, sf_dir), "text", keep=["doc_id"], token="word")
    parted = with_partition(each, "word", F.col("doc_id"), WORD_PARTITIONS, share=HEAVY_WORD)
    return parted.groupBy("word", F.col("part").cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("n"))


TEXT_QUERIES = {
    "tokenize": q_tokenize,
    "word_count": q_word_count,
    "line_count": q_line_count,
    "word_count_with_total": q_word_count_with_total,
    "bigram_count": q_bigram_count,
    "bigram_count_lines": q_bigram_count_lines,
    "bigram_count_lines_with_total": q_bigram_count_lines_with_total,
    "input_unit_count": q_input_unit_count,
    "bigram_count_with_total": q_bigram_count_with_total,
    "term_postings": q_term_postings,
    "inverted_index": q_inverted_index,
    "postings_sorted": q_postings_sorted,
    "word_count_text": q_word_count_text,
    "index_text": q_index_text,
    "file_lines": q_file_lines,
    "file_words": q_file_words,
    "file_bigrams": q_file_bigrams,
    "file_index": q_file_index,
    "word_files": q_word_files,
    "word_partitions": q_word_partitions,
}



# --- graph ------------------------------------------------------------------

def _rounded(df: DataFrame, col: str = "rank") -> DataFrame:
    return df.withColumn(col, F.round(col, RANK_DIGITS))


def _adjacency_rows(spark: SparkSession, sf_dir: str):
    n = tb.node_total(spark, sf_dir)
    rows = tb.node_ids(spark, sf_dir).select("id", F.lit(1.0 / n).alias("rank"))
    return rows, n


def q_edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tb.edge_rows(spark, sf_dir).select(F.concat_ws(" ", "src", "dst").alias("value"))
    return gt.parse_edge_list(lines)


def q_distinct_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.distinct_edges(tb.edge_rows(spark, sf_dir))


def q_out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.out_degree(gr.distinct_edges(tb.edge_rows(spark, sf_dir)))


def q_dangling_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.dangling_nodes(tb.edge_rows(spark, sf_dir))


def q_node_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.node_count(tb.edge_rows(spark, sf_dir))


def q_implicit_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.implicit_nodes(tb.node_ids(spark, sf_dir), tb.edge_rows(spark, sf_dir))


def q_rank_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gr.rank_init(tb.edge_rows(spark, sf_dir)))


def q_rank_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tb.edge_rows(spark, sf_dir)
    return _rounded(rk.rank_contributions(e, gr.rank_init(e)), "contrib")


def q_dangling_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tb.edge_rows(spark, sf_dir)
    return _rounded(rk.dangling_mass(gr.rank_init(e), e), "mass")


def q_pagerank_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = _adjacency_rows(spark, sf_dir)
    return _rounded(rk.pagerank_scatter(rows, tb.edge_rows(spark, sf_dir), n))


def q_pagerank_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = _adjacency_rows(spark, sf_dir)
    return _rounded(rk.pagerank_rows(rows, tb.edge_rows(spark, sf_dir), n, ALPHA, ADJ_ITERS))


def q_pagerank_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = _adjacency_rows(spark, sf_dir)
    h = rk.pagerank_rows(rows, tb.edge_rows(spark, sf_dir), n, ALPHA, ADJ_ITERS, history=True)
    return _rounded(h.withColumn("iteration", F.col("iteration").cast("bigint")))


def q_pagerank_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rk.pagerank_edges(tb.edge_rows(spark, sf_dir), EDGE_ITERS, ALPHA))


def _search_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = F.col("id") == F.lit(SEARCH_SOURCE)
    return tb.node_ids(spark, sf_dir).select(
        "id", F.when(src, F.lit(0)).cast("bigint").alias("dist"),
        F.when(src, F.lit(GRAY)).otherwise(F.lit(WHITE)).alias("color"))


def _named(df: DataFrame) -> DataFrame:
    return df.select("id", "dist", color_name("color").alias("color"))


def q_frontier_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(se.frontier_step(_search_state(spark, sf_dir), tb.weighted_edges(spark, sf_dir)))


def q_frontier_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(se.frontier_search(_search_state(spark, sf_dir), tb.weighted_edges(spark, sf_dir),
                                     SEARCH_ITERS))


def q_bfs_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(se.bfs_hops(_search_state(spark, sf_dir), tb.edge_rows(spark, sf_dir), SEARCH_ITERS))


def q_frontier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = se.frontier_search(_search_state(spark, sf_dir), tb.weighted_edges(spark, sf_dir), SEARCH_ITERS, history=True)
    return h.select(F.col("iteration").cast("bigint").alias("iteration"), "id", "dist", color_name("color").alias("color"))


# Graph text formats.  A node's whole list would be one unbounded row, so a row
# holds a node's targets of one block of ids, as the posting blocks do.

def _adjacency_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, out, rank)``: a row per source and block of targets, and a row
    without targets per nation."""
    e = gr.distinct_edges(tb.edge_rows(spark, sf_dir))
    deg = gr.out_degree(e).select("id", (F.col("out_degree") / RANK_UNIT).alias("rank"))
    blocks = (e.groupBy(F.col("src").alias("id"), F.expr(f"dst div {LIST_BLOCK}").alias("_b"))
              .agg(F.sort_array(F.collect_list("dst")).alias("out")))
    rows = blocks.join(deg, "id").select("id", "out", "rank")
    lone = gr.dangling_nodes(e).select("id", F.lit(None).cast("array<bigint>").alias("out"), F.lit(0.0).alias("rank"))
    return rows.unionByName(lone)


def _search_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search rows ``(id, out, dist, color)``; each target stands twice, its
    smallest weight first."""
    q = tb.quantity_range(spark, sf_dir)
    pair = F.array(*[F.struct("dst", F.col(c).alias("w")) for c in ("least", "most")])
    source = F.col("id") == SEARCH_SOURCE
    return (q.groupBy(F.col("src").alias("id"), F.expr(f"dst div {LIST_BLOCK}").alias("_b"))
            .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("dst", pair.alias("p")))),
                                       lambda x: x["p"])).alias("out"))
            .select("id", "out", F.when(source, F.lit(0)).cast("bigint").alias("dist"),
                    F.when(source, F.lit(GRAY)).otherwise(F.lit(WHITE)).alias("color")))


def q_adjacency_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _adjacency_blocks(spark, sf_dir)
    return rows.select(sk.adjacency_lines(rows).alias("value"))


def q_adjacency_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = gt.parse_adjacency(q_adjacency_text(spark, sf_dir))
    return nodes.select("id", "rank", F.explode_outer("out").alias("dst"))


def q_search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _search_blocks(spark, sf_dir)
    return rows.select(sk.search_lines(rows).alias("value"))


def q_search_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = gt.parse_search_graph(q_search_text(spark, sf_dir))
    return (nodes.select("id", "dist", color_name("color").alias("color"), F.explode("out").alias("e"))
            .select("id", F.col("e.dst").alias("dst"), F.col("e.w").alias("w"), "dist", "color"))


def q_first_weight_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.search_edges(gt.parse_search_graph(q_search_text(spark, sf_dir)))


def q_rank_tuple_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    deg = gr.out_degree(gr.distinct_edges(tb.edge_rows(spark, sf_dir)))
    ranks = deg.select("id", (F.col("out_degree") / RANK_UNIT).alias("rank"))
    return ranks.select(sk.rank_tuple_lines(ranks).alias("value"))


# Blocked adjacency lists (a node's targets in rows of at most BLOCK_TARGETS).

def _blocks(spark: SparkSession, sf_dir: str):
    rows, n = _adjacency_rows(spark, sf_dir)
    return bl.adjacency_blocks(tb.edge_rows(spark, sf_dir), rows, BLOCK_TARGETS), n


def q_adjacency_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node its targets (repeats counted) and whether every block keeps its size."""
    blocks, _ = _blocks(spark, sf_dir)
    size = F.coalesce(F.size("out"), F.lit(0))
    return blocks.groupBy("id").agg(
        F.sum(F.when(F.col("out").isNull(), 0).otherwise(size)).cast("bigint").alias("targets"),
        F.max(F.array_max("out")).alias("largest"), F.min(size <= BLOCK_TARGETS).alias("fits"))


def q_pagerank_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph as adjacency text files of blocks, read back by splits and ranked."""
    blocks, n = _blocks(spark, sf_dir)
    path = _shared(spark, "adjacency-files")
    bl.write_adjacency_blocks(blocks, path, GRAPH_FILES)
    return _rounded(bl.pagerank_blocks(bl.read_adjacency_blocks(spark, path, SPLIT_BYTES), n, ALPHA, ADJ_ITERS))


# The graph of the parts alone: only parts have rows and edges, so suppliers are
# targets without a row; the nations, with no edge to them here, are neither.

def _part_graph(spark: SparkSession, sf_dir: str):
    parts, n = tb.part_total(spark, sf_dir), tb.node_total(spark, sf_dir)
    rows = tb.node_ids(spark, sf_dir).where(F.col("id") <= parts).select("id", F.lit(1.0 / n).alias("rank"))
    return rows, tb.edge_rows(spark, sf_dir).where(F.col("src") <= parts), n


def q_implicit_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets without a row, and whether each has out-edges in the whole graph."""
    rows, edges, _ = _part_graph(spark, sf_dir)
    sources = tb.edge_rows(spark, sf_dir).select(F.col("src").alias("id")).distinct().withColumn("source", F.lit(True))
    return gr.implicit_nodes(rows, edges).join(sources, "id", "left").select("id", F.coalesce("source", F.lit(False)).alias("source"))


def q_pagerank_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, edges, n = _part_graph(spark, sf_dir)
    return _rounded(rk.pagerank_rows(rows, edges, n, ALPHA, ADJ_ITERS))


GRAPH_QUERIES = {
    "edge_list": q_edge_list,
    "distinct_edges": q_distinct_edges,
    "out_degree": q_out_degree,
    "dangling_nodes": q_dangling_nodes,
    "node_count": q_node_count,
    "implicit_nodes": q_implicit_nodes,
    "rank_init": q_rank_init,
    "rank_contributions": q_rank_contributions,
    "dangling_mass": q_dangling_mass,
    "pagerank_scatter": q_pagerank_scatter,
    "pagerank_adjacency": q_pagerank_adjacency,
    "pagerank_history": q_pagerank_history,
    "pagerank_edges": q_pagerank_edges,
    "frontier_step": q_frontier_step,
    "frontier_search": q_frontier_search,
    "bfs_hops": q_bfs_hops,
    "frontier_history": q_frontier_history,
    "adjacency_text": q_adjacency_text,
    "adjacency_parse": q_adjacency_parse,
    "search_text": q_search_text,
    "search_parse": q_search_parse,
    "first_weight_edges": q_first_weight_edges,
    "rank_tuple_text": q_rank_tuple_text,
    "adjacency_blocks": q_adjacency_blocks,
    "pagerank_files": q_pagerank_files,
    "implicit_suppliers": q_implicit_suppliers,
    "pagerank_part_rows": q_pagerank_part_rows,
}


def all_queries() -> dict:
    return {**TEXT_QUERIES, **GRAPH_QUERIES}
