"""Streaming use of the text counters, and the text sinks."""

import os

from pyspark.sql import functions as F

from textgraph.operators import index as ix
from textgraph.operators import rank as rk
from textgraph.operators import text as tx
from textgraph.sinks import text as sk
from textgraph.sources.lines import read_lines
from textgraph.streaming.text_stream import read_lines_stream, start


def test_running_word_count_matches_batch(spark, data, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    src = data("text_b")
    names = sorted(os.listdir(src))
    (inbox / names[0]).write_bytes(open(os.path.join(src, names[0]), "rb").read())
    q = start(tx.word_count(read_lines_stream(spark, str(inbox))), "wc_stream", output_mode="complete",
              checkpoint=str(tmp_path / "ckpt"))
    try:
        q.processAllAvailable()
        for n in names[1:]:
            (inbox / n).write_bytes(open(os.path.join(src, n), "rb").read())
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.table("wc_stream").collect()}
    finally:
        q.stop()
    want = {r.word: r.n for r in tx.word_count(read_lines(spark, src)).collect()}
    assert got == want


def test_stream_restarts_from_its_stable_folder(tmp_path):
    """Two applications one after the other: the second counts the new file
    only, on top of what the first kept."""
    import subprocess
    import sys
    code = """
import sys
from textgraph.session import local_session
from textgraph.operators import text as tx
from textgraph.streaming.text_stream import read_lines_stream, start
root, ckpt = sys.argv[1:]
spark = local_session(cpus=1, shuffle_partitions=1, extra={"spark.checkpoint.dir": ckpt})
q = start(tx.word_count(read_lines_stream(spark, root)).select("word", "n"), "wc", output_mode="update",
          sink="console")
q.processAllAvailable()
print("ROWS", sum(p["numInputRows"] for p in q.recentProgress))
q.stop()
spark.stop()
"""
    inbox, ckpt = tmp_path / "in", tmp_path / "ckpt"
    inbox.mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    rows = []
    for i in range(2):
        (inbox / f"f{i}").write_text("a b a\n" * (i + 1))
        out = subprocess.run([sys.executable, "-c", code, str(inbox), str(ckpt)], cwd=root, capture_output=True,
                             text=True, timeout=180, env={**os.environ, "PYTHONPATH": root})
        rows.append([ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")])
        tables = out.stdout
    assert rows == [["ROWS 1"], ["ROWS 2"]]
    assert "|   a|  6|" in tables                     # 2 from the first run, 4 more


def test_key_value_and_index_sinks(spark, data, tmp_path):
    lines = read_lines(spark, data("text_c"))
    wc = tx.word_count(lines)
    out = str(tmp_path / "wc")
    sk.write_key_values(wc, "word", "n", out, num_files=3)
    files = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    assert len(files) == 3
    keys = []
    for f in files:                           # sorted inside and across files
        keys += [ln.split("\t")[0] for ln in open(os.path.join(out, f), encoding="utf-8").read().splitlines()]
    assert keys == sorted(keys, key=lambda k: k.encode()) and len(keys) == 1772
    idx = ix.inverted_index(ix.term_postings(lines, "value", "file"), "file", block_size=2)
    iout = str(tmp_path / "idx")
    sk.write_index(idx, iout)
    text = spark.read.text(iout)
    the = [r.value for r in text.collect() if r.value.startswith("the\t")]
    assert "".join(v.split("\t")[1] for v in the) == "file0:266;file1:276;file2:40;file3:164;"


def test_rank_tuple_lines(spark, data):
    from textgraph.sources.graph_text import parse_edge_list
    e = parse_edge_list(read_lines(spark, data("graph", "edges.txt")))
    r = rk.pagerank_edges(e, 1, 0.1)
    got = [x[0] for x in r.select(sk.rank_tuple_lines(r)).collect()]
    assert len(got) == 5 and all(g.startswith("(") and g.endswith(")") for g in got)
    parsed = {int(a): float(b) for a, b in (g[1:-1].split(",") for g in got)}
    want = {r.id: r.rank for r in r.collect()}
    assert parsed == want                      # lossless text form
    assert abs(parsed[4] - 0.146) < 1e-12


def test_word_count_text_query_shape(spark):
    from textgraph import workloads as wl
    df = wl.q_word_count_text(spark, "/root/testdata/sf0.001")
    assert df.columns == ["value"]
    assert df.where(~F.col("value").contains("\t")).count() == 0
