"""Real text files: named commits, input splits, partitions that know heavy words."""

import os

import pytest
from pyspark.sql import functions as F

from textgraph.operators import files as fl
from textgraph.operators import index as ix
from textgraph.operators import text as tx
from textgraph.plans.heavy import heavy_keys, with_partition
from textgraph.sinks import text as sk
from textgraph.sinks.files import commit_text, write_partitions
from textgraph.sources.lines import read_lines

SPLIT = 4096


def _books(folder, seed: int = 5) -> dict:
    """Files of other sizes and line ends; one empty, one of a single long line."""
    import random
    rng = random.Random(seed)
    words = ["a", "the", "of", "naïve", "x+y", "100%", "日本", "\x0b"] + [f"w{i}" for i in range(300)]
    text = lambda n, end: "".join(" ".join(rng.choices(words, k=rng.randint(0, 12))) + end for _ in range(n))
    out = {"one.txt": text(900, "\n"), "two b+c.txt": text(500, "\r\n"), "three%20.txt": text(40, "\n")[:-1],
           "empty.txt": "", "long.txt": " ".join(rng.choices(words, k=6000))}
    os.makedirs(folder)
    for name, value in out.items():
        with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
            f.write(value)
    return out


def _tokens(text: str) -> list[str]:
    out = [""]
    for c in text:
        if c in " \t\n\r\f":
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def test_files_by_splits_equal_whole_files(spark, tmp_path):
    books = _books(str(tmp_path / "in"))
    path = str(tmp_path / "in")
    before = dict(spark.conf.getAll)
    lines = read_lines(spark, path, SPLIT)
    starts = lines.select("file", "block_start").distinct().collect()
    assert all(r.block_start % SPLIT == 0 for r in starts) and dict(spark.conf.getAll) == before

    sizes = {r.file: (r.bytes, r.splits) for r in fl.input_splits(spark, path, SPLIT).collect()}
    for name, text in books.items():
        size = len(text.encode())
        if not size:
            assert name not in sizes
            continue
        assert sizes[name] == (size, -(-size // SPLIT))
        seen = {r.block_start // SPLIT for r in starts if r.file == name}
        # rows come from every split in which a line begins; the long line is one row of the first of many splits
        assert seen == ({0} if name == "long.txt" else set(range(sizes[name][1])))

    words = {(r.file, r.word): r.n for r in fl.word_count_files(lines).collect()}
    want = {}
    for name, text in books.items():
        for w in _tokens(text):
            want[name, w] = want.get((name, w), 0) + 1
    assert words == want
    counts = {r.file: r.n for r in fl.line_count_files(lines).collect()}
    assert counts == {"one.txt": 900, "two b+c.txt": 500, "three%20.txt": 40, "long.txt": 1}

    pairs = {}
    for text in books.values():
        tk = _tokens(text)
        for a, b in zip(tk, tk[1:]):
            pairs[f"{a} {b}"] = pairs.get(f"{a} {b}", 0) + 1
    pairs["zzzzzzzzz Times Map task lanched: "] = sum(s for _, s in sizes.values())
    assert {r.bigram: r.n for r in fl.bigram_count_files(spark, path, SPLIT).collect()} == pairs


def test_committed_files_have_names_and_order(spark, tmp_path):
    df = spark.range(1000).select(F.format_string("k%04d", "id").alias("word"), F.col("id").alias("n"))
    path = str(tmp_path / "out")
    sk.write_key_values(df, "word", "n", path, num_files=5)
    assert sorted(f for f in os.listdir(path) if f[0] not in "._") == [f"part-r-{i:05d}" for i in range(5)]
    assert os.path.exists(f"{path}/_SUCCESS") and os.listdir(tmp_path) == ["out"]
    lines = read_lines(spark, path, 512).withColumn("word", F.split("value", "\t")[0])
    got = fl.with_order_check(lines, "word")
    assert got.count() == 1000 and got.where("not ordered").count() == 0 and got.select("word").distinct().count() == 1000
    # a file out of order, and files that overlap, are seen
    shuffled = lines.withColumn("word", F.when(F.col("word") == "k0500", "a").otherwise(F.col("word")))
    assert [r.word for r in fl.with_order_check(shuffled, "word").where("not ordered").collect()] == ["a"]

    with pytest.raises(FileExistsError):
        sk.write_key_values(df, "word", "n", path, num_files=5)
    sk.write_key_values(df.limit(10), "word", "n", path, num_files=2, mode="overwrite")
    assert read_lines(spark, path).count() == 10
    with pytest.raises(Exception):
        commit_text(df.repartition(2), F.raise_error(F.lit("no")).cast("string"), str(tmp_path / "bad"), 2)
    assert os.listdir(tmp_path) == ["out"]                       # nothing is left of a failed commit


def test_partitions_become_files_also_empty_ones(spark, tmp_path):
    df = spark.range(90).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(4).cast("int").alias("part"))
    write_partitions(df, F.col("id").cast("string"), "part", ["id"], str(tmp_path / "p"), 6)
    text = {f: open(tmp_path / "p" / f).read().split() for f in os.listdir(tmp_path / "p") if f.startswith("part")}
    assert sorted(text) == [f"part-r-{i:05d}" for i in range(6)]
    assert text["part-r-00000"] == [str(i) for i in range(0, 90, 3)] and text["part-r-00001"] == []
    assert text["part-r-00004"] == [str(i) for i in range(90) if i % 3]


def _hot(spark, n: int = 60_000):
    """One word holds a third of all rows, one a twentieth, the others one each."""
    i = F.col("id")
    return spark.range(n).select(
        i, F.when(i % 3 == 0, "hot").when(i % 20 == 1, "warm").otherwise(F.concat(F.lit("w"), i.cast("string"))).alias("word"))


def test_heavy_words_are_found_exactly_and_spread(spark):
    df = _hot(spark)
    found, total = heavy_keys(df, "word", 1 / 64)
    want = {r.word: r["count"] for r in df.groupBy("word").count().where(f"count > {60_000 / 64}").collect()}
    assert {r.word: r.n for r in found.collect()} == want and set(want) == {"hot", "warm"} and total == 60_000
    parted = with_partition(df, "word", F.col("id"), 16, share=1 / 64)
    sizes = [r["count"] for r in parted.groupBy("part").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 60_000 / 16      # with hashing alone one holds over 20,000
    per = {r.word: r.parts for r in parted.groupBy("word").agg(F.count_distinct("part").alias("parts")).where("parts > 1").collect()}
    assert per == {"hot": 16, "warm": 3}                          # ceil(n / (share * rows)), at most all
    # the sketch is one aggregate without a shuffle of the words
    top = df.agg(F.expr("approx_top_k(word, 64, 1024)"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in top and "SinglePartition" in top
    # the same function whatever the partitioning of the input
    again = with_partition(df.repartition(7, "id"), "word", F.col("id"), 16, share=1 / 64)
    assert again.exceptAll(parted).count() == 0


def test_heavy_keys_of_no_rows(spark):
    none = spark.createDataFrame([(None, 1)], "word string, id bigint")
    found, total = heavy_keys(none, "word")
    assert found.count() == 0 and total == 0
    assert with_partition(none, "word", F.col("id"), 4).count() == 1


def test_index_files_keep_a_word_together(spark, tmp_path):
    docs = spark.range(400).select(F.col("id").alias("doc"), F.concat_ws(
        " ", F.lit("common"), F.concat(F.lit("w"), (F.col("id") % 50).cast("string"))).alias("text"))
    idx = ix.inverted_index(ix.term_postings(docs, "text", "doc"), "doc", block_size=8)
    sk.write_index_by_word(idx, str(tmp_path / "i"), 4, share=1 / 8)
    rows = read_lines(spark, str(tmp_path / "i")).withColumn("word", F.split("value", "\t")[0])
    files = {r.word: r.k for r in rows.groupBy("word").agg(F.count_distinct("file").alias("k")).collect()}
    assert files.pop("common") == 1                               # 50 of 450 blocks: below the share
    assert set(files.values()) == {1} and rows.count() == idx.count()
    sk.write_index_by_word(idx, str(tmp_path / "j"), 4, share=1 / 32)
    rows = read_lines(spark, str(tmp_path / "j")).withColumn("word", F.split("value", "\t")[0])
    files = {r.word: r.k for r in rows.groupBy("word").agg(F.count_distinct("file").alias("k")).collect()}
    assert files.pop("common") == 4 and set(files.values()) == {1}
    assert rows.select("value").exceptAll(idx.select(sk.index_lines(idx).alias("value"))).count() == 0


def test_null_lines_count_as_lines(spark):
    lines = spark.createDataFrame([("a b",), (None,), ("",)], "value string")
    got = {r.word: r.n for r in tx.word_count_with_total(lines).collect()}
    assert got == {"a": 1, "b": 1, "z" * 20: 3} and tx.line_count(lines).first().n == 3
    units = {r.word: r.n for r in tx.word_count_with_total(lines, rows_are_lines=False).collect()}
    assert units["z" * 20] == 1


def test_many_small_splits_share_few_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.txt", "b.txt"):
        (tmp_path / "in" / name).write_text("".join(f"w{i} x{i % 7}\n" for i in range(6000)))
    path, before = str(tmp_path / "in"), dict(spark.conf.getAll)
    lines = read_lines(spark, path, 256)
    # a task per split made over 400 of them, each a map output of every later shuffle
    assert lines.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 2
    assert dict(spark.conf.getAll) == before
    splits = {r.file: r.splits for r in fl.input_splits(spark, path, 256).collect()}
    starts = {(r.file, r.block_start) for r in lines.select("file", "block_start").distinct().collect()}
    assert starts == {(f, 256 * i) for f, n in splits.items() for i in range(n)} and len(starts) > 400
    # lines keep their order inside a split although splits share tasks
    for r in lines.groupBy("file", "block_start").agg(F.sort_array(F.collect_list(F.struct("rid", "value"))).alias("l")).collect():
        seen = [int(x.value.split()[0][1:]) for x in r.l]
        assert seen == list(range(seen[0], seen[0] + len(seen)))
    assert {(r.word, r.file): r.n for r in fl.word_count_files(lines).where("word like 'x%'").collect()} == {
        (f"x{k}", f): len(range(k, 6000, 7)) for k in range(7) for f in ("a.txt", "b.txt")}


def test_tasks_of_small_splits_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    from textgraph.sources import lines as ln
    assert ln.TASK_BYTES == 32 << 20
    path, cores = str(tmp_path / "in"), spark.sparkContext.defaultParallelism
    os.makedirs(path)
    size = 1024 * 4 * cores
    with open(f"{path}/a.txt", "w") as f:
        f.write("ab cd ef\n" * (size // 9))
    monkeypatch.setattr(ln, "TASK_BYTES", 1024)
    lines = read_lines(spark, path, 256)
    # one per core before, however many bytes (up to 128 MB) that was
    assert 3 * cores <= lines.rdd.getNumPartitions() <= 6 * cores
    got = {r.bigram: r.n for r in fl.bigram_count_files(spark, path, 256).collect()}
    n = size // 9
    assert got == {"ab cd": n, "cd ef": n, "ef ab": n - 1, "zzzzzzzzz Times Map task lanched: ": -(-n * 9 // 256)}


def _without_adaptive(df) -> str:
    spark = df.sparkSession         # that of lines read by splits is one of its own
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_end_tokens_of_files_are_read_once(spark, tmp_path):
    path = str(tmp_path / "in")
    _books(path)
    plan = _without_adaptive(tx.bigram_count_lines(read_lines(spark, path, SPLIT)))
    assert plan.count("FileScan text") == 2 and "ReusedExchange" in plan          # was 3, with a shuffle each


def test_few_units_are_no_join_keys_of_all_postings(spark):
    posts = spark.range(5000).select(F.format_string("w%d", F.col("id") % 900).alias("word"),
                                     F.format_string("f%d", F.col("id") % 3).alias("file"), F.lit(1).cast("bigint").alias("n"))
    posts = posts.distinct()
    idx = ix.inverted_index(posts, block_size=2)
    plan = _without_adaptive(idx)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = {}
    for r in idx.orderBy("word", "block").collect():
        got[r.word] = got.get(r.word, "") + r.postings
    assert got == {f"w{k}": "".join(f"f{i}:1;" for i in sorted({x % 3 for x in range(k, 5000, 900)})) for k in range(900)}
