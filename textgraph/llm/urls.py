"""URL filter: prefix rules, and a character language-model ratio beside them.

Two variable-order Markov models over the URL's characters, one for URLs
that a rule accepts and one for those that a rule rejects.  A context of
length k is used where, in either class, at least one in ``CONTEXT_SHARE`` training
symbols follows it, so a rare class keeps its own frequent contexts, and a model
holds at most twice ``CONTEXT_SHARE`` contexts per order whatever the input's
size -- that is the bound behind its broadcast.  Orders are interpolated:

    p_k(c | ctx) = (n(ctx c) + BACKOFF * p_{k-1}(c | shorter ctx)) / (n(ctx) + BACKOFF)

A URL's score is the difference of the two log-likelihoods per symbol; the
cut lies between the classes' mean scores, weighted by their spreads.

Everything is DataFrame work: grams are exploded from the *distinct* URLs
(copies count through their number of rows), counted with map-side
aggregation, and the score of a URL is the sum of the models' increments
over its grams.  A URL is cut into pieces of ``PIECE`` symbols, each with the four
before it, and its grams are taken from the pieces and summed by a digest of
its symbols, so a very long URL costs time in proportion to its length.

Defined cases: a null URL or one without ``://`` has empty host and path and
meets no rule; an empty or null URL is scored by its end symbol alone;
repeated rows each get a row; without any rule-matched URL every score is 0
and the verdict is ``allow``.  Other columns of the input travel along, whatever
their names; those called as a new one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import durable, free_name

# (host + path prefix, verdict): fixed by the contract of the query.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/._?=&%#:+~-*$"   # 0: any digit, *: any other, $: end
ORDERS = 5                 # longest gram: four characters of context
CONTEXT_SHARE = 1024
BACKOFF = 5.0
PIECE = 256                # symbols that grams are cut from at a time


def host_of(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def symbols_of(url: Column) -> Column:
    """The URL over the models' small alphabet, padded in front, ended by ``$``."""
    low = F.lower(F.coalesce(url, F.lit("")))
    low = F.regexp_replace(F.regexp_replace(low, "[0-9]", "0"), r"[^a-z0/._?=&%#:+~-]", "*")
    return F.concat(F.lit("^" * (ORDERS - 1)), low, F.lit("$"))


def pieces(symbols: Column) -> Column:
    """The symbols in consecutive pieces, each preceded by the context of its
    first symbol; the padding in front is the first piece's."""
    body = F.regexp_extract_all(F.substring(symbols, F.lit(ORDERS), F.length(symbols)), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.transform(body, lambda p, i: F.concat(
        F.when(i > 0, F.right(F.get(body, i - 1), F.lit(ORDERS - 1))).otherwise(F.lit("^" * (ORDERS - 1))), p))


def grams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per position and order: ``(*keep, gram)``; the last character
    of a gram is the symbol, what precedes it the context."""
    cut = urls.select(*keep, F.explode(pieces(F.col("symbols"))).alias("_piece"))
    at = cut.select(*keep, "_piece", F.explode(F.sequence(F.lit(ORDERS), F.length("_piece"))).alias("_end"))
    return at.select(*keep, F.explode(F.array(*[
        F.substring(F.col("_piece"), F.col("_end") - F.lit(k - 1), F.lit(k))
        for k in range(1, ORDERS + 1)])).alias("gram"))


def ratio_model(urls: DataFrame) -> DataFrame:
    """``(gram, inc)``: what a gram adds to the log-ratio beyond the gram
    without its first character.  ``urls``: (symbols, verdict, n), verdict
    null where no rule fits."""
    counted = (grams(urls, "verdict", "n").groupBy("gram")
               .agg(*[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v)
                      for v in ("allow", "block")])
               .select("*", F.length("gram").alias("k"),
                       F.expr("substring(gram, 1, length(gram) - 1)").alias("ctx"),
                       F.expr("substring(gram, 2)").alias("lower")))
    contexts = counted.groupBy("ctx").agg(F.sum("allow").alias("ctx_allow"), F.sum("block").alias("ctx_block"))
    totals = contexts.where(F.col("ctx") == "").first()
    frequent = F.lit(False)
    for v in ("ctx_allow", "ctx_block"):
        frequent = frequent | ((F.col(v) > 0) & (F.col(v) * CONTEXT_SHARE >= F.lit(int(totals[v]) if totals else 0)))
    contexts = contexts.where(frequent)
    counted = counted.join(F.broadcast(contexts), "ctx")
    # suffixes of a frequent context are frequent, so each order finds its lower one
    level = counted.where("k = 1").select("gram", *[
        ((F.col(v) + 1) / (F.col("ctx_" + v) + len(SYMBOLS))).alias("p_" + v) for v in ("allow", "block")])
    level = level.withColumn("inc", F.log("p_allow") - F.log("p_block"))
    model = level
    for k in range(2, ORDERS + 1):
        below = level.select(F.col("gram").alias("lower"), F.col("p_allow").alias("q_allow"),
                             F.col("p_block").alias("q_block"))
        level = counted.where(F.col("k") == k).join(below, "lower").select("gram", *[
            ((F.col(v) + BACKOFF * F.col("q_" + v)) / (F.col("ctx_" + v) + BACKOFF)).alias("p_" + v)
            for v in ("allow", "block")], "q_allow", "q_block")
        level = level.withColumn("inc", (F.log("p_allow") - F.log("p_block"))
                                 - (F.log("q_allow") - F.log("q_block"))).drop("q_allow", "q_block")
        model = model.unionByName(level)
    return model.select("gram", "inc")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule, verdict and score (the length-normalised
    log-ratio above its cut; null where a rule decides)."""
    verdict = F.lit(None).cast("string")
    for rule, says in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(says)).otherwise(verdict)
    distinct = (pages.groupBy(F.col(url).alias("_url")).agg(F.count(F.lit(1)).alias("n"))
                .select("_url", "n", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
                .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
                .withColumn("verdict", verdict)
                .withColumn("symbols", symbols_of(F.col("_url")))
                .withColumn("digest", F.md5(F.col("symbols").cast("binary"))))
    distinct = durable(distinct)
    model = durable(ratio_model(distinct.select("symbols", "verdict", "n")))
    sums = (grams(distinct.dropDuplicates(["digest"]).select("digest", "symbols"), "digest")
            .join(F.broadcast(model), "gram").groupBy("digest").agg(F.sum("inc").alias("ratio")))
    scored = durable(distinct.join(sums, "digest", "left").withColumn(
        "mean", F.coalesce("ratio", F.lit(0.0)) / (F.length("symbols") - (ORDERS - 1))))
    moments = {r.verdict: r for r in scored.where("verdict is not null").groupBy("verdict").agg(
        (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("mu"),
        (F.sum(F.col("mean") * F.col("mean") * F.col("n")) / F.sum("n")).alias("sq")).collect()}
    cut = 0.0
    if len(moments) == 2:
        (am, asd), (bm, bsd) = [(r.mu, max(r.sq - r.mu * r.mu, 1e-12) ** 0.5)
                                for r in (moments["allow"], moments["block"])]
        cut = (am * bsd + bm * asd) / (asd + bsd)
    fresh = ["host", "path", "rule", "verdict", "score"]
    kept = [c for c in pages.columns if c not in fresh]
    new = {c: free_name(pages.columns, "_" + c) for c in ["url", *fresh]}
    judged = scored.select(
        F.col("_url").alias(new["url"]), F.col("host").alias(new["host"]), F.col("path").alias(new["path"]),
        F.col("rule").alias(new["rule"]),
        F.coalesce("verdict", F.when(F.col("mean") >= cut, "allow").otherwise("block")).alias(new["verdict"]),
        F.when(F.col("rule").isNull(), F.round(F.col("mean") - cut, 6)).alias(new["score"]))
    return (pages.select(*kept).join(judged, F.col(url).eqNullSafe(F.col(new["url"])))
            .select(*kept, *[F.col(new[c]).alias(c) for c in fresh]))
