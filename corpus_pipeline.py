"""The corpus pipeline: documents through five operators of ``textgraph.llm``.

Each stage reads what the one before wrote (Parquet in the shared folder)
and works on all of it; all but the last return the columns of documents.

Defined cases are those of the operators: null and empty texts pass the
filters on their thresholds alone, are one near-duplicate group, have no words
to mix (such a source has rate 0), and would be packed as the end id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.llm import mixing, packing, quality, simhash, toxicity
from textgraph.session import checkpoint_dir
from textgraph.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, docs.columns, ("_stage_toxic", "_stage_severity"))
    return scored.where(F.col("_stage_toxic") < toxicity.REJECT_FROM).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts as good."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, weights, docs.columns, "_stage_quality")
    return scored.where(F.col("_stage_quality") >= quality.KEEP_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.representatives(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target says."""
    return mixing.emit_copies(mixing.mix_sources(docs, prefix="_stage_"), "_stage_copies").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("mixing", mix), ("packing", pack)]

ORACLE_SQL = None          # no stage but the mixing can be said in SQL; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; returns the last one's rows, as written."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
