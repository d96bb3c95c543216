"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Equal texts form a group.  A group that holds more than 1/``OWN_SHARE`` of all
bytes, tokens or rows is placed on its own, and one above 1/``HOT_SHARE`` is cut
into pieces below that share; all smaller groups are hashed into ``CELLS`` cells.
Groups, pieces and cells are the units: at most three times ``OWN_SHARE`` +
``HOT_SHARE`` groups and pieces and ``CELLS`` cells, by arithmetic, so the
packing itself -- largest unit first, each into the shard whose residual
capacity has the highest dot product with the unit's vector -- is a small loop on
the driver.

Rows that repeat id and text are one *bundle* with a count.  A split group's
bundles go to pieces by a hash, and a bundle of many rows is itself cut, the cuts
taking the pieces in turn; so neither repeated rows nor null ids gather
anywhere.  Bundles are numbered inside their unit by a running total, a unit's
first slot in its shard is known from the units placed before it, and only then
are bundles written out as rows.

Law: ``bytes`` -- the shards' sizes are nearly equal.

Defined cases: a null text has no bytes; null ids are sorted first in their unit;
repeated rows are rows of one group; an empty table gives no rows; fewer
units than shards leave shards empty; a very long text is measured, never
shuffled, but for ``shard_texts``, which moves it once.  Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgraph.llm.common import durable, word_total

SHARDS = 40
CELLS = 16_384
OWN_SHARE = 4096           # a group above 1/4096 of any total is a unit of its own
HOT_SHARE = 320            # one above 1/320 is split
ROW_BYTES = 16             # counted for each row beside its text
DIMENSIONS = ("bytes", "tokens", "rows")
PULL = (2.0, 1.0, 1.0)     # weights of the dimensions in the dot product


def place(vectors: np.ndarray, shards: int, pull=PULL) -> np.ndarray:
    """Shard of each unit: decreasing size, highest dot product of the unit
    with the residual capacity; ties go to the lowest shard."""
    total = vectors.sum(axis=0)
    unit = vectors / np.where(total > 0, total, 1.0)
    residual = np.full((shards, vectors.shape[1]), 1.0 / shards)
    weighted = unit * np.asarray(pull)
    out = np.zeros(len(vectors), np.int64)
    for i in np.argsort(-weighted.max(axis=1), kind="stable"):
        s = int(np.argmax(residual @ weighted[i]))
        residual[s] -= unit[i]
        out[i] = s
    return out


def _placed(docs: DataFrame, shards: int, cells: int) -> DataFrame:
    """``(doc_id, size, text_crc32, grp, count, shard, slot)``: bundles of equal rows, or cuts
    of them, and the first slot of each."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    bundles = durable(docs.select(
        "doc_id", (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        word_total(F.col("text")).alias("tokens"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("grp"))
        .groupBy("doc_id", "size", "tokens", "text_crc32", "grp").agg(F.count(F.lit(1)).alias("count")))
    sums = [F.sum(F.col("size") * F.col("count")).alias("bytes"), F.sum(F.col("tokens") * F.col("count")).alias("tokens"),
            F.sum("count").alias("rows")]
    total = bundles.agg(*sums).first()
    ratios = [F.col(d) / F.lit(float(total[d] or 1)) for d in DIMENSIONS]
    own = (bundles.groupBy("grp").agg(*sums).withColumn("share", F.greatest(*ratios)).where(F.col("share") * OWN_SHARE > 1)
           .select(F.col("grp").alias("_grp"), F.ceil(F.col("share") * HOT_SHARE).alias("_pieces"),
                   F.col("rows").alias("_rows")))           # fewer than 3 * OWN_SHARE groups
    met = bundles.join(F.broadcast(own), F.col("grp") == F.col("_grp"), "left")
    # a bundle of more rows than a piece should hold is cut
    most = F.ceil(F.col("_rows") / F.col("_pieces"))
    cuts = F.coalesce(F.ceil(F.col("count") / most), F.lit(1))
    cut = met.withColumn("_cuts", cuts).withColumn("_cut", F.explode(F.sequence(F.lit(0).cast("bigint"), cuts - 1)))
    count = F.floor(F.col("count") / F.col("_cuts")) + (F.col("_cut") < F.pmod("count", "_cuts")).cast("bigint")
    unit = F.when(F.col("_pieces").isNull(), F.pmod("grp", F.lit(cells))).otherwise(
        # groups and pieces get numbers of their own beside the cells
        F.lit(cells) + F.pmod(F.xxhash64("grp"), F.lit(1 << 40)) * F.lit(1 << 16)
        + F.pmod(F.xxhash64("doc_id", "grp") + F.col("_cut"), F.col("_pieces")))
    rows = cut.select("doc_id", "size", "tokens", "text_crc32", "grp", count.alias("count"), unit.alias("unit"), "_cut")
    units = rows.groupBy("unit").agg(*sums).orderBy("unit").toPandas()   # bounded, see above
    units["shard"] = place(units[list(DIMENSIONS)].to_numpy(np.float64), shards) if len(units) else []
    units["first"] = units.groupby("shard")["rows"].cumsum() - units["rows"]
    placed = spark.createDataFrame(pa.table({c: pa.array(units[c], pa.int64()) for c in ("unit", "shard", "first")}))
    before = Window.partitionBy("unit").orderBy("doc_id", "grp", "size", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_n", F.coalesce(F.sum("count").over(before), F.lit(0))).join(F.broadcast(placed), "unit")
            .select("doc_id", "size", "text_crc32", "grp", "count", F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("_n")).alias("slot")))


def _each(bundles: DataFrame, *columns) -> DataFrame:
    """Bundles written out as rows, with their slots."""
    step = F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("count") - 1))
    return bundles.withColumn("_slot", step).select(*columns, F.col("_slot").alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``."""
    rows = _each(_placed(docs, shards, cells), "doc_id", "size", "text_crc32", "shard")
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def shard_texts(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS) -> DataFrame:
    """``(shard, slot, doc_id, text)``: the shards themselves (write them
    partitioned by ``shard``), a null text as the empty one."""
    named = (F.coalesce("doc_id", F.lit(0)).alias("_did"), F.col("doc_id").isNull().alias("_dnull"))
    texts = (docs.select("text", *named, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("grp"))
             .withColumn("text", F.coalesce("text", F.lit(""))).groupBy("_did", "_dnull", "grp").agg(F.first("text").alias("text")))
    found = _placed(docs, shards, cells).select("*", *named).join(texts, ["_did", "_dnull", "grp"])
    return _each(found, "shard", "doc_id", "text").select("shard", "slot", "doc_id", "text")
