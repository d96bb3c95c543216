"""Bucketed frames: tables in the shared folder whose hash partitioning Spark knows.

A frame written by ``write_buckets`` is stored as one file (or a few) per hash
bucket of its keys.  Reading it, Spark knows the partitioning, so a join or an
aggregate on those keys does not exchange it -- with adaptive execution on and
without any change of the session's settings -- and a filter on a single key
reads the buckets it names only.  The files survive the loss of any executor.

A frame with a *spec* beside it can be opened by a later application
(``open_buckets``), which then finds the layout ready.  The table's name is
needed by Spark's writer only; it leaves the catalog at once, the files stay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgraph.session import checkpoint_dir


@dataclass
class Buckets:
    frame: DataFrame
    path: str

    def delete(self) -> None:
        """Removes the files; frames that still read them fail afterwards."""
        delete_path(self.frame.sparkSession, self.path)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _resolved(spark: SparkSession, name: str) -> DataFrame:
    """The table's frame, its name dropped from the catalog (the table is external: files stay)."""
    frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return frame


def write_buckets(df: DataFrame, keys: list[str], partitions: int, path: str | None = None, spec: dict | None = None) -> Buckets:
    """Computes ``df`` once and stores it in ``partitions`` buckets by ``keys``,
    sorted by them.  A frame that is hash partitioned that way already is not
    exchanged.  With ``spec`` (anything JSON holds) it can be opened again."""
    spark = df.sparkSession
    path = path or shared_path(spark, "buckets")
    name = f"textgraph_{uuid.uuid4().hex}"
    (df.write.format("parquet").bucketBy(partitions, *keys).sortBy(*keys)
     .option("path", path).mode("overwrite").saveAsTable(name))
    out = Buckets(_resolved(spark, name), path)
    if spec is not None:
        full = {"keys": keys, "partitions": partitions, "own": spec,
                "columns": [[f.name, f.dataType.simpleString()] for f in out.frame.schema.fields]}
        spark.range(1).select(F.lit(json.dumps(full)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}.spec")
    return out


def has_spec(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.spec/_SUCCESS")
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def open_buckets(spark: SparkSession, path: str) -> tuple[Buckets, dict]:
    """A frame that ``write_buckets`` stored with a spec, and that spec."""
    full = json.loads(spark.read.text(f"{path}.spec").first()[0])
    name = f"textgraph_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}` {t}" for c, t in full["columns"])
    keys = ", ".join(f"`{k}`" for k in full["keys"])
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {full['partitions']} BUCKETS LOCATION '{place}'")
    return Buckets(_resolved(spark, name), path), full["own"] | {"partitions": full["partitions"]}
