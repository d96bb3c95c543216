"""Session helpers: a local session for tests and benchmarks, and the
checkpoint folder that iterative operators cut their lineage into.

On a cluster the checkpoint folder must be a shared one (HDFS, S3, ...)
named by ``spark.checkpoint.dir``; it is read from the session and never
invented there.  Only a ``local[...]`` master without any setting gets a
fresh scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "textgraph", extra: dict | None = None) -> SparkSession:
    """A ``local[cpus]`` session configured the way the tests and bench run.

    AQE stays on so that joins are re-planned from runtime sizes; the UI is
    off (no server is started).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # checkpoint files of finished loop iterations are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TEXTGRAPH_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, str(v))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)       # the configured folder, or a scratch one when unset
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    Order: the context's current folder, then ``spark.checkpoint.dir`` from
    the session or context conf.  When neither is set the master must be
    local (tests, one machine); there a scratch folder is created.  On a
    cluster an unset folder is an error: a machine-local folder would not
    survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:       # remote (Connect) session: the server owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set on the server session")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if (sc.master or "").startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textgraph-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "folder (e.g. an HDFS or object-store path) to cut their lineage")


def stable_checkpoint_dir(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself, the same for every
    application (``checkpoint_dir`` ends in a folder of this application)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set; a restartable stream needs a stable folder: "
                           "set it, or pass checkpoint=")
    return configured
