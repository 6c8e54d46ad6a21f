"""Session helpers: tuned builder and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "obsledger", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution and Arrow on; cluster settings are left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    go without; there one folder per session is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.environ.get("TMPDIR", "/tmp")
        configured = tempfile.mkdtemp(prefix="obsledger-", dir=base)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nobody holds any more; else they stay until the driver's memory runs low."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
