"""SparkSession helpers: sane defaults for local runs, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no per-call call-site capture on the driver (plan building is py4j-bound)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              driver_memory: str = "8g", app: str = "termspark") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the given session."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only a local session with no setting gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="termspark-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured
