"""Small plan helpers a Spark user writes: lineage cut, spreading work over the cores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

def cut_lineage(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write ``df`` once as a Parquet table under the session's checkpoint folder
    and return a frame reading it.

    Used where one expensive frame feeds several consumers: column pruning makes
    their subtrees differ, so Spark would not reuse the shuffle and would
    compute the frame once per consumer.  The table lives in the shared folder
    named by ``spark.checkpoint.dir`` (it survives executor loss, unlike a local
    checkpoint), and the columnar writer is far cheaper than serialising rows
    for an RDD checkpoint.
    """
    from ..session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(df.sparkSession)
    path = f"{root.rstrip('/')}/termspark-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of a frame that reads fewer files than the cluster has
    cores; a no-op for inputs of many files, which is the normal case on a cluster.  Used
    in front of CPU-heavy per-row work such as text analysis."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df


def analysis_partitions(df: DataFrame) -> int:
    """Partition count for CPU-heavy work after a shuffle: the larger of the
    shuffle setting and the cluster's cores (AQE would otherwise merge the
    small-in-bytes input into a few tasks)."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
