"""Consecutive ids in a stated order without a single-partition sort.

``row_number() over (order by x)`` with no partition moves every row into one
task.  Here the rows are range-partitioned on the order and sorted inside each
partition; Spark's increasing id then holds the partition and the place in it.
The numbered frame is written once, so every consumer sees the same numbers, ties
included; row counts of the partitions before (one row per partition, so that small
frame is the only thing numbered globally) make the numbers consecutive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .plan_tools import cut_lineage


def dense_ids(df: DataFrame, order: Sequence[str | Column], start: Column | int,
              id_col: str = "new_id", partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... following ``order``; rows that tie get
    consecutive numbers in any order, once and for all."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .withColumn("_nr", F.monotonically_increasing_id()), "ids")
    pid = F.shiftrightunsigned("_nr", 33)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (numbered.withColumn("_pid", pid)
            .join(F.broadcast(offsets), "_pid")  # one row per partition
            .withColumn(id_col, (start_col + F.col("_off") + F.col("_nr").bitwiseAND((1 << 33) - 1)).cast("long"))
            .drop("_pid", "_nr", "_off"))
