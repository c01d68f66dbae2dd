"""Rendezvous hashing over weighted shards (operator 10, native).

Each record key scores every shard with a hash of (key, shard number); the highest
score wins.  Adding a shard adds one score per key and changes no other, so rows move
only into the new shard.  Weights enter as ``-weight / ln(u)``, u uniform in (0, 1).

Slots number the rows of a shard from 0 without gaps.  No task sees a whole shard:
rows fall into hash buckets of about ``BUCKET_ROWS``, bucket counts give offsets, and
rows are numbered inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BUCKET_ROWS = 4096
_SPAN = float(1 << 53)


def _score(key: Column, shard: int, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(_SPAN)
    return F.lit(-float(weight)) / F.log(u)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number of ``key``: the index of the highest weighted score, the lowest
    index on a tie.  A weight of 0 or less takes no rows.  A null key is a key."""
    scores = [F.struct(_score(key, i, w).alias("s"), F.lit(-i).alias("i"))
              for i, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("no shard with a positive weight")
    return (-F.array_max(F.array(*scores))["i"]).cast("int")


def shard(docs: DataFrame, weights: list[float], added_weight: float = 1.0,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1.  ``grown_shard`` is the shard with one more
    shard of ``added_weight``.  Null and empty texts have size 1 and checksum 0; null
    keys share one shard; repeated rows each get a slot of their own (equal rows are
    interchangeable); an empty table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    spark = docs.sparkSession
    rows = staged(docs.select(
        F.col(key).alias("k"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, added_weight]).alias("grown_shard")), "shard")
    n_buckets = max(1, -(-rows.count() // (BUCKET_ROWS * len(weights))))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("k", "text_crc32", F.lit("slot")), F.lit(n_buckets)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    inside = Window.partitionBy("shard", "bucket").orderBy("k", "text_crc32", "size")
    return (rows.withColumn("nr", F.row_number().over(inside)).join(offsets, ["shard", "bucket"])
            .select(F.col("k").alias(key), "size", "text_crc32", "shard",
                    (F.col("first") + F.col("nr") - 1).cast("long").alias("slot"), "grown_shard"))
