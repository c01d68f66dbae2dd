"""Exact deduplication by a stateful stream (operator 2, native).

The stream reads (digest, identifier, content locator) rows and keeps, in disk-backed
state without expiry, one entry per digest: the row that stays (largest identifier,
then largest locator) and the number of rows seen.  Every micro-batch writes the
entries it changed; entries only grow, so the last one of a digest is its maximum.
New files of a longer-lived source continue from the same checkpoint.

Digests only propose: each hit (a row whose digest was seen more than once) is held
against the full bytes of the row that stays, read back by its locator.  Rows whose
bytes differ (a digest collision) form groups of their own by their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import located, shared_path, staged

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: settings of the stream: state on disk, changes logged and not whole stores, and no file space set aside ahead
#: of need (some megabytes for each of many small stores)
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}
BYTES_PER_BATCH = 16 << 30


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def remember(spark: SparkSession, source: str, schema, state: str, out: str,
             bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """Run the keyed stream over the files of ``source`` that ``state``, its checkpoint,
    has not seen; ``out`` receives the entries that each micro-batch changed.  Returns
    (digest, last, n), one row per digest."""
    stream = (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(source)
              .groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("last"), F.count(F.lit(1)).alias("n")))
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        query = (stream.writeStream.outputMode("update").option("checkpointLocation", state)
                 .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    spark.createDataFrame([], stream.schema).write.mode("append").parquet(f"{out}/batch=-1")  # so that it exists
    return (spark.read.schema(stream.schema).parquet(f"{out}/batch=*")
            .groupBy("digest").agg(F.max("last").alias("last"), F.max("n").alias("n")))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text",
          digest: Callable[[Column], Column] = sha256, bytes_per_batch: int = BYTES_PER_BATCH,
          place: str | None = None) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, file, row.
    ``place`` names a column that ``located`` added, if there is one.

    Null text counts as empty.  Of equal texts the largest key stays (a null key is the
    smallest); of rows that repeat key and text the one with the last locator stays, so
    exactly one row of a group has ``kept``.  An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    rows, place = (docs, place) if place else located(docs.select(key, text), "dedup-docs")
    rows = (rows.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), f"{place}.file", f"{place}.row")
            .withColumn("digest", digest(F.col("text"))))
    folder = shared_path(spark, "dedup")
    narrow = rows.select("digest", "id", "file", "row", sha256(F.col("text")).alias("text_sha256"))
    narrow.write.parquet(f"{folder}/entries")
    entries = spark.read.schema(narrow.schema).parquet(f"{folder}/entries")
    seen = staged(remember(spark, f"{folder}/entries", narrow.schema, f"{folder}/state", f"{folder}/out",
                           bytes_per_batch), "dedup-seen")

    # full bytes of every hit against the bytes of the row that stays
    again = seen.where("n > 1")
    hits = staged(rows.drop("id").join(again.select("digest", "last"), "digest"), "dedup-hits")
    at_last = (F.col("file") == F.col("last.file")) & (F.col("row") == F.col("last.row"))
    stays = hits.where(at_last).select("digest", F.col("text").alias("kept_text"))
    odd = staged(hits.join(stays, "digest").where("text != kept_text").select("digest", "text", "file", "row"), "dedup-odd")

    found = entries.join(seen, "digest")
    if not odd.isEmpty():
        away = odd.groupBy("digest").agg(F.count(F.lit(1)).alias("away"))
        ids = odd.join(entries.select("file", "row", "id"), ["file", "row"])
        own = (ids.groupBy("digest", "text").agg(F.max(F.struct("id", "file", "row")).alias("own_last"),
                                                 F.count(F.lit(1)).alias("own_n")))
        own = odd.join(own, ["digest", "text"]).select("file", "row", "own_last", "own_n")
        found = (found.join(away, "digest", "left").join(own, ["file", "row"], "left")
                 .withColumn("n", F.coalesce("own_n", F.col("n") - F.coalesce("away", F.lit(0))))
                 .withColumn("last", F.coalesce("own_last", "last")))
    return found.select(F.col("id").alias(key), F.col("last.id").alias("keep_id"), F.col("n").cast("long").alias("group_size"),
                        at_last.alias("kept"), "text_sha256", "file", "row")


def distinct(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``dedup`` keeps: one of each text,
    nulls and empty texts being one; texts of any length are compared whole; an empty table
    gives no rows."""
    placed, at = located(docs, "dedup-docs")
    gone = dedup(placed, key, text, place=at).where(~F.col("kept")).select(F.struct("file", "row").alias(at))
    return placed.join(gone, at, "left_anti").select(*docs.columns)
