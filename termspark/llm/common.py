"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: ASCII white space that separates words (space, tab, line feed .. carriage return)
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that
    survives lost executors, and one computation for several consumers."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def located(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` with a column more, and that column's name: (file, row), a stable place for
    every row, repeated ones too.  A frame that is no plain scan of Parquet files is
    written first."""
    at = free_name(df, "_at")

    def place(x: DataFrame) -> DataFrame:
        file = x.metadataColumn("_metadata")
        return x.withColumn(at, F.struct(file["file_path"].alias("file"), file["row_index"].alias("row")))
    try:
        return place(df), at
    except AnalysisException:
        return place(staged(df, name)), at


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, GAP))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def workers(spark: SparkSession) -> int:
    """Tasks that keep every core busy, or the session's shuffle partitions if more."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs inside send Python at most ``rows`` rows at a time (texts can be long)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < rows < int(before) or int(before) <= 0:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
