"""Writers: bulk append, per-project CSV export (the keyed store is ``store``), headerless CSV, text, ORC and table copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_bulk(df: DataFrame, path: str, writers: int, fmt: str = "parquet") -> None:
    """Append with ``writers`` parallel output tasks."""
    df.repartition(writers).write.mode("append").format(fmt).save(path)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """CSV directory (no header by default)."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)


def write_per_project_csv(df: DataFrame, path: str, project_col: str = "m_project_type_id") -> None:
    """One folder of header CSV files per project, from a single job."""
    df.write.mode("overwrite").partitionBy(project_col).option("header", "true").csv(path)


def write_text(df: DataFrame, path: str) -> None:
    """Text files of the single string column of ``df`` (overwrite)."""
    df.write.mode("overwrite").text(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).orc(path)


def copy_table(spark: SparkSession, src: str, dst: str, fmt: str = "parquet") -> DataFrame:
    """Full table copy; returns the copy."""
    spark.read.format(fmt).load(src).write.mode("overwrite").format(fmt).save(dst)
    return spark.read.format(fmt).load(dst)
