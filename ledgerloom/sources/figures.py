"""Rows and bytes of Parquet tables, from file footers and file status: no column is read.

The figures describe what lies in the store when they are taken, whatever was re-run while it was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """One row a file that holds rows. A scan of no columns counts rows by the footers."""
    scan = spark.read.parquet(path).select(
        *keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    )
    return scan.groupBy(*keys, "file", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def file_figures(spark: SparkSession, path: str) -> DataFrame:
    """`file, rows, bytes`."""
    return _files(spark, path).select("file", "rows", "bytes")


def partition_figures(spark: SparkSession, path: str, column: str) -> DataFrame:
    """`column, rows, bytes, files` of each partition that holds rows."""
    return _files(spark, path, column).groupBy(column).agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("files")
    )


def table_figures(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame:
    """One row: `rows, bytes, files, partitions` (null for a table without partitions)."""
    keys = [partition] if partition else []
    parts = F.count_distinct(partition) if partition else F.lit(None).cast("long")
    return _files(spark, path, *keys).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("files"),
        parts.alias("partitions"),
    )
