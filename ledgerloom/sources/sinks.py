"""Writers of the lake, the reports and the feed formats."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import DEFECT_LEDGER


def counted_write(df: DataFrame, path: str, partition_by: str | None = None, arranged: bool = False) -> int:
    """Write Parquet and return the row count, observed during the write instead of recounted.

    `rebalance` splits a hot partition value over several files and merges small ones. Only the
    partitions that `df` holds are replaced. Rows are counted after that shuffle, in the tasks that
    write them, each of which counts once however often it ran.

    `arranged`: the rows are scanned from files that each hold one partition value. A task then writes no more
    files than it read pieces of files, so the rows stay where they are and nothing is shuffled. So are rows scanned
    from files when nothing is partitioned: a task writes one file.
    """
    seen = Observation()
    if not arranged:
        df = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return int(seen.get["n"])


def is_loaded(spark: SparkSession, path: str) -> bool:
    """Reachable and holding data: an empty store answers fastest and is useless."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException as failure:
        # Absent, or a folder without files; what is there but cannot be read stays an error.
        if failure.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return False
        raise


def write_csv(df: DataFrame, path: str) -> None:
    """A report as CSV with a header; AQE writes a small one as a single file."""
    df.hint("rebalance").write.mode("overwrite").csv(path, header=True)


def write_feed(df: DataFrame, path: str, fmt: str) -> None:
    """A feed in its wire format: json (one object per line), csv with a header, parquet or avro."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.save(path)


def write_ledger(ledger: DataFrame, path: str) -> int:
    """The defect ledger beside a delivery."""
    return counted_write(ledger.select(*DEFECT_LEDGER.names), path)
