"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings the plans rely on. AQE splits skewed join partitions and rebalanced writes;
# dynamic overwrite lets a re-run replace only the partitions it produces.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A machine-local folder is made only for a local master with the setting unset (tests).
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[context.applicationId] = folder
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def write_and_reload(
    df: DataFrame, path: str, partition_by: str | None = None, finish: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, int]:
    """Cut lineage with a written table; returns its scan and its row count.

    The count is observed while writing, so it costs no second pass.

    The reloaded scan carries real file sizes, so Catalyst's broadcast decision downstream is
    size-checked, and a lost executor costs a re-read instead of a recompute. A partitioned
    write is rebalanced: AQE then splits a hot partition value over several files and merges
    small ones. A flat one keeps the partitions it has and needs no further shuffle. `finish` adds
    columns behind the rebalance, which then moves only what cannot be worked out afterwards.
    """
    seen = Observation()
    n = F.count(F.lit(1)).alias("n")
    # Counted in the tasks that write, behind any shuffle: a map stage that runs again is not counted twice.
    if partition_by:
        df = df.hint("rebalance", partition_by)
    if finish:
        df = finish(df)
    writer = df.observe(seen, n).write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), int(seen.get["n"])


def clustered(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Range-clustered so that row-group statistics answer a key lookup from few files.

    The range runs over the whole key list, so one customer with a third of the rows still
    spreads over many partitions.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
