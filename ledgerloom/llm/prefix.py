"""Running totals over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged


def running_totals(df: DataFrame, keys: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows up to this one in the order of `keys`, itself included.

    Rows are range-partitioned by the whole key list, so equal leading keys still spread. Each partition
    is summed on its own; only one number per partition is then brought together. `keys` should order
    rows totally up to rows that are interchangeable.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, names, strict=True)], value.alias("_value"))
    placed = staged(
        keyed.repartitionByRange(*names).sortWithinPartitions(*names).withColumn("_part", F.spark_partition_id()), name
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.sum("_value").alias("_total")).select(
        "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("_part").orderBy(*names).rowsBetween(W.unboundedPreceding, 0)
    return (
        # One row per partition: bounded by the number of tasks.
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.sum("_value").over(inside))
        .drop("_part", "_offset", "_value", *names)
    )
