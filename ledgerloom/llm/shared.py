"""What several operators need: loading, lineage cuts, and split-safe sampling of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage with a table in the shared folder; a lost executor costs a re-read."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Null ids are never training rows, so they count as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def training_labels(labels: DataFrame, label: str, modulus: int, remainder: int) -> DataFrame:
    """One label per id (the larger one where rows disagree), outside the held-out fold."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .where(~held_out(F.col("doc_id"), modulus, remainder))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )


def labelled_sample(
    documents: DataFrame, known: DataFrame, per_class: int, max_chars: int
) -> list[tuple[str, int]]:
    """At most `per_class` labelled texts of each class, chosen by a hash of the id.

    Rows longer than `max_chars` are left out of the sample, so `2 * per_class * max_chars` bounds
    what reaches the driver. The chosen ids are broadcast: their number is bounded too.
    """
    ordered = known.select("doc_id", "label", F.xxhash64(F.col("doc_id"), F.lit("sample")).alias("h"))
    chosen = None
    for value in (0, 1):
        part = ordered.where(F.col("label") == value).orderBy("h", "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        documents.select(F.col("doc_id"), F.col("text"))
        .where(F.length("text").between(1, max_chars))
        .join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
        .orderBy("doc_id", "text")
        .limit(2 * per_class)
        .collect()
    )
    return [(r["text"], r["label"]) for r in rows]
