"""One document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

SimHash groups (operator 8: pivot distance tables, two differing bits) propose the first pairs, the smallest
member of a group with each other one. At a similarity of 0.8 about ten of 64 bits differ with a spread of
three, so a radius that misses no such pair would also take in unrelated texts: the pairs beyond the radius
are proposed by the bands of operator 12 instead. Every link is confirmed on the whole shingle sets.

A group keeps the row of its smallest id, then of the smallest text hash; rows without an id come last, and
of identical rows one stays. Null, empty and blank texts are one group. Columns pass through as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import op8_simhash
from ledgerloom.llm.op12_circulant import distinct_sets, similar_sets, sketched, text_hash, text_rows
from ledgerloom.llm.shared import staged

SHINGLE_WORDS = 5
BOUND = (4, 5)


def simhash_pairs(sets: DataFrame) -> DataFrame:
    """`(u, v)`: each set with the smallest set of its SimHash group."""
    prints = sets.select(F.col("set_id").alias("doc_id"), "fp")
    grouped = prints.join(op8_simhash.groups(prints).select("fp", "component_id"), "fp")
    return grouped.select(F.col("component_id").alias("u"), F.col("doc_id").alias("v")).where("u <> v")


def one_of_each_group(documents: DataFrame) -> DataFrame:
    keyed = text_rows(documents)
    printed = keyed.select("doc_id", "text_hash", "text", op8_simhash.fingerprint(F.col("text")).alias("fp"))
    sketches = staged(sketched(printed, SHINGLE_WORDS), "sketches")
    sets = distinct_sets(sketches)
    proposed = staged(simhash_pairs(sets), "proposed")
    roots = similar_sets(sets, keyed, SHINGLE_WORDS, BOUND, proposed)
    rooted = sets.select("set_id", "doc_id", "text_hash").join(
        roots.select(F.col("u").alias("set_id"), F.col("v").alias("root")), "set_id", "left"
    )
    blank = sketches.where("n_shingles = 0").select(F.lit(-1).cast("long").alias("root"), "doc_id", "text_hash")
    homes = rooted.select(F.coalesce("root", "set_id").alias("root"), "doc_id", "text_hash").unionByName(blank)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    kept = homes.groupBy("root").agg(first).select("first.doc_id", "first.text_hash")
    return rows_of(documents, sketches, kept)


def rows_of(documents: DataFrame, sketches: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of `documents` for each `(doc_id, text_hash)` of `kept`."""
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    rows = sketches.groupBy("doc_id", "text_hash").agg((F.count(F.lit(1)) > 1).alias("repeated"))
    marked = kept.join(rows, same(kept, rows)).select(
        kept["doc_id"].alias("_kept_id"), kept["text_hash"].alias("_kept_hash"), F.col("repeated").alias("_repeated")
    )
    marked = staged(marked, "kept")
    found = documents.withColumn("_text_hash", text_hash()).join(
        marked, F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.col("_text_hash") == F.col("_kept_hash"))
    )
    # Only rows that occur more than once are shuffled again to leave one of them.
    once = found.where(~F.col("_repeated"))
    often = found.where("_repeated").dropDuplicates(["_kept_id", "_kept_hash"])
    return once.unionByName(often).select(*documents.columns)
