"""Type 2 history: snapshot merge, dimension versions, lookups in time.

History is a DataFrame of source columns + `valid_from`, `valid_to` (null while open). A key gains
at most one version per snapshot, so windows over one key hold at most as many rows as there were
snapshots, however large the feed is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import OPEN_END, ntz
from ledgerloom.functions.text import version_key


def scd2_start(source: DataFrame, taken_at: Column) -> DataFrame:
    """The first snapshot: every row opens a version."""
    return source.withColumns(
        {"valid_from": taken_at.cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz")}
    )


def scd2_merge(
    history: DataFrame, source: DataFrame, key: str, watched: Sequence[str], taken_at: Column
) -> DataFrame:
    """The history after one more snapshot.

    A watched column that differs (null-safe) closes the open version and opens another; a key
    gone from the source is closed; a new or returning key opens a version; anything else keeps
    the stored row untouched.
    """
    names = source.columns
    at = taken_at.cast("timestamp_ntz")
    closed = history.where(F.col("valid_to").isNotNull())
    open_rows = history.where(F.col("valid_to").isNull())

    old = open_rows.select(F.col(key).alias("old_key"), F.struct(*names, "valid_from").alias("old"))
    new = source.select(F.col(key).alias("new_key"), F.struct(*names).alias("new"))
    pairs = old.join(new, F.col("old_key") == F.col("new_key"), "full_outer")

    moved = F.lit(False)
    for name in watched:
        moved = moved | ~F.col("old")[name].eqNullSafe(F.col("new")[name])
    gone, arrived = F.col("new_key").isNull(), F.col("old_key").isNull()

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(side)[name].alias(name) for name in names], start.alias("valid_from"), end.alias("valid_to")
        )

    still_open = F.lit(None).cast("timestamp_ntz")
    kept = F.when(
        ~arrived, row("old", F.col("old")["valid_from"], F.when(gone | moved, at).otherwise(still_open))
    )
    opened = F.when(arrived | (~gone & moved), row("new", at, still_open))
    merged = pairs.select(F.inline(F.array_compact(F.array(kept, opened))))
    return closed.select(merged.columns).unionByName(merged)


def scd2_versions(history: DataFrame, key: str, key_name: str, began: Column) -> DataFrame:
    """Dimension columns of a history.

    The first version is backdated to the entity's own start (`began`): a snapshot taken today
    does not mean the entity began today.
    """
    order = Window.partitionBy(key).orderBy("valid_from")
    first = F.col("version_number") == 1
    start = F.when(first, F.least(began.cast("timestamp_ntz"), F.col("valid_from"))).otherwise(F.col("valid_from"))
    return (
        history.withColumn("version_number", F.row_number().over(order))
        .withColumn(key_name, version_key(F.col(key), F.col("valid_from")))
        .withColumn("is_current", F.col("valid_to").isNull())
        .withColumns({"valid_from": start, "valid_to": F.coalesce(F.col("valid_to"), ntz(OPEN_END))})
    )


def scd2_join(left: DataFrame, versions: DataFrame, left_key: str, version_id: str, at: str) -> DataFrame:
    """Left join on the version valid at `at`: equality on the id, the interval as a residual."""
    v = versions.withColumnsRenamed({"valid_from": "v_from", "valid_to": "v_to", version_id: "v_id"})
    on = (left[left_key] == v["v_id"]) & (left[at] >= v["v_from"]) & (left[at] < v["v_to"])
    return left.join(v, on, "left").drop("v_id", "v_from", "v_to")


def scd2_chain(
    outer: DataFrame, inner: DataFrame, outer_key: str, link: str, inner_key: str
) -> DataFrame:
    """Resolve a two-step lookup once per outer version instead of once per fact row.

    `outer` (e.g. account versions) points at `inner` (customer versions) through `link`. Each
    outer version is cut at the instants where the inner version changes; every piece carries the
    inner key valid in it, or null. A fact then needs one interval join where two would do the
    same with a second shuffle of the fact.
    """
    v = inner.select(
        F.col(link).alias("i_link"), F.col(inner_key), F.col("valid_from").alias("i_from"),
        F.col("valid_to").alias("i_to"),
    )
    touching = (
        (outer[link] == v["i_link"]) & (v["i_from"] < outer["valid_to"]) & (v["i_to"] > outer["valid_from"])
    )
    cuts = F.array_compact(
        F.array(
            F.col("valid_from"),
            F.when(F.col("i_from") > F.col("valid_from"), F.col("i_from")),
            F.when(F.col("i_to") < F.col("valid_to"), F.col("i_to")),
        )
    )
    pieces = (
        outer.join(v.drop(inner_key), touching, "left")
        .withColumn("piece_from", F.explode(cuts))
        .drop("i_link", "i_from", "i_to")
        .distinct()
    )
    following = F.lead("piece_from").over(Window.partitionBy(outer_key).orderBy("piece_from"))
    pieces = pieces.withColumn("piece_to", F.coalesce(following, F.col("valid_to"))).drop("valid_from", "valid_to")
    pieces = pieces.withColumnsRenamed({"piece_from": "valid_from", "piece_to": "valid_to"})
    return scd2_join(pieces, inner.select(link, inner_key, "valid_from", "valid_to"), link, link, "valid_from")


def scd2_overlaps(versions: DataFrame, key: str) -> DataFrame:
    """Keys with versions valid at the same instant, with the number of overlaps."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return (
        versions.select(key, "valid_to", following.alias("next_from"))
        .where(F.col("next_from") < F.col("valid_to"))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("overlapping"))
    )
