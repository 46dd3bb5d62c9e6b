"""Declared table checks, compiled into one pass over each table and one shuffle of counted keys.

Every row of a table is looked at once: it emits the keys that uniqueness and relationships are about, and
an entry for each null or unlisted value. Parents emit their keys too. Entries are counted per (check, key)
on the map side, so a key on a third of all rows is one entry a task; then each check adds up its keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.checks import union_all


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column} not null"


@dataclass(frozen=True)
class Unique:
    """No value on more than one row; nulls are not compared."""

    table: str
    column: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column} unique"


@dataclass(frozen=True)
class Accepted:
    table: str
    column: str
    values: tuple[object, ...]

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column} accepted values"


@dataclass(frozen=True)
class Relationship:
    """Every value has a parent row; nulls pass."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"


Check = NotNull | Unique | Accepted | Relationship


def _entry(check: Check, wanted: Column, key: Column, parent: bool = False) -> Column:
    entry = F.struct(
        F.lit(check.name).alias("check"),
        F.lit(type(check).__name__).alias("kind"),
        key.cast("string").alias("key"),
        F.lit(not parent).cast("long").alias("rows"),
        F.lit(parent).cast("long").alias("parents"),
    )
    return F.when(wanted, entry)


def entries(table: str, df: DataFrame, declared: Sequence[Check]) -> DataFrame | None:
    """What the rows of one table have to say to all checks that mention it."""
    out = []
    nothing = F.lit(None).cast("string")
    for check in declared:
        if check.table == table:
            value = F.col(check.column)
            if isinstance(check, NotNull):
                out.append(_entry(check, value.isNull(), nothing))
            elif isinstance(check, Accepted):
                out.append(_entry(check, ~value.isin(*check.values), nothing))
            else:
                out.append(_entry(check, value.isNotNull(), value))
        if isinstance(check, Relationship) and check.parent == table:
            value = F.col(check.parent_column)
            out.append(_entry(check, value.isNotNull(), value, parent=True))
    if not out:
        return None
    return df.select(F.explode(F.array_compact(F.array(*out))).alias("e")).select("e.*")


def run(tables: Mapping[str, DataFrame], declared: Sequence[Check]) -> DataFrame:
    """`check, violations` of every declared check, those that hold included."""
    parts = [part for name, df in tables.items() if (part := entries(name, df, declared)) is not None]
    counted = union_all(parts).groupBy("check", "kind", "key").agg(
        F.sum("rows").alias("rows"), F.sum("parents").alias("parents")
    )
    violations = (
        F.when(F.col("kind") == "Unique", (F.col("rows") > 1).cast("long"))
        .when((F.col("kind") == "Relationship") & (F.col("parents") > 0), 0)
        .otherwise(F.col("rows"))
    )
    found = counted.groupBy("check").agg(F.sum(violations).alias("found"))
    names = counted.sparkSession.createDataFrame([(c.name,) for c in declared], "check string")
    return names.join(found, "check", "left").select("check", F.coalesce("found", F.lit(0)).alias("violations"))
