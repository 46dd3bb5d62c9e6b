"""SimHash near-duplicates by pivot distance tables.

Every distinct fingerprint gets its Hamming distances to 17 reference fingerprints: zero, and one
reference for each nibble with that nibble's bits set. Half the difference of two such distances is the
nibble's coordinate, and two fingerprints within two bits differ by at most two in the sum of all
coordinate differences, so by at most one from a common coordinate vector between them. Fingerprints
meet on those vectors (their own and its 32 neighbours): pairs with a larger coordinate difference are
never formed. Survivors are verified bit by bit.

Null and empty texts have the fingerprint zero and are linked like any other. Rows with a null id get
the smallest id they reach, null if there is none. Repeated rows share a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.shared import staged

BITS = 2
SHINGLE_WORDS = 3
SEED = 42
NIBBLES = 16
# A cell with more members than this is split by single bits instead of compared in one task.
CELL_MEMBERS = 1_024
_CHUNK = 65_536


def simhash(text: str) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    width = min(SHINGLE_WORDS, len(words))
    digest = xxhash.xxh64_intdigest
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(spans), _CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans[i : i + _CHUNK]], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans)).view(">i8")[0])


def _simhashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprint(text: Column) -> Column:
    return F.pandas_udf(_simhashes, "long")(F.coalesce(text, F.lit("")))


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def pivot_coordinates(fp: Column) -> list[Column]:
    """Set bits of each nibble, read off the distances to the reference fingerprints."""
    to_zero = F.bit_count(fp)
    to_nibble = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(0xF << 4 * b)))) for b in range(NIBBLES)]
    return [F.shiftright(to_zero - d + 4, 1) for d in to_nibble]


def cells(distinct: DataFrame) -> DataFrame:
    """Every fingerprint with the coordinate vectors at most one step from its own."""
    own = None
    for b, c in enumerate(pivot_coordinates(F.col("fp"))):
        place = F.shiftleft((c + 1).cast("long"), 3 * b)
        own = place if own is None else own + place
    steps = [0] + [sign << 3 * b for b in range(NIBBLES) for sign in (1, -1)]
    return (
        distinct.select("fp", own.alias("own"))
        .select("fp", "own", F.explode(F.array(*[F.lit(s).cast("long") for s in steps])).alias("step"))
        .select("fp", (F.col("own") + F.col("step")).alias("cell"))
    )


def _spanning_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Verified links of each cell, only as many as hold its members together."""
    for batch in batches:
        u: list[int] = []
        v: list[int] = []
        for members in batch["members"]:
            m = np.unique(np.asarray(members, dtype=np.int64))
            todo = np.ones(len(m), dtype=bool)
            for root in range(len(m)):
                if not todo[root]:
                    continue
                todo[root] = False
                front = [root]
                while front:
                    at = front.pop()
                    near = np.flatnonzero(todo & (np.bitwise_count((m ^ m[at]).view(np.uint64)) <= BITS))
                    todo[near] = False
                    front += near.tolist()
                    u += m[near].tolist()
                    v += [int(m[at])] * len(near)
        yield pd.DataFrame({"u": pd.Series(u, dtype="int64"), "v": pd.Series(v, dtype="int64")})


def links(distinct: DataFrame) -> DataFrame:
    """Links `(u, v)` between distinct fingerprints that hold every group within `BITS` bits together."""
    placed = cells(distinct)
    sized = staged(placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cells")
    met = placed.join(sized, "cell")
    small = met.where(F.col("n") <= CELL_MEMBERS).groupBy("cell").agg(F.collect_list("fp").alias("members"))
    verified = small.select("members").mapInPandas(_spanning_links, "u long, v long")
    # The exact way for larger cells: all fingerprints at most one bit from the same value are within
    # two bits of each other, and any two within two bits meet at such a value.
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)).cast("long") for b in range(64)])
    crowded = met.where(F.col("n") > CELL_MEMBERS).select("fp").distinct()
    around = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle")
    )
    tied = around.join(around.groupBy("middle").agg(F.min("fp").alias("v")), "middle").select(F.col("fp").alias("u"), "v")
    return verified.unionByName(tied).where("u <> v").distinct()


def groups(prints: DataFrame) -> DataFrame:
    """`(doc_id, fp)` rows to one row for each fingerprint with the smallest id of its component."""
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    roots = connected_components(links(distinct)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    prints = staged(documents.select("doc_id", fingerprint(F.col("text")).alias("fp")), "simhash")
    found = prints.join(groups(prints).select("fp", "component_id"), "fp")
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keyed_by_text(documents: DataFrame) -> DataFrame:
    return documents.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()))


def rows_of_first(documents: DataFrame, keyed: DataFrame, rooted: DataFrame) -> DataFrame:
    """The rows of the first `(doc_id, _text_hash)` of each root."""
    # Structs order nulls first; an id that exists goes before one that does not.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text_hash"))
    kept = (
        rooted.groupBy("root")
        .agg(first.alias("first"))
        .select(F.col("first.doc_id").alias("_kept_id"), F.col("first._text_hash").alias("_kept_hash"))
    )
    rows = keyed.join(
        kept, keyed["doc_id"].eqNullSafe(kept["_kept_id"]) & (keyed["_text_hash"] == kept["_kept_hash"]), "left_semi"
    )
    return rows.dropDuplicates(["doc_id", "_text_hash"]).select(*documents.columns)


def one_of_each_group(documents: DataFrame) -> DataFrame:
    """The documents with one row of each group: its smallest id, then the smallest text hash.

    A group without any id keeps the row of the smallest text hash; of identical rows one stays.
    """
    keyed = keyed_by_text(documents)
    prints = staged(
        keyed.select("doc_id", "_text_hash", fingerprint(F.col("text")).alias("fp")).distinct(), "simhash-rows"
    )
    return rows_of_first(documents, keyed, prints.join(groups(prints).select("fp", "root"), "fp"))
