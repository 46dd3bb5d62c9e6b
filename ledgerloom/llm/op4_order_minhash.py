"""Document fingerprints by order MinHash, in built-in expressions only.

A text's k-mers are its runs of three words, each numbered by its occurrence. One hash deals the numbered
k-mers over 64 bins; every bin keeps its two smallest, puts them back into text order and hashes the pair.
A bin's hash therefore changes when its k-mers go or change places: the share of equal bins falls with edit
distance, not only with the common vocabulary.

Null and empty texts have the empty fingerprint, and two of those are alike (1). Texts of fewer than three
words have one k-mer, their whole sequence. Neighbours follow the id, null ids last, equal ids by text
hash; the last document's neighbour is the first, a single document's is itself. Equal rows get equal
fingerprints. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.shared import text_or_empty

WORDS = 3
BIN_BITS = 6
SLOT_DIGITS = 4
# A packed entry is a hash in the high bits and the k-mer's place in the low ones: 2^28 words is more
# than a string can hold.
PLACE_BITS = 28
_PLACE = (1 << PLACE_BITS) - 1
STRETCHES = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body looks at it."""
    return F.transform(F.array(value), body)[0]


def _key(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, PLACE_BITS)


def _place(entry: Column) -> Column:
    return entry.bitwiseAND(F.lit(_PLACE))


def _bin(entry: Column) -> Column:
    return F.shiftrightunsigned(entry, 64 - BIN_BITS)


def _pack(value: Column, place: Column) -> Column:
    return value.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))


def _kmers(text: Column) -> Column:
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.transform(F.filter(F.split(spaced, " "), lambda w: w != ""), lambda w: F.xxhash64(w))
    nothing = F.array().cast("array<bigint>")

    def hashed(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(w) - WORDS, F.lit(0)))
        kmer = lambda i: _pack(F.xxhash64(*[F.get(w, i + j) for j in range(WORDS)]), i)
        return F.when(F.size(w) == 0, nothing).otherwise(F.sort_array(F.transform(places, kmer)))

    return let(words, hashed)


def _numbered(kmers: Column) -> Column:
    """Rehashed with the occurrence number: the distance to the first equal k-mer in sorted order."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(PLACE_BITS))])

    def rehash(s: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            same = lambda at: _key(F.get(s, at)) == _key(x)
            back = lambda at, step: F.when((at >= step) & same(at - step), at - step).otherwise(at)
            first = F.when((i > 0) & same(i - 1), F.aggregate(steps, i, back)).otherwise(i)
            return _pack(F.xxhash64(_key(x), i - first), _place(x))

        return F.sort_array(F.transform(s, one))

    return let(kmers, rehash)


def _slots(numbered: Column) -> Column:
    def smallest(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i < 2) | (_bin(F.get(s, i - 2)) != _bin(x)))

    def slots(s: Column) -> Column:
        def slot(x: Column, i: Column) -> Column:
            other = F.get(s, i + 1)
            pair = (
                F.when(other.isNull() | (_bin(other) != _bin(x)), F.xxhash64(_key(x)))
                .when(_place(x) < _place(other), F.xxhash64(_key(x), _key(other)))
                .otherwise(F.xxhash64(_key(other), _key(x)))
            )
            digits = F.lpad(F.hex(pair.bitwiseAND(F.lit(16**SLOT_DIGITS - 1))), SLOT_DIGITS, "0")
            text = F.lower(F.concat(F.lpad(F.hex(_bin(x)), 2, "0"), digits))
            return F.when((i == 0) | (_bin(F.get(s, i - 1)) != _bin(x)), text)

        return F.filter(F.transform(s, slot), lambda t: t.isNotNull())

    return let(let(numbered, smallest), slots)


def signature(text: Column) -> Column:
    """The filled bins in a fixed order, each as its number and its pair's hash."""
    return _slots(_numbered(_kmers(text)))


def likeness(a: Column, b: Column) -> Column:
    """Equal bins over bins that either has filled."""
    bins = lambda s: F.transform(s, lambda t: F.substring(t, 1, 2))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / filled)


def _stretch(bounds: list[int]) -> Column:
    """How many bounds the id has reached, by bisection; null ids come after all."""
    if not bounds:
        return F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))])
    further = lambda n, step: F.when(
        (n + step <= len(bounds)) & (F.get(array, n + step - 1) <= F.col("doc_id")), n + step
    ).otherwise(n)
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(F.aggregate(steps, F.lit(0), further))


def with_neighbours(rows: DataFrame) -> DataFrame:
    """Adds the row's `signature`, and `next_text` and `next_signature` from the row that follows.

    Ids are cut into stretches at their quantiles, a few for each shuffle partition. Every stretch also
    gets the first rows of the one after it, so neighbours are found in one shuffle without a global window.
    """
    spark = rows.sparkSession
    wanted = STRETCHES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = [i / wanted for i in range(1, wanted)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", quantiles, 10 * wanted)).first()[0]
    placed = rows.withColumn("_stretch", _stretch(sorted(set(found or []))))
    # One row per stretch, bounded by the number of tasks.
    firsts = (
        placed.groupBy("_stretch")
        .agg(F.min("doc_id").alias("id"), F.min(F.when(F.col("doc_id").isNull(), F.col("text_hash"))).alias("hash"))
        .orderBy("_stretch")
        .collect()
    )
    before = [(f["id"], f["hash"], firsts[i - 1]["_stretch"]) for i, f in enumerate(firsts)]
    # Without rows there are no stretches, and the union below is empty.
    target = spark.createDataFrame(before, "_id long, _hash long, _to int")
    is_first = F.when(F.col("doc_id").isNull(), F.col("text_hash") == F.col("_hash")).otherwise(F.lit(True))
    copies = (
        rows.join(F.broadcast(target), F.col("doc_id").eqNullSafe(F.col("_id")) & is_first)
        .withColumn("_stretch", F.col("_to"))
        .drop("_id", "_hash", "_to")
    )
    both = placed.withColumn("_copy", F.lit(0)).unionByName(copies.withColumn("_copy", F.lit(1)))
    both = both.withColumn("signature", signature(F.col("text")))
    order = W.partitionBy("_stretch").orderBy("_copy", F.col("doc_id").isNull(), "doc_id", "text_hash")
    return (
        both.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_signature", F.lead("signature").over(order))
        .where("_copy = 0")
        .drop("_copy", "_stretch")
    )


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and how alike they and its neighbour's are."""
    rows = documents.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash")
    )
    n = F.length("text")
    edited = F.concat(
        F.substring("text", F.lit(1), n - F.floor(n / 2).cast("int")),
        F.substring("next_text", F.lit(1), F.floor(n / 2).cast("int")),
    )
    changed = with_neighbours(rows).select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature"
    )
    return (
        changed.select("*", signature(F.col("edited")).alias("edited_signature"))
        .select(
            "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            F.array_join("signature", "").alias("fingerprint"),
            F.array_join("edited_signature", "").alias("edited_fingerprint"),
            likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
            likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
        )
    )
