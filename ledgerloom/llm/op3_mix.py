"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a hash and sent up to three times, pass after pass. A document's virtual
finish time is the words its source has sent by its end, divided by the source's target. All documents of all
sources are range-sorted by finish time, a running total of their words is taken over the whole order, and
the order is cut where the total budget is spent. The one document that each queue is sending as its target
is reached goes word by word around that place, so the cut falls inside it and a source comes within a few
words of its target, however long its documents are.

Null texts have no words, a null source is a source of its own and ordered last, rows with equal ids are
separate rows. Equal rows may swap their places. Everything is a function of the rows: reruns agree.
An empty table gives an empty mix. Sources without words have the target 0. Texts of any length are counted
whole; columns other than the document's own are passed on by `mixed_documents` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.prefix import running_totals
from ledgerloom.llm.shared import staged, text_or_empty

MAX_PASSES = 3
# So many words behind a target are sent one by one.
SINGLE_WORDS = 64
WEIGHTS = 3
_WORD = r"[^\x20\x09-\x0D]+"
_SAME_ROW = ("doc_id", "text", "lang", "source", "n_chars")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_WORD)).cast("long")


def row_hash(documents: DataFrame) -> Column:
    """Equal for rows that are the same document row."""
    parts = [c for name in _SAME_ROW if name in documents.columns for c in (F.col(name), F.col(name).isNull())]
    return F.xxhash64(*parts)


def sized(documents: DataFrame) -> DataFrame:
    return staged(
        documents.select("doc_id", "source", row_hash(documents).alias("row"), word_count(text_or_empty()).alias("size")),
        "mix-sizes",
    )


def weighted_sources(sizes: DataFrame) -> DataFrame:
    """`(source, source_size, weight)`: weights 1, 2, 3, repeating, in code point order with null last."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(totals, [F.col("source").isNull(), F.col("source")], F.lit(1), "rank")
    return staged(
        ranked.select("source", "source_size", ((F.col("rank") - 1) % WEIGHTS + 1).alias("weight")), "mix-sources"
    )


def with_targets(sources: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """Adds `target`: the budget shared by weight, none above `max_passes` times its source.

    The water level rises until no further source overflows; each round reads one row of sums.
    """
    most = F.col("source_size") * max_passes
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    full, level = 0, 0.0
    while budget:
        spill = F.col("weight") * F.lit(level) > most
        row = sources.agg(
            F.count_if(spill).alias("full"),
            F.sum(F.when(spill, most).otherwise(0)).alias("held"),
            F.sum(F.when(spill, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"] or (level and row["full"] == full):
            break
        full, level = row["full"], (budget - row["held"]) / row["open"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(float(level)), most.cast("double")))


def queued(documents: DataFrame) -> DataFrame:
    """Every document row, numbered by `at`, with its place in its source's queue: `start` words go before it."""
    sizes = sized(documents)
    sources = with_targets(weighted_sources(sizes))
    order = [F.col("source").isNull(), F.col("source"), F.xxhash64("row", F.lit("mix")), F.col("row")]
    lined = running_totals(sizes, order, F.col("size"), "sent").withColumn("sent", F.col("sent") - F.col("size"))
    lined = staged(lined.withColumn("at", F.monotonically_increasing_id()), "mix-queue")
    first = lined.groupBy("source").agg(F.min("sent").alias("first"))
    both = sources.join(first, sources["source"].eqNullSafe(first["source"])).drop(first["source"])
    return (
        lined.join(both, lined["source"].eqNullSafe(both["source"]))
        .drop(both["source"])
        .withColumn("start", F.col("sent") - F.col("first"))
    )


def packets(queue: DataFrame) -> DataFrame:
    """`(at, row, size, pass, words, finish)` of everything that the queues have to send."""
    one = F.explode(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1))).alias("pass")
    sent = queue.where("size > 0").select("at", "row", "size", "target", "start", "source_size", one)
    sent = sent.withColumn("before", F.col("pass") * F.col("source_size") + F.col("start"))
    # Where the target is reached, counted in words of this document.
    place = F.floor("target") - F.col("before")
    singles = F.transform(F.sequence(F.lit(0), F.lit(SINGLE_WORDS)), lambda i: place + i)
    inside = (place >= 0) & (place < F.col("size"))
    ends = F.when(inside, F.array_distinct(F.concat(singles, F.array("size")))).otherwise(F.array("size"))
    sent = sent.withColumn("ends", F.filter(ends, lambda e: (e > 0) & (e <= F.col("size"))))
    cut = F.transform(
        "ends",
        lambda e, i: F.struct(e.alias("end"), (e - F.when(i > 0, F.col("ends")[i - 1]).otherwise(0)).alias("words")),
    )
    each = sent.select("at", "row", "size", "pass", "before", "target", F.explode(cut).alias("p"))
    finish = (F.col("before") + F.col("p.end")) / F.col("target")
    return each.select("at", "row", "size", "pass", "p.words", finish.alias("finish"))


def served(queue: DataFrame) -> DataFrame:
    """The packets with the words `taken` of each before the budget is spent."""
    budget = queue.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget")).scalar()
    order = [F.col(c) for c in ("finish", "row", "at", "pass")]
    total = running_totals(packets(queue), order, F.col("words"), "total")
    left = budget - (F.col("total") - F.col("words"))
    return total.withColumn("taken", F.greatest(F.least(left, F.col("words")), F.lit(0)))


def mixture(documents: DataFrame) -> DataFrame:
    """One row per document row with its size, its source's size and target, and the words taken."""
    queue = queued(documents)
    taken = served(queue).groupBy("at").agg(F.sum("taken").alias("taken"))
    found = queue.join(taken, "at", "left")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mix as whole documents in serving order: a pass is in if at least half of its words are taken."""
    whole = served(queued(documents)).groupBy("at", "row", "size", "pass").agg(
        F.sum("taken").alias("taken"), F.max("finish").alias("finish")
    )
    chosen = (
        whole.where("2 * taken >= size")
        .groupBy(F.col("row").alias("_mix_served"))
        .agg(F.collect_list("finish").alias("_mix_finishes"))
    )
    keyed = documents.withColumn("_mix_row", row_hash(documents))
    return (
        # Equal rows are one row here: the finishes already hold the passes of each of them.
        keyed.join(chosen, F.col("_mix_row") == F.col("_mix_served"))
        .dropDuplicates(["_mix_row"])
        .withColumn("_mix_finish", F.explode("_mix_finishes"))
        .repartitionByRange("_mix_finish", "_mix_row")
        .sortWithinPartitions("_mix_finish", "_mix_row")
        .select(*documents.columns)
    )
