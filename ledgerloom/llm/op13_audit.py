"""Filter interaction audit by the Hart-Mas-Colell potential.

Each document is reduced to the set of filters that it fails, and each part (a source) to its counts per
failure set. A coalition of filters is worth the documents that fail at least one of its members. The
potential of a coalition is its worth plus the potentials without each member, divided by its size, with 0
for the empty one; a filter's Shapley value is the potential of all filters minus the potential without
that filter. Multiplied by the factorial of the number of filters every potential is a whole number, and
the Shapley value is then what the filter removes, summed over all orders. What a step of an order removes
is the difference of two coalitions.

Null texts are empty; all empty texts are identical. Texts are compared by their SHA-256. A row without an
id is no one's smaller copy and has no smaller copy. Rows of one id and text are not copies of each other.
A document is good or toxic if any label row of its id says so. Null sources form the part "", together
with empty ones. An empty table gives no rows. Texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged, text_or_empty

WORD_GAPS = r"[\x20\x09-\x0D]+"


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions that need nothing but the text, by filter letter."""
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * n_distinct < 50 * n_words,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(documents: DataFrame) -> DataFrame:
    """`(doc_id, part, text_hash, mask)`, one row a document; bit i of the mask is the i-th text filter."""
    texts = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_or_empty().alias("text"))
    split = texts.withColumn("words", F.array_remove(F.split("text", WORD_GAPS), ""))
    mask = F.lit(0)
    for i, failed in enumerate(failures(F.col("text"), F.col("words")).values()):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    return split.select("doc_id", "part", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_hash"), mask.alias("mask"))


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Adds the bit of a text that a smaller id has too.

    Only the first id of each text is looked up, by id and text, so copies never meet on their text.
    """
    first = rows.where("doc_id IS NOT NULL").groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"))
    marked = rows.join(first.withColumn("is_first", F.lit(True)), ["doc_id", "text_hash"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return marked.select("doc_id", "part", (F.col("mask") + F.when(copy, bit).otherwise(0)).alias("mask"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    known = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    # Rows without an id have no label; they would all meet in one join task.
    named = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left")
    return named.unionByName(rows.where("doc_id IS NULL"), allowMissingColumns=True)


def coalitions(rows: DataFrame, n_filters: int) -> DataFrame:
    """Per part: its size, counts per failure set, and three removal games as arrays over all coalitions."""
    counts = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )

    def game(column: str) -> Column:
        hit = [F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(column)).otherwise(0) for s in range(1 << n_filters)]
        return F.array(*[F.sum(h) for h in hit])

    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n_filters)]
    failing = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, F.col("n")).otherwise(0)) for i in range(n_filters)]
    return counts.groupBy("part").agg(
        F.sum("n").alias("n"),
        F.array(*alone).alias("alone"),
        F.array(*failing).alias("failing"),
        game("n").alias("removed"),
        game("good").alias("good"),
        game("toxic").alias("toxic"),
    )


def with_potentials(games: DataFrame, n_filters: int) -> DataFrame:
    """Adds what each filter removes summed over all orders, by potentials of coalitions of growing size.

    The columns `p<coalition>` are potentials times the factorial of `n_filters`.
    """
    out = games.withColumn("p0", F.lit(0).cast("long"))
    for size in range(1, n_filters + 1):
        level = {}
        for s in (s for s in range(1 << n_filters) if s.bit_count() == size):
            total = F.col("removed")[s] * factorial(n_filters)
            for i in range(n_filters):
                if s >> i & 1:
                    total = total + F.col(f"p{s ^ 1 << i}")
            level[f"p{s}"] = F.call_function("div", total, F.lit(size))
        out = out.withColumns(level)
    grand = (1 << n_filters) - 1
    shapley = [F.col(f"p{grand}") - F.col(f"p{grand ^ 1 << i}") for i in range(n_filters)]
    return out.select(*games.columns, F.array(*shapley).alias("shapley"))


def every_step(games: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from coalition differences."""
    orders = F.array(*[F.lit("".join(o)) for o in permutations(letters)])
    steps = (
        games.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
        .withColumn("at", F.instr(F.lit(letters), F.col("filter_order").substr(F.col("step"), F.lit(1))) - 1)
    )
    places = [F.instr("filter_order", c) for c in letters]
    # Coalitions of the filters up to this step, and of those before it.
    after = sum((F.when(p <= F.col("step"), 1 << i).otherwise(0) for i, p in enumerate(places)), F.lit(0))
    before = sum((F.when(p < F.col("step"), 1 << i).otherwise(0) for i, p in enumerate(places)), F.lit(0))
    steps = steps.withColumns({"after": after, "before": before})

    def step_of(game: str) -> Column:
        return F.col(game)[F.col("after")] - F.col(game)[F.col("before")]

    removed = step_of("removed")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - F.col("removed")[F.col("after")]).alias("kept"),
        removed.alias("removed"),
        (F.col("failing")[F.col("at")] - removed).alias("redundant"),
        F.col("alone")[F.col("at")].alias("unique_fails"),
        step_of("good").alias("good_lost"),
        step_of("toxic").alias("toxic_lost"),
        F.col("shapley")[F.col("at")].alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's rows: what each filter does at each step of each order, per source."""
    letters = "ABCDE"
    # Three narrow readers follow; texts are read once.
    rows = staged(judged(documents), "failures")
    marked = with_labels(with_copies(rows, 1 << letters.index("E")), labels)
    games = with_potentials(coalitions(marked, len(letters)), len(letters))
    return every_step(games, letters)


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS t,
           regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS words,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = o.doc_id AND l.quality = 1) AS good,
           EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = o.doc_id AND l.toxic = 1) AS toxic
    FROM documents o
), failing AS (
    SELECT part, good, toxic,
           len(words) < 200 AS A,
           100 * len(list_distinct(words)) < 50 * len(words) AS B,
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS C,
           regexp_matches(t, '[#$%&*|]') AS D,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E
    FROM d
), docs AS (
    SELECT part, good, toxic, concat(CASE WHEN A THEN 'A' ELSE '' END, CASE WHEN B THEN 'B' ELSE '' END,
        CASE WHEN C THEN 'C' ELSE '' END, CASE WHEN D THEN 'D' ELSE '' END, CASE WHEN E THEN 'E' ELSE '' END) AS failed
    FROM failing
), kinds AS (
    SELECT part, failed, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM docs GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
    SELECT a.c || b.c || d.c || e.c || f.c AS filter_order
    FROM letters a JOIN letters b ON b.c <> a.c JOIN letters d ON d.c NOT IN (a.c, b.c)
    JOIN letters e ON e.c NOT IN (a.c, b.c, d.c) JOIN letters f ON f.c NOT IN (a.c, b.c, d.c, e.c)
), steps AS (
    SELECT filter_order, s::INT AS step, substr(filter_order, s::INT, 1) AS c, left(filter_order, s::INT - 1) AS earlier
    FROM orders, range(1, 6) r(s)
), cells AS (
    SELECT part, filter_order, step, c, n, good, toxic,
           contains(failed, c) AS hit, failed = c AS only_hit,
           failed <> '' AND translate(failed, earlier, '') <> failed AS gone
    FROM kinds, steps
), sums AS (
    SELECT part, filter_order, step, c,
           sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN only_hit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley
FROM sums
"""
