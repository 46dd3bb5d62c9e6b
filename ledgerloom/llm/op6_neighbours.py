"""Approximate nearest neighbours by collision counting.

Vectors are scaled to unit length and projected on random directions; each direction keeps its own sorted
array. A query opens a window around its own projection in every array. Virtual rehashing widens all windows
step by step, counting for each vector the windows it fell into; vectors in enough windows are verified by
exact cosine, and widening stops when enough were verified. Arrays are built per block of vectors, and every
block of queries meets every block of vectors, so no task holds more than two blocks.

Vectors that are null, zero, or hold a null or non-finite component take no part. Vectors of unequal
dimension are never compared. Rows equal in id and vector count once. Rows of one id with different vectors are
candidates of their own, for each other too, and as queries each gets its own list under the id. Fewer
candidates than asked for are all returned; ties go to the smaller id. Null ids take no part. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged

NEIGHBOURS = 5
QUERY_STEP = 50
DIRECTIONS = 96
# Share of the windows a vector must fall into; what to verify before stopping, as a share of a block and at least.
COLLISIONS = 0.62
VERIFIED = 0.12
LEAST_VERIFIED = 600
FIRST_RADIUS = 0.8
WIDEN = 1.15
ROUNDS = 12
BLOCK_VECTORS = 8_192
BLOCK_QUERIES = 4_096
SEED = 20


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """`(row, vec_id, dim, v)` of the vectors that take part; `row` numbers the different ones."""
    v = F.col(column).cast("array<double>")
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(F.col("v"), lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL"
    )
    different = rows.where(~bad & some).distinct()
    numbered = different.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("v").alias("dim"), "v")
    return staged(numbered, "vectors")


def search(
    x: np.ndarray, ids: np.ndarray, rows: np.ndarray, q: np.ndarray, own: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """`(index of the query, index of the vector, cosine)` of the nearest verified vectors of one block.

    `own` are the rows of the queries themselves.
    """
    n, dim = x.shape
    directions = np.random.default_rng(SEED).standard_normal((dim, DIRECTIONS))
    x_norm, q_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    x_at, q_at = (x / x_norm[:, None]) @ directions, (q / q_norm[:, None]) @ directions
    order = np.argsort(x_at, axis=0, kind="stable").T.copy()
    arrays = np.take_along_axis(x_at.T, order, axis=1)
    enough = min(n, max(k + 1, int(VERIFIED * n), LEAST_VERIFIED))
    needed = int(COLLISIONS * DIRECTIONS)
    # The last radius covers every array whole, so each query ends with all vectors counted at the latest.
    radii = FIRST_RADIUS * WIDEN ** np.arange(ROUNDS)
    radii[-1] = np.abs(x_at).max() + np.abs(q_at).max() + 1
    edges = [
        (a.searchsorted(p[:, None] - radii, "left"), a.searchsorted(p[:, None] + radii, "right"))
        for a, p in zip(arrays, q_at.T, strict=True)
    ]
    lows, highs = (np.stack([e[side] for e in edges], axis=-1) for side in (0, 1))  # query, round, direction
    out: list[tuple[np.ndarray, ...]] = []
    count = np.empty(n, dtype=np.int64)
    for i in range(len(q)):
        count[:] = 0
        for r in range(ROUNDS):
            low, high = lows[i, r].tolist(), highs[i, r].tolist()
            if r == 0:
                fresh = [order[j, a:b] for j, (a, b) in enumerate(zip(low, high, strict=True))]
            else:
                past = zip(low, high, lows[i, r - 1].tolist(), highs[i, r - 1].tolist(), strict=True)
                fresh = [order[j, c:d] for j, (a, b, e, f) in enumerate(past) for c, d in ((a, e), (f, b))]
            count += np.bincount(np.concatenate(fresh), minlength=n)
            near = np.flatnonzero(count >= needed)
            if len(near) >= enough:
                break
        near = near[rows[near] != own[i]]
        cosine = (x[near] @ q[i]) / (x_norm[near] * q_norm[i])
        best = np.lexsort((rows[near], ids[near], -cosine))[:k]
        out.append((np.full(len(best), i), near[best], cosine[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def _block_search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def found(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = [field.split()[0] for field in FOUND.split(", ")]
        if not len(vectors) or not len(queries):
            return pd.DataFrame(np.empty((0, len(names))), columns=names).astype(dict.fromkeys(names[:-1], "int64"))
        ids, rows = vectors["vec_id"].to_numpy(), vectors["row"].to_numpy()
        own, asked = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
        at, near, score = search(
            np.stack(vectors["v"].to_numpy()).astype(float), ids, rows,
            np.stack(queries["v"].to_numpy()).astype(float), own, k,
        )
        return pd.DataFrame(dict(zip(names, (own[at], asked[at], rows[near], ids[near], score), strict=True)))

    return found


def nearest(vectors: DataFrame, column: str = "embedding", k: int = NEIGHBOURS, step: int = QUERY_STEP) -> DataFrame:
    """Each query's `k` nearest found: queries are the rows whose id is a multiple of `step`."""
    rows = usable(vectors, column)
    is_query = F.col("vec_id") % step == 0
    total, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, chunks = max(1, -(-total // BLOCK_VECTORS)), max(1, -(-asked // BLOCK_QUERIES))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    placed = rows.select("*", part(blocks).alias("block")).select("*", each(chunks).alias("chunk"))
    queries = rows.where(is_query).select("*", part(chunks).alias("chunk")).select("*", each(blocks).alias("block"))
    keys = ["dim", "block", "chunk"]
    found = (
        placed.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInPandas(_block_search(k), FOUND)
    )
    best = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
