"""Near-duplicates by circulant MinHash, confirmed by exact Jaccard similarity.

Two permutations of the 32-bit numbers make a whole signature: the first scatters the shingles of a set,
the second orders them, shifted circularly by k places for coordinate k. Coordinates are cut into bands;
sets that agree in a band are candidates. A pair at the bound of 0.8 misses all 32 bands of four with a
probability of 5e-8, a pair above it with less.

Equal sets are one node. Nodes that share a band are not all compared with each other:
 - in two rounds every node is checked against one centre of its bands that is not yet known to be
   connected to it: first the member that shares most bands with others, as the original of a group of
   copies does, then the one that agrees with it most among two other members of each of its bands. So a
   group is held together by a few checks a member;
 - the pairs of a band that are still unconnected after that are tested one by one, so no link is lost. A band
   of more than `BLOCK` members is cut into blocks, and every two blocks meet in a task's tile of their own.
Before sets are fetched, a pair must be near enough in size for the bound, and its signatures, kept as four bits a
coordinate, must agree in as many places as five standard deviations below what the bound makes expected (missed:
3e-7 of the pairs at the bound). In the last step sets of at most `FOLDED_SHINGLES` must instead share enough of
their shingles folded to 16 bits, which never understates what two sets share; all pairs of a tile are counted by
one product of matrices. Larger sets go by a signature four times as long and, where both have been checked against
one centre, by their distances to it (Jaccard distance is a metric, so that test is exact). Links are then confirmed
on the whole sets, in whole numbers.

A text with fewer words than a shingle has its whole sequence as its one shingle; null, empty and blank
texts have the empty set and are linked with nothing, not even with each other. Repeated rows and rows of
one text are one group. Rows without an id get the smallest id that they reach (null if there is none) and
are not kept. Rows of one id with different texts are different nodes. Texts of any length are read whole;
columns other than `doc_id` and `text` are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.shared import staged, text_or_empty

# Similarity as a ratio of whole numbers, so the bound itself is decided exactly.
PART, WHOLE = 80, 100
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
LONG_COORDINATES = 4 * COORDINATES
# Standard deviations that the agreement of a similar pair may fall short of what is expected.
SHORTFALL = 5
# Centres of each band by round: the most popular member, then others.
STAR_ROUNDS = (1, 2)
# Sets of more shingles than this are not folded: their pairs go by the signature.
FOLDED_SHINGLES = 4_096
# Members of a band that meet those of another block in one tile, and columns of a tile counted at a time.
BLOCK = 1_024
_COLUMNS = 4_096
_CHUNK = 1 << 16
_SLICE_ROWS = 512
_U32, _U64 = np.uint32, np.uint64


def _scramble(x: np.ndarray, multipliers: tuple[int, int]) -> np.ndarray:
    """A permutation of the 32-bit numbers: xor-shifts and odd multipliers can all be undone."""
    a, b = (_U32(m) for m in multipliers)
    x = x ^ (x >> _U32(16))
    x *= a
    x ^= x >> _U32(15)
    x *= b
    x ^= x >> _U32(16)
    return x


# Odd constants of the two permutations.
SCATTER, ORDER = (0x9E3779B1, 0x85EBCA77), (0x7FEB352D, 0x846CA68B)


class _Words(dict):
    """Hashes of words that came up, forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self) -> None:
        if len(self) > _CHUNK:
            self.clear()


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Some rows at a time, so that what is derived from them stays small."""
    for batch in batches:
        for i in range(0, len(batch), _SLICE_ROWS):
            yield batch.iloc[i : i + _SLICE_ROWS]


def shingle_set(text: str, width: int, seen: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U64)
    h = np.fromiter((seen[w] for w in words), dtype=_U64, count=len(words))
    width = min(width, len(h))
    run = np.full(len(h) - width + 1, width, dtype=_U64)
    for j in range(width):
        run = (run ^ h[j : len(h) - width + 1 + j]) * _U64(0x9E3779B97F4A7C15)
        run ^= run >> _U64(29)
    return np.unique(run)


def _folded(x: np.ndarray) -> np.ndarray:
    return (x ^ (x >> _U64(32))).astype(_U32)


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """The coordinates of non-empty sets, one row a set."""
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, dtype=_U32)
    first = 0
    while first < len(sets):
        # As many sets as fit into the processor's cache; a larger set goes alone, piece by piece.
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= _CHUNK):
            total += len(sets[last])
            last += 1
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[first : last - 1]], dtype=np.int64)]).astype(np.int64)
        placed = _scramble(_folded(np.concatenate(sets[first:last])), SCATTER)
        for at in range(0, total, _CHUNK) if last == first + 1 else [0]:
            piece = placed[at : at + _CHUNK] if last == first + 1 else placed
            for k in range(coordinates):
                least = np.minimum.reduceat(_scramble(piece + _U32(k), ORDER), starts)
                np.minimum(out[first:last, k], least, out=out[first:last, k])
        first = last
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, over rows of coordinates."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(_U64)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U64), (len(signature), BANDS)).copy()
    for j in range(ROWS):
        key = (key ^ parts[:, :, j]) * _U64(0xD6E8FEB86659FD93)
        key ^= key >> _U64(32)
    return key.view(np.int64)


def four_bits(signature: np.ndarray) -> np.ndarray:
    """The last four bits of every coordinate, sixteen coordinates to a number."""
    low = (signature & _U32(15)).astype(np.uint8)
    return np.ascontiguousarray(low[:, ::2] << 4 | low[:, 1::2]).view(np.int64).reshape(len(signature), signature.shape[1] // 16)


def folded_shingles(hashes: np.ndarray) -> np.ndarray | None:
    """The distinct last 16 bits of the shingles of a small set."""
    return np.unique((hashes & _U64(0xFFFF)).astype(np.uint16)).view(np.int16) if len(hashes) <= FOLDED_SHINGLES else None


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype=np.int64)
    return int(d[0]), int(d[1])


def sketched(documents: DataFrame, width: int) -> DataFrame:
    """Adds `n_shingles`, the digest `(hi, lo)` of the set, its band keys and its signature at four bits a coordinate.

    Expects `text` without nulls; passes the other columns on and drops the text.
    """
    passed = [c for c in documents.columns if c != "text"]

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _Words()
        for batch in _slices(batches):
            sets = [shingle_set(t, width, seen) for t in batch["text"]]
            seen.trim()
            some = [i for i, s in enumerate(sets) if len(s)]
            signed = signatures([sets[i] for i in some])
            keys = band_keys(signed)
            bits = four_bits(signed)
            digests = [_digest(s) if len(s) else (None, None) for s in sets]
            out = batch[passed].copy()
            out["n_shingles"] = [len(s) for s in sets]
            out["hi"] = pd.array([d[0] for d in digests], dtype="Int64")
            out["lo"] = pd.array([d[1] for d in digests], dtype="Int64")
            bands: list[np.ndarray | None] = [None] * len(sets)
            words: list[np.ndarray | None] = [None] * len(sets)
            for row, i in enumerate(some):
                bands[i], words[i] = keys[row], bits[row]
            out["bands"], out["bits"] = bands, words
            yield out

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name in passed)
    return documents.mapInPandas(
        sketch, f"{types}, n_shingles long, hi long, lo long, bands array<long>, bits array<long>"
    )


def similar_size(a: Column, b: Column, bound: tuple[int, int]) -> Column:
    return (a * bound[1] >= b * bound[0]) & (b * bound[1] >= a * bound[0])


def differing(a: Column, b: Column, coordinates: int = COORDINATES) -> Column:
    """In how many coordinates the kept bits differ."""
    out = F.lit(0)
    for i in range(coordinates // 16):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))  # the last bit of each four says whether any of them differs
        out = out + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def most_differing(bound: tuple[int, int], coordinates: int = COORDINATES) -> int:
    # At similarity J four kept bits agree with probability J + (1 - J) / 16.
    agreeing = bound[0] / bound[1] * 15 / 16 + 1 / 16
    least = coordinates * agreeing - SHORTFALL * math.sqrt(coordinates * agreeing * (1 - agreeing))
    return coordinates - math.floor(least)


def measured(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """`(u, v, shared, total)`: sizes of the intersection and the union of each pair's sets."""
    both = pairs.join(arrays.select(F.col("set_id").alias("u"), F.col("shingles").alias("a")), "u").join(
        arrays.select(F.col("set_id").alias("v"), F.col("shingles").alias("b")), "v"
    )
    shared = F.size(F.array_intersect("a", "b")).cast("long")
    sized = both.select("u", "v", shared.alias("shared"), (F.size("a") + F.size("b")).cast("long").alias("sum"))
    return sized.select("u", "v", "shared", (F.col("sum") - F.col("shared")).alias("total"))


def similar(shared: Column, total: Column, bound: tuple[int, int]) -> Column:
    return shared * bound[1] >= total * bound[0]


def shingle_arrays(homes: DataFrame, keyed: DataFrame, width: int, bound: tuple[int, int] = (PART, WHOLE)) -> DataFrame:
    """`(set_id, doc_id, text_hash)` to `(set_id, shingles, long_bits, folded)`, reading one text of each set again.

    Small sets that no set too large to be folded can be similar to have no `long_bits`.
    """

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _Words()
        for batch in _slices(batches):
            sets = [shingle_set(t, width, seen) for t in batch["text"]]
            seen.trim()
            large = [i for i, s in enumerate(sets) if len(s) * bound[1] > FOLDED_SHINGLES * bound[0]]
            bits: list[np.ndarray | None] = [None] * len(sets)
            for i, row in zip(large, four_bits(signatures([sets[i] for i in large], LONG_COORDINATES)), strict=True):
                bits[i] = row
            plain = {"shingles": [s.view(np.int64) for s in sets], "long_bits": bits}
            plain["folded"] = [folded_shingles(s) for s in sets]
            yield pd.DataFrame({"set_id": batch["set_id"].to_numpy(), **{k: pd.Series(v, dtype=object) for k, v in plain.items()}})

    # Copies under one id come along; their ids and hashes are the same, so they are cut before the sets are made.
    named = homes.select("set_id", F.col("doc_id").alias("home_id"), F.col("text_hash").alias("home_hash"))
    rows = keyed.join(named, (keyed["text_hash"] == named["home_hash"]) & keyed["doc_id"].eqNullSafe(named["home_id"]))
    one = rows.select("set_id", "text").dropDuplicates(["set_id"])
    return one.mapInPandas(arrays, "set_id long, shingles array<long>, long_bits array<long>, folded array<smallint>")


def _rooted(postings: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Postings of the bands that still hold unconnected sets."""
    if roots is None:
        found = postings.withColumn("root", F.col("set_id"))
    else:
        found = postings.join(roots.select(F.col("u").alias("set_id"), F.col("v").alias("root")), "set_id", "left")
        found = found.withColumn("root", F.coalesce("root", "set_id"))
    mixed = found.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    return found.join(mixed, "key", "left_semi")


def _centred(open_: DataFrame, step: int, bound: tuple[int, int]) -> DataFrame:
    """One pair `(member, centre)` for each set, with a centre of its bands it may be connected to.

    First the most popular one; later, where bands have other centres, the one that agrees most.
    """
    orders = [F.col("popular") if step == 0 else F.xxhash64("set_id", F.lit(i)) for i in range(STAR_ROUNDS[step])]
    firsts = [F.max(F.struct(o.alias("order"), "set_id", "n_shingles", "bits", "root")) for o in orders]
    centres = open_.groupBy("key").agg(F.array(*firsts).alias("c")).select("key", F.explode("c").alias("c"))
    apart = differing(F.col("bits"), F.col("c.bits"))
    met = open_.join(centres, "key").where(
        (F.col("root") != F.col("c.root"))
        & similar_size(F.col("n_shingles"), F.col("c.n_shingles"), bound)
        & (apart <= most_differing(bound))
    )
    rank = F.col("c.order") if step == 0 else -apart
    best = met.groupBy("set_id").agg(F.max(F.struct(rank.alias("rank"), F.col("c.set_id"))).alias("c"))
    return best.select(F.col("set_id").alias("member"), F.col("c.set_id").alias("centre"))


def _tiled(open_: DataFrame) -> DataFrame:
    """Postings once for every tile `(key, i, j)` of two blocks, or of one with itself, that their own block is in."""
    sized = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    placed = open_.join(sized, "key").withColumn("block", own)
    tiles = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")),
    )
    return placed.withColumn("tile", F.explode(tiles)).drop("blocks")


def _items(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column without its nulls, and the number of values of each row."""
    return lists.flatten().to_numpy(), lists.value_lengths().fill_null(0).to_numpy()


def _most_shared(folded: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least as many shingles as the sets `a` share with the sets `b`: what folding merged in one of two is added."""
    values, sizes = _items(folded)
    values, rows = values.view(np.uint16), np.repeat(np.arange(len(sizes)), sizes)
    often = np.bincount(values, minlength=1 << 16) > 1
    column = np.cumsum(often) - 1
    rows, places = rows[often[values]], column[values[often[values]]]
    shared = np.zeros((len(a), len(b)), dtype=np.float32)
    for at in range(0, column[-1] + 1, _COLUMNS):
        here = (places >= at) & (places < at + _COLUMNS)
        holds = np.zeros((len(sizes), min(_COLUMNS, column[-1] + 1 - at)), dtype=np.float32)
        holds[rows[here], places[here] - at] = 1
        shared += holds[a] @ holds[b].T
    merged = n - sizes
    return shared.astype(np.int64) + np.minimum.outer(merged[a], merged[b])


def _agreeing(bits: np.ndarray, a: int, b: np.ndarray, most: int) -> np.ndarray:
    x = bits[b] ^ bits[a]
    x |= x >> _U64(1)
    x |= x >> _U64(2)
    return np.bitwise_count(x & _U64(0x1111111111111111)).sum(axis=1, dtype=np.int64) <= most


def _apart(p: list[dict], q: list[dict], most: float) -> bool:
    known = {x["centre"]: x["distance"] for x in p}
    return any(abs(known.get(x["centre"], x["distance"]) - x["distance"]) > most for x in q)


def _tile_pairs(members: pa.StructArray, same: bool, bound: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the members of a tile that the tests leave possible, unconnected ones only."""
    n, root, block = (members.field(c).to_numpy() for c in ("n_shingles", "root", "block"))
    a, b = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    if not same and block.min() == block.max():
        return a[:0], b[:0]
    open_ = root[a][:, None] < root[b] if same else root[a][:, None] != root[b]
    shared = _most_shared(members.field("folded"), n, a, b)
    close = open_ & (shared * bound[1] >= (n[a][:, None] + n[b] - shared) * bound[0])
    whole = members.field("folded").is_null().to_numpy(zero_copy_only=False)
    if whole.any():
        close &= ~(whole[a][:, None] | whole[b])
        some = np.flatnonzero(members.field("long_bits").is_valid().to_numpy(zero_copy_only=False))
        bits = np.zeros((len(n), LONG_COORDINATES // 16), dtype=_U64)
        bits[some] = _items(members.field("long_bits"))[0].view(_U64).reshape(len(some), -1)
        pivots = members.field("pivots").to_pylist()
        most, far = most_differing(bound, LONG_COORDINATES), 1 - bound[0] / bound[1] + 1e-9
        for i, x in enumerate(a):
            sized = (n[b] * bound[1] >= n[x] * bound[0]) & (n[x] * bound[1] >= n[b] * bound[0])
            todo = np.flatnonzero(open_[i] & sized & (whole[x] | whole[b]))
            todo = todo[_agreeing(bits, x, b[todo], most)]
            close[i, [k for k in todo if not _apart(pivots[x] or [], pivots[b[k]] or [], far)]] = True
    i, j = np.nonzero(close)
    return a[i], b[j]


def _remaining(open_: DataFrame, bound: tuple[int, int], facts: DataFrame | None = None) -> DataFrame:
    """Every pair of a band that is not connected yet and that shingles, signatures and known distances leave possible.

    What is tested comes with the postings or, by `set_id`, from `facts`, which join where the tiles are known.
    """
    dealt = _tiled(open_)
    if facts is not None:
        dealt = dealt.select("set_id", "n_shingles", "root", "key", "block", "tile").join(facts, "set_id")
    member = F.struct("set_id", "n_shingles", "root", "block", "folded", "long_bits", "pivots")
    tiles = dealt.groupBy("key", "tile").agg(F.collect_list(member).alias("members"))
    tiles = tiles.where(F.size("members") > 1).select((F.col("tile.i") == F.col("tile.j")).alias("same"), "members")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, same in enumerate(batch.column("same").to_pylist()):
                members = batch.column("members").slice(row, 1).flatten()
                members = pa.StructArray.from_arrays(members.flatten(), names=[f.name for f in members.type])
                ids = members.field("set_id").to_numpy()
                i, j = _tile_pairs(members, same, bound)
                if len(i):
                    u, v = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return tiles.mapInArrow(pairs, "u long, v long").distinct()


def _pivots(sets: DataFrame, distances: DataFrame) -> DataFrame:
    """Each set's known distances to centres, at most one a round, and 0 to itself where it is one; null for folded sets."""
    held = distances.groupBy(F.col("member").alias("set_id")).agg(
        F.collect_list(F.struct("centre", "distance")).alias("pivots")
    )
    own = F.array(F.struct(F.col("set_id").alias("centre"), F.lit(0.0).alias("distance")))
    all_ = F.concat(own, F.coalesce("pivots", F.array().cast(PIVOTS)))
    return sets.join(held, "set_id", "left").withColumn("pivots", F.when(F.col("folded").isNull(), all_))


PIVOTS = "array<struct<centre: bigint, distance: double>>"


def similar_sets(
    sets: DataFrame,
    keyed: DataFrame,
    width: int,
    bound: tuple[int, int] = (PART, WHOLE),
    proposed: DataFrame | None = None,
) -> DataFrame:
    """Links between distinct sets, as `(u, v)`: every non-smallest set id with the smallest it reaches.

    `sets` has one row a set: `set_id`, `n_shingles`, `bands`, `bits` and its home `(doc_id, text_hash)`;
    `keyed` has the texts as `(doc_id, text_hash, text)`. Pairs `(u, v)` of set ids that are `proposed` are
    checked together with the first centres.
    """
    placed = sets.select("set_id", F.explode("bands").alias("key"))
    # Postings are shuffled once; a band is a window of two numbers a row, on disk where it is long.
    counted = placed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    met = staged(counted.where("n > 1"), "bands")
    popular = met.groupBy("set_id").agg(F.sum("n").alias("popular"))
    facts = sets.select("set_id", "n_shingles", "bits").join(popular, "set_id")
    postings = staged(met.select("set_id", "key").join(facts, "set_id"), "postings")
    named = popular.select("set_id")
    if proposed is not None:
        named = named.unionByName(proposed.select(F.explode(F.array("u", "v")).alias("set_id"))).distinct()
    near = sets.join(named, "set_id", "left_semi")
    arrays = staged(shingle_arrays(near.select("set_id", "doc_id", "text_hash"), keyed, width, bound), "shingles")
    enough = similar(F.col("shared"), F.col("total"), bound)
    links, roots, distances = None, None, None
    for step in range(len(STAR_ROUNDS)):
        open_ = staged(_rooted(postings, roots), "open")
        pairs = _centred(open_, step, bound).select(F.col("member").alias("u"), F.col("centre").alias("v"))
        if step == 0 and proposed is not None:
            pairs = pairs.unionByName(proposed).distinct()
        found = staged(measured(pairs, arrays), "measured")
        new = found.where(enough).select("u", "v")
        links = new if links is None else roots.unionByName(new)
        roots = connected_components(links)
        # Folded sets need no distances.
        known = found.where(F.col("total") > FOLDED_SHINGLES).select(
            F.col("u").alias("member"), F.col("v").alias("centre"), (1 - F.col("shared") / F.col("total")).alias("distance")
        )
        distances = known if distances is None else distances.unionByName(known)
    facts = _pivots(arrays.select("set_id", "long_bits", "folded"), distances)
    last = _remaining(_rooted(postings.select("set_id", "key", "n_shingles"), roots), bound, facts)
    return connected_components(roots.unionByName(measured(last, arrays).where(enough).select("u", "v")))


def text_rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text_hash().alias("text_hash"), text_or_empty().alias("text"))


def text_hash() -> Column:
    return F.xxhash64(F.md5(F.encode(text_or_empty(), "UTF-8")), F.col("text").isNull())


def distinct_sets(sketches: DataFrame) -> DataFrame:
    """One row a non-empty set, with a number that holds once the rows are written."""
    others = [c for c in sketches.columns if c not in ("doc_id", "text_hash", "hi", "lo")]
    home = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", *others)
    one = sketches.where("n_shingles > 0").groupBy("hi", "lo").agg(F.min(home).alias("home"))
    named = one.select("hi", "lo", "home.*").drop("none")
    return staged(named.withColumn("set_id", F.monotonically_increasing_id()), "sets")


def near_duplicates(documents: DataFrame, width: int = 2, bound: tuple[int, int] = (PART, WHOLE)) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)` for every row of `documents`."""
    keyed = text_rows(documents)
    sketches = staged(sketched(keyed, width), "sketches")
    sets = distinct_sets(sketches)
    roots = similar_sets(sets, keyed, width, bound).select(F.col("u").alias("set_id"), F.col("v").alias("root"))
    rooted = sets.select("hi", "lo", "set_id", "doc_id").join(roots, "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = rooted.select("hi", "lo", "root").join(least, "root").select("hi", "lo", "component_id")
    some = sketches.where("n_shingles > 0").select("doc_id", "n_shingles", "hi", "lo").join(placed, ["hi", "lo"])
    none = sketches.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    found = some.select(*columns).unionByName(none.select(*columns))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
        ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM words
), items AS (SELECT doc_id, unnest(s) AS x FROM sets),
sized AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT u, v FROM shared JOIN sized m ON m.doc_id = u JOIN sized n ON n.doc_id = v WHERE 100 * c >= 80 * (m.n + n.n - c)
), edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reached AS (
    SELECT doc_id, doc_id AS r FROM documents UNION SELECT reached.doc_id, e.v FROM reached JOIN edges e ON e.u = reached.r
), least AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sized JOIN least USING (doc_id)
"""
