"""Exact removal of every repeated 400-byte string of a corpus, by backward extension in suffix order.

Each 400-byte string holds an anchor chosen by content alone, so two equal strings meet at equal anchors.
Anchors are counted first. Where the whole stretch of bytes that an anchor's strings can cover occurs
twice, all of it is repeated and nothing is left to compare. Otherwise the stretch is one of four cores of
304 bytes plus up to 96 bytes on either side, and occurrences meet per core, told apart by a 128-bit digest
of its bytes. There the suffixes that begin
with the core are sorted, and the core's interval of the Burrows-Wheeler order is extended backward breadth
first, one byte per level: a stable sort by the preceding byte maps every interval to its extensions. With
`a` bytes before the core, neighbours in one interval whose common prefix still covers the other
`96 - a` bytes after it are equal strings; at 400 bytes the extension stops.

A core with more than `CORE_MEMBERS` occurrences is compared through counted hashes of its strings instead
of in one task. Null texts are empty, texts under 400 bytes keep all bytes. Equal rows (id and text) are
separate places of the corpus and all lose what they share. Null ids are keys like others. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.anchors import LENGTH, SPAN, anchors
from ledgerloom.llm.shared import staged, text_or_empty

# Bytes of each core before and after the anchor's start; an anchor's strings have 0 to 384 before it.
CORES = ((288, 16), (192, 112), (96, 208), (0, 304))
SIDE = 96
CORE_MEMBERS = 65_536
_BLOCK = 16_384
_TEXT_BATCH = 256


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


_ANCHOR_ROWS = "doc_id long, row long, place long, size long, anchor long, stretch long, cores array<binary>"


def core_digest(core: bytes, which: int) -> bytes:
    return xxhash.xxh3_128_digest(core, which)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for big in batches:
        for begin in range(0, big.num_rows, _TEXT_BATCH):
            batch = big.slice(begin, _TEXT_BATCH)
            owner, places, sizes, hashes, stretches = [], [], [], [], []
            cores: list[list[bytes | None]] = []
            for i, text in enumerate(batch.column("text")):
                raw = _raw(text.as_py())
                at, h = anchors(raw)
                owner += [i] * len(at)
                sizes += [len(raw)] * len(at)
                places.append(at)
                hashes.append(h)
                for p in at.tolist():
                    low = max(0, p - SPAN)
                    stretches.append(digest(raw[low : p + LENGTH], p - low))
                    cores.append(
                        [
                            # All 128 bits: equal digests stand for equal cores from here on.
                            core_digest(raw[p - left : p + right], which) if left <= p <= len(raw) - right else None
                            for which, (left, right) in enumerate(CORES)
                        ]
                    )
            if owner:
                index = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(index), batch.column("row").take(index),
                        pa.array(np.concatenate(places)), pa.array(sizes, pa.int64()),
                        pa.array(np.concatenate(hashes).view(np.int64)),
                        pa.array(np.array(stretches, dtype=np.uint64).view(np.int64)),
                        pa.array(cores, pa.list_(pa.binary())),
                    ],
                    ["doc_id", "row", "place", "size", "anchor", "stretch", "cores"],
                )


def anchor_rows(keyed: DataFrame) -> DataFrame:
    return keyed.select("doc_id", "row", "text").mapInArrow(_anchor_rows, _ANCHOR_ROWS)


def _low() -> Column:
    return F.greatest(F.col("place") - SPAN, F.lit(0))


def _high() -> Column:
    return F.least(F.col("place") + LENGTH, F.col("size"))


def core_members(hits: DataFrame) -> DataFrame:
    """One row per core and distinct stretch that meets another one there, with the core's member count.

    Stretches that occur twice are already known to be repeated; one of each stays as a witness.
    """
    one = hits.groupBy("anchor", "stretch").agg(
        F.min(F.struct("doc_id", "row", "place", "cores")).alias("at"), F.count("*").alias("n")
    )
    placed = one.select(
        "anchor", (F.col("n") == 1).alias("open"), "at.doc_id", "at.row", "at.place",
        F.posexplode("at.cores").alias("which", "core"),
    ).where("core IS NOT NULL")
    placed = staged(placed.select("doc_id", "row", "place", "which", "core", "open"), "cores")
    met = placed.groupBy("core").agg(F.count("*").alias("members"), F.max("open").alias("any_open"))
    return placed.join(staged(met.where("members > 1 AND any_open").drop("any_open"), "met"), "core")


_SIDES = "core binary, members long, open boolean, doc_id long, row long, first long, lefts binary, rights binary"


def _cut_sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes on either side of each core, the left ones outward from it."""
    for batch in batches:
        rows = []
        for doc_id, row, text, wanted in zip(batch["doc_id"], batch["row"], batch["text"], batch["wanted"], strict=True):
            raw = _raw(text)
            for w in wanted:
                left, right = CORES[w["which"]]
                begin, end = w["place"] - left, w["place"] + right
                rows.append(
                    (
                        w["core"], w["members"], w["open"], doc_id, row, begin,
                        raw[max(0, begin - SIDE) : begin][::-1], raw[end : end + SIDE],
                    )
                )
        yield pd.DataFrame(
            rows, columns=["core", "members", "open", "doc_id", "row", "first", "lefts", "rights"]
        ).astype({"doc_id": "Int64"})


def _matrix(sides: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, sides), dtype=np.int64, count=len(sides))
    padded = b"".join([s.ljust(SIDE, b"\0") for s in sides])
    return np.frombuffer(padded, dtype=np.uint8).reshape(len(sides), SIDE), lengths


def repeated_levels(core: np.ndarray, lefts: list[bytes], rights: list[bytes]) -> np.ndarray:
    """`[member, a]`: whether the string with `a` bytes before the core occurs at another member.

    `order` lists the suffixes that begin with `a` given bytes and the core; `interval` numbers the
    intervals of equal beginnings, within which the order by following bytes is inherited.
    """
    left, left_size = _matrix(lefts)
    right, right_size = _matrix(rights)
    count = len(core)
    found = np.zeros((count, SIDE + 1), dtype=bool)
    order = np.lexsort((right_size, right.view(f"V{SIDE}").ravel().view(f"S{SIDE}"), core))
    # Common prefixes of neighbours after the core; none across cores.
    a, b = order[:-1], order[1:]
    differs = right[a] != right[b]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), SIDE)
    common = np.minimum(common, np.minimum(right_size[a], right_size[b]))
    common[core[a] != core[b]] = -1
    rank = np.empty(count, dtype=np.int64)
    rank[order] = np.arange(count)
    interval = np.concatenate([[0], np.cumsum(core[a] != core[b])]) if count else np.empty(0, np.int64)
    for level in range(SIDE + 1):
        if level:
            alive = left_size[order] >= level
            order, interval = order[alive], interval[alive]
            key = interval * 256 + left[order, level - 1]
            step = np.argsort(key, kind="stable")
            order, key = order[step], key[step]
            interval = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(key) else key
        if len(order) < 2:
            break
        need = SIDE - level
        run = np.concatenate([[0], np.cumsum(common < need)])[rank[order]]
        long_enough = right_size[order] >= need
        same = (interval[1:] == interval[:-1]) & (run[1:] == run[:-1]) & long_enough[1:] & long_enough[:-1]
        found[order[1:][same], level] = True
        found[order[:-1][same], level] = True
    return found


def _stretches(found: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of repeated levels of each member as `(member, low, high)` byte ranges."""
    edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    member, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return member, first[member] - (end - 1), first[member] - begin + LENGTH


_SPANS = "doc_id long, row long, low long, high long"


def _extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole cores at a time; the rows come sorted by core."""

    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        core, _ = pd.factorize(rows["core"])
        found = repeated_levels(core, rows["lefts"].tolist(), rows["rights"].tolist())
        found &= rows["open"].to_numpy(dtype=bool)[:, None]
        member, low, high = _stretches(found, rows["first"].to_numpy())
        return pd.DataFrame(
            {"doc_id": rows["doc_id"].to_numpy()[member], "row": rows["row"].to_numpy()[member], "low": low, "high": high}
        ).astype({"doc_id": "Int64"})

    rest: list[pd.DataFrame] = []
    waiting = 0
    for batch in batches:
        rest.append(batch.astype({"doc_id": "Int64"}))
        waiting += len(batch)
        if waiting < _BLOCK:
            continue
        rows = pd.concat(rest, ignore_index=True)
        core, _ = pd.factorize(rows["core"])
        last = core == core[-1]
        if not last.all():
            yield solved(rows[~last].reset_index(drop=True))
        rest, waiting = [rows[last]], int(last.sum())
    if waiting:
        yield solved(pd.concat(rest, ignore_index=True))


_HASHED = "core binary, level int, hash long, doc_id long, row long, first long, open boolean"


def _hash_levels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of a crowded core's members as a hash of the bytes around the core."""
    for whole in batches:
        for begin in range(0, len(whole), 1_000):
            rows = []
            part = whole.iloc[begin : begin + 1_000]
            for r in part.itertuples(index=False):
                for a in range(SIDE + 1):
                    if len(r.lefts) >= a and len(r.rights) >= SIDE - a:
                        h = xxhash.xxh3_64_intdigest(r.lefts[:a][::-1] + r.rights[: SIDE - a], a)
                        rows.append((r.core, a, h - 2**64 if h >= 2**63 else h, r.doc_id, r.row, r.first, r.open))
            yield pd.DataFrame(
                rows, columns=["core", "level", "hash", "doc_id", "row", "first", "open"]
            ).astype({"doc_id": "Int64"})


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """Byte ranges of `(doc_id, row)` texts that repeated strings cover; ranges of one text may overlap."""
    narrow = anchor_rows(keyed).select("anchor", "stretch")
    # Written tables on the counted side: both sides of the joins are then plain shuffles that AQE can split.
    kinds = staged(narrow.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "kinds")
    hits = staged(anchor_rows(keyed).join(kinds, "anchor"), "anchors")
    twice = hits.groupBy("anchor", "stretch").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "stretch")
    whole = hits.join(staged(twice, "stretches"), ["anchor", "stretch"], "left_semi").select(
        "doc_id", "row", _low().alias("low"), _high().alias("high")
    )
    members = core_members(hits)
    wanted = members.groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("core", "members", "open", "which", "place")).alias("wanted")
    )
    texts = keyed.select("doc_id", "row", "text")
    # Equal rows have only stretches that occur twice, so one of them is enough here.
    joined = texts.join(
        wanted.withColumnsRenamed({"doc_id": "_id", "row": "_row"}),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")),
    )
    sides = staged(
        joined.select("doc_id", "row", "text", "wanted").mapInPandas(_cut_sides, _SIDES), "sides"
    )
    small = sides.where(F.col("members") <= CORE_MEMBERS).repartition("core").sortWithinPartitions("core")
    found = small.mapInPandas(_extend, _SPANS)
    crowded = sides.where(F.col("members") > CORE_MEMBERS).mapInPandas(_hash_levels, _HASHED)
    equal = crowded.groupBy("core", "level", "hash").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    counted = (
        crowded.join(equal, ["core", "level", "hash"], "left_semi").where("open")
        .select("doc_id", "row", (F.col("first") - F.col("level")).alias("low"))
        .select("*", (F.col("low") + LENGTH).alias("high"))
    )
    return whole.unionByName(found).unionByName(counted)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, lows, highs in zip(batch["doc_id"], batch["text"], batch["lows"], batch["highs"], strict=True):
            raw = _raw(text)
            spans = merged(list(zip(lows, highs, strict=True))) if lows is not None else []
            kept, at = [], 0
            for low, high in spans:
                kept.append(raw[at:low])
                at = high
            kept.append(raw[at:])
            cut = sum(high - low for low, high in spans)
            rows.append((doc_id, len(raw), cut, len(spans), hashlib.sha256(b"".join(kept)).hexdigest()))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype(
            {"doc_id": "Int64"}
        )


def without_repeats(documents: DataFrame) -> DataFrame:
    keyed = documents.select("doc_id", text_or_empty().alias("text")).withColumn("row", F.xxhash64("text"))
    ranges = repeated_spans(keyed).groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges")
    )
    ranges = ranges.select(
        F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("ranges.low").alias("lows"),
        F.col("ranges.high").alias("highs"),
    )
    joined = keyed.join(ranges, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    return joined.select("doc_id", "text", "lows", "highs").mapInPandas(_removed, _RESULT)
