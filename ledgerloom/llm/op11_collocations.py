"""Phrase collocation mining with counting quotient filters.

Texts are dictionary-coded in blocks. Words that occur often enough for any phrase get a number; the word
numbers of a phrase are packed into one number of two halves, which an invertible permutation (a Feistel
network) scatters evenly. Its upper bits are the quotient, the rest is the remainder, kept in full, so a
filter is a lossless, sorted and compact table of counters: a quotient is not stored but implied by how many
remainders stand in its run. Every block fills filters, cut into slabs by quotient; the slabs of all
blocks are merged, sorted list into sorted list, and the counts of frequent phrases are read back by
undoing the permutation.

Phrases grow word by word. A phrase can only be frequent if both its shorter ends are, so each merge tells
every block which of its phrases were frequent, and a block counts a longer one only where two of those
overlap. What a block is told is no more than what it sent, so nothing that grows with the corpus is
broadcast. The permutation spreads phrases over slabs whatever their language or frequency; a phrase is one
counter a block, however often it occurs.

Null texts are empty, null languages `und`. Empty texts and tables give nothing; a block holds whole
documents, so it exceeds `BLOCK_TOKENS` by one document at most. Repeated rows count each time. Columns other
than `lang` and `text` are ignored.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged

LONGEST = 4
BLOCK_TOKENS = 1 << 19
# Words of a block that one row carries.
ROW_WORDS = 4096
# Words of the corpus per slab: a bound on the counters of a slab, but for one counter a block of each phrase.
SLAB_TOKENS = 1 << 20
_U64 = np.uint64
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PLAIN = bytes.maketrans(_CAPITALS + b".,;:!?\x0b\x0c\r\t", _CAPITALS.lower() + b"\n" * 9 + b" ")
_BREAK = b"\n"
PHRASE = [f"w{i + 1}" for i in range(LONGEST)]


# --- coding ---------------------------------------------------------------------------------------


class _Block:
    """Word numbers of some documents, 0 between pieces, and the words in order of their first use."""

    def __init__(self) -> None:
        self.langs: list[str] = []
        self.words: list[str] = []
        self.tokens = array("I")
        self._of_lang: dict[str, _Numbers] = {}

    def add(self, lang: str, text: str) -> None:
        numbers = self._of_lang.get(lang)
        if numbers is None:
            numbers = self._of_lang[lang] = _Numbers(self, lang)
        plain = text.encode("utf-8", "surrogatepass").translate(_PLAIN).replace(_BREAK, b" \n ")
        self.tokens.extend([numbers[w] for w in plain.split(b" ") if w])
        self.tokens.append(0)

    def rows(self) -> Iterator[pd.DataFrame]:
        """The words in some rows, numbered from `first`, and the tokens in one more."""
        name = uuid.uuid4().hex
        tokens = np.array(self.tokens, dtype="<u4")
        counts = np.bincount(tokens, minlength=len(self.words) + 1)[1:]
        for i in range(0, len(self.words), ROW_WORDS):
            part = slice(i, i + ROW_WORDS)
            yield self._row(name, i + 1, self.langs[part], self.words[part], counts[part], None)
        yield self._row(name, 0, [], [], [], tokens.tobytes())

    @staticmethod
    def _row(block: str, first: int, langs, words, counts, tokens: bytes | None) -> pd.DataFrame:
        columns = {"block": block, "first": first, "langs": langs, "words": words, "counts": counts, "tokens": tokens}
        return pd.DataFrame({name: [value] for name, value in columns.items()})


class _Numbers(dict):
    def __init__(self, block: _Block, lang: str) -> None:
        super().__init__({_BREAK: 0})
        self._block, self._lang = block, lang

    def __missing__(self, word: bytes) -> int:
        self._block.langs.append(self._lang)
        self._block.words.append(word.decode("utf-8", "surrogatepass"))
        self[word] = number = len(self._block.words)
        return number


def coded_blocks(documents: DataFrame) -> DataFrame:
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = _Block()
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                block.add(lang, text)
                if len(block.tokens) >= BLOCK_TOKENS:
                    yield from block.rows()
                    block = _Block()
        if block.words:
            yield from block.rows()

    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text")).where("length(text) > 0")
    schema = "block string, first long, langs array<string>, words array<string>, counts array<long>, tokens binary"
    return texts.mapInPandas(code, schema)


def numbered(words: DataFrame) -> DataFrame:
    """Adds `id`, from 1 and nearly dense; the rows are written, so the numbers hold."""
    rows = staged(words.withColumn("_at", F.monotonically_increasing_id()), "vocabulary")
    parts = (rows.agg(F.max(F.shiftright("_at", 33))).first()[0] or 0) + 1
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("id", within * parts + F.shiftright("_at", 33) + 1).drop("_at")


def renumbered(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """`(block, tokens)` in the numbers of the vocabulary; 0 for breaks and words outside it."""
    words = blocks.where("first > 0").select("block", "first", F.posexplode(F.arrays_zip("langs", "words")))
    used = words.select(
        "block", (F.col("first") + F.col("pos")).alias("number"), F.col("col.langs").alias("lang"), F.col("col.words").alias("word")
    )
    pair = F.shiftleft("number", 32) + F.col("id")
    known = used.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    tables = known.groupBy("block").agg(F.collect_list(pair).alias("pairs"))

    def recode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tokens, pairs in zip(batch["tokens"], batch["pairs"], strict=True):
                old = np.frombuffer(tokens, dtype="<u4")
                pairs = np.asarray(pairs, dtype=np.int64)
                table = np.zeros(int(old.max()) + 1, dtype="<u4")
                table[pairs >> 32] = (pairs & 0xFFFFFFFF).astype("<u4")
                new = table[old]
                # A word without a neighbour is in no phrase; one break stands for many.
                left, right = np.concatenate([[0], new[:-1]]), np.concatenate([new[1:], [0]])
                out.append(new[(left > 0) | ((new > 0) & (right > 0))].tobytes())
            yield pd.DataFrame({"block": batch["block"], "tokens": out})

    joined = blocks.where("first = 0").select("block", "tokens").join(tables, "block")
    return joined.mapInPandas(recode, "block string, tokens binary")


# --- counting quotient filters --------------------------------------------------------------------


def _scattered(x: np.ndarray, turn: int, half: int) -> np.ndarray:
    x = (x + _U64(2 * turn + 1)) * _U64(0x9FB21C651E98DF25)
    x ^= x >> _U64(32)
    x *= _U64(0xD6E8FEB86659FD93)
    return x >> _U64(64 - half)


def permuted(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of the pairs of `half`-bit numbers."""
    for turn in range(4):
        hi, lo = lo, hi ^ _scattered(lo, turn, half)
    return hi, lo


def unpermuted(hi: np.ndarray, lo: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for turn in reversed(range(4)):
        hi, lo = lo ^ _scattered(hi, turn, half), hi
    return hi, lo


def half_bits(n: int, word_bits: int) -> int:
    return word_bits if n == 2 else 2 * word_bits


def packed(words: list[np.ndarray], word_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of phrases of two words, or of three or four."""
    if len(words) == 2:
        return words[0], words[1]
    w = _U64(word_bits)
    last = words[3] if len(words) > 3 else _U64(0)
    return words[0] << w | words[1], words[2] << w | last


def unpacked(hi: np.ndarray, lo: np.ndarray, n: int, word_bits: int) -> list[np.ndarray]:
    if n == 2:
        return [hi, lo]
    w, low = _U64(word_bits), _U64((1 << word_bits) - 1)
    return [hi >> w, hi & low, lo >> w, lo & low][:n]


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width, end = data[at], at + 1 + data[at] * n
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8, count=width * n, offset=at + 1).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(_U64), end


def filter_bytes(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, half: int, slab_bits: int) -> bytes:
    """The filter of sorted distinct permuted keys of one slab: run lengths, remainders, counters."""
    more = min(half - slab_bits, max(0, len(hi).bit_length() - 1))
    rest = half - slab_bits - more
    quotient = (hi >> _U64(rest)) & _U64((1 << more) - 1)
    runs = np.bincount(quotient.astype(np.int64), minlength=1 << more)
    remainder = hi & _U64((1 << rest) - 1)
    return struct.pack("<BQ", more, len(hi)) + b"".join(map(_narrow, (runs, remainder, lo, counts)))


def filter_entries(data: bytes, slab: int, half: int, slab_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted permuted keys of a filter, as two halves, with their counts."""
    more, n = struct.unpack_from("<BQ", data)
    runs, at = _wide(data, struct.calcsize("<BQ"), 1 << more)
    remainder, at = _wide(data, at, n)
    lo, at = _wide(data, at, n)
    counts, _ = _wide(data, at, n)
    quotient = np.repeat(np.arange(1 << more, dtype=_U64), runs.astype(np.int64)) | _U64(slab << more)
    return quotient << _U64(half - slab_bits - more) | remainder, lo, counts


def grouped(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorting order of keys, and where in it each distinct key begins."""
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    new = np.ones(len(hi), dtype=bool)
    new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    return order, np.flatnonzero(new)


def _among(hi: np.ndarray, lo: np.ndarray, known_hi: np.ndarray, known_lo: np.ndarray) -> np.ndarray:
    order, first = grouped(np.concatenate([known_hi, hi]), np.concatenate([known_lo, lo]))
    known = np.logical_or.reduceat(order < len(known_hi), first) if len(order) else np.empty(0, bool)
    out = np.empty(len(order), dtype=bool)
    out[order] = np.repeat(known, np.diff(np.append(first, len(order))))
    return out[len(known_hi) :]


def _windows(tokens: np.ndarray, n: int) -> list[np.ndarray]:
    return [tokens[j : len(tokens) - n + 1 + j] for j in range(n)]


def block_keys(tokens: np.ndarray, n: int, word_bits: int, frequent: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Permuted keys of the phrases of `n` words; with `frequent`, of those whose two ends are among it."""
    if len(tokens) < n:
        return np.empty(0, _U64), np.empty(0, _U64)
    words = _windows(tokens, n)
    valid = np.logical_and.reduce([w > 0 for w in words])
    if frequent is not None:
        shorter = _windows(tokens, n - 1)
        whole = np.flatnonzero(np.logical_and.reduce([w > 0 for w in shorter]))
        half = half_bits(n - 1, word_bits)
        keys = permuted(*packed([w[whole] for w in shorter], word_bits), half)
        known = [np.frombuffer(k, dtype="<u8").reshape(2, -1) for k in frequent] or [np.empty((2, 0), _U64)]
        kept = np.zeros(len(shorter[0]), dtype=bool)
        kept[whole] = _among(*keys, *np.concatenate(known, axis=1).astype(_U64))
        valid &= kept[:-1] & kept[1:]
    return permuted(*packed([w[valid] for w in words], word_bits), half_bits(n, word_bits))


def block_filters(blocks: DataFrame, n: int, word_bits: int, slab_bits: int) -> DataFrame:
    """`(slab, block, filter)`: the phrase counts of each block. `blocks` may carry `frequent` key lists."""
    half = half_bits(n, word_bits)
    slab_bits = min(slab_bits, half)
    schema = "slab long, block string, filter binary"

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = batch["frequent"] if "frequent" in batch else [None] * len(batch)
            for block, data, frequent in zip(batch["block"], batch["tokens"], told, strict=True):
                tokens = np.frombuffer(data, dtype="<u4").astype(_U64)
                hi, lo = block_keys(tokens, n, word_bits, frequent)
                order, first = grouped(hi, lo)
                counts = np.diff(np.append(first, len(order)))
                hi, lo = hi[order][first], lo[order][first]
                slabs = (hi >> _U64(half - slab_bits)).astype(np.int64)
                starts = np.flatnonzero(np.diff(slabs, prepend=-1))
                ends = np.append(starts[1:], len(hi))
                rows = [
                    (int(slabs[a]), block, filter_bytes(hi[a:b], lo[a:b], counts[a:b], half, slab_bits))
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=False)
                    if b > a
                ]
                if rows:
                    yield pd.DataFrame(rows, columns=["slab", "block", "filter"])

    return blocks.mapInPandas(fill, schema)


def merged_filters(filters: DataFrame, n: int, word_bits: int, slab_bits: int, least: int) -> DataFrame:
    """Slabs merged over all blocks.

    Rows without a block hold frequent phrases: permuted keys and counts. Rows with a block hold the keys
    of that block that are frequent in the corpus.
    """
    half = half_bits(n, word_bits)
    slab_bits = min(slab_bits, half)

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [filter_entries(f, int(s), half, slab_bits) for s, f in zip(rows["slab"], rows["filter"], strict=True)]
        hi, lo, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        order, first = grouped(hi, lo)
        total = np.add.reduceat(counts[order], first)
        often = total >= least
        flags = np.empty(len(order), dtype=bool)
        flags[order] = np.repeat(often, np.diff(np.append(first, len(order))))
        out = []
        if often.any():
            at = order[first[often]]
            out.append((None, np.stack([hi[at], lo[at]]).astype("<u8").tobytes(), total[often].astype("<u8").tobytes()))
        ends = np.cumsum([len(p[0]) for p in parts])
        for block, a, b in zip(rows["block"], np.concatenate([[0], ends[:-1]]), ends, strict=True):
            kept = np.flatnonzero(flags[a:b]) + a
            if len(kept) and n < LONGEST:
                out.append((block, np.stack([hi[kept], lo[kept]]).astype("<u8").tobytes(), None))
        return pd.DataFrame(out, columns=["block", "keys", "counts"])

    return filters.groupBy("slab").applyInPandas(merge, "block string, keys binary, counts binary")


def frequent_phrases(merged: DataFrame, n: int, word_bits: int) -> DataFrame:
    """`(w1 ... w4, f)` from the merged slabs; 0 stands after the last word."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                hi, lo = np.frombuffer(keys, dtype="<u8").reshape(2, -1).astype(_U64)
                words = unpacked(*unpermuted(hi, lo, half_bits(n, word_bits)), n, word_bits)
                words += [np.zeros(len(hi), _U64)] * (LONGEST - n)
                columns = {name: w.astype(np.int64) for name, w in zip(PHRASE, words, strict=True)}
                yield pd.DataFrame(columns | {"f": np.frombuffer(counts, dtype="<u8").astype(np.int64)})

    schema = ", ".join(f"{c} long" for c in [*PHRASE, "f"])
    return merged.where("block IS NULL").select("keys", "counts").mapInPandas(read, schema)


def phrase_counts(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words `(lang, word, f, id)`, frequent phrases of up to four words, and words per language."""
    blocks = staged(coded_blocks(documents), "blocks")
    zipped = F.explode(F.arrays_zip("langs", "words", "counts")).alias("e")
    words = blocks.where("first > 0").select(zipped).groupBy(F.col("e.langs").alias("lang"), F.col("e.words").alias("word"))
    words = staged(words.agg(F.sum("e.counts").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = numbered(words.where(F.col("f") >= least))
    size = vocabulary.agg(F.max("id")).first()[0] or 1
    word_bits = int(size).bit_length()
    if word_bits > 32:
        raise ValueError(f"more than {1 << 32} frequent words; pack phrases into wider numbers")
    slab_bits = int((totals.agg(F.sum("n")).first()[0] or 0) // SLAB_TOKENS).bit_length()
    coded = staged(renumbered(blocks, vocabulary), "coded")
    found = vocabulary.select(F.col("id").alias(PHRASE[0]), *[F.lit(0).cast("long").alias(c) for c in PHRASE[1:]], "f")
    told = coded
    for n in range(2, LONGEST + 1):
        filters = staged(block_filters(told, n, word_bits, slab_bits), "filters")
        merged = staged(merged_filters(filters, n, word_bits, slab_bits, least), "merged")
        found = found.unionByName(frequent_phrases(merged, n, word_bits))
        heard = merged.where("block IS NOT NULL").groupBy("block").agg(F.collect_list("keys").alias("frequent"))
        told = coded.join(heard, "block")
    return vocabulary, staged(found, "frequent"), totals


# --- scores ---------------------------------------------------------------------------------------


def _size() -> Column:
    return sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in PHRASE), F.lit(0))


def _part(start: int, n: int, names: str) -> list[Column]:
    """`n` words from `start`, as a phrase of its own."""
    return [(F.col(PHRASE[start + i]) if i < n else F.lit(0).cast("long")).alias(f"{names}{i + 1}") for i in range(LONGEST)]


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with `a` and the cut that scores lowest: `score`, `l`, `r`."""
    sized = phrases.withColumn("size", _size()).where("size > 1")
    # The rest of a cut is padded with zeros by taking what lies beyond the phrase.
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), *_part(0, k, "l"), *_part(k, LONGEST - k, "r")) for k in range(1, LONGEST)])
    each = sized.withColumn("cut", F.explode(cuts)).where("cut.k < size").select(*PHRASE, F.col("f").alias("a"), "cut.*")
    for side in "lr":
        counted = phrases.select(*[F.col(c).alias(f"{side}{i + 1}") for i, c in enumerate(PHRASE)], F.col("f").alias(side))
        each = each.join(counted, [f"{side}{i + 1}" for i in range(LONGEST)])
    score = F.expr("cast(2000000 AS decimal(7, 0)) * cast(a AS decimal(20, 0)) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst")
    return each.groupBy(*PHRASE, "a").agg(worst).select(*PHRASE, "a", "worst.score", "worst.l", "worst.r")


def longest_shares(phrases: DataFrame) -> DataFrame:
    """For each phrase inside a longer frequent one: the largest count of such."""
    inside = [(start, n) for n in range(2, LONGEST) for start in range(LONGEST - n + 1)]
    parts = F.array(*[F.struct(F.lit(s + n).alias("end"), F.lit(n).alias("n"), *_part(s, n, "w")) for s, n in inside])
    sized = phrases.withColumn("size", _size()).where("size > 2").select("size", "f", F.explode(parts).alias("p"))
    return sized.where("p.end <= size AND p.n < size").groupBy(*[F.col(f"p.{c}") for c in PHRASE]).agg(F.max("f").alias("longer"))


def collocations(documents: DataFrame, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """The `top` phrases of each language: `lang, rank, phrase, a, l, r, n, score`."""
    vocabulary, phrases, totals = phrase_counts(documents, least)
    own = scored(phrases).join(longest_shares(phrases), PHRASE, "left")
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    own = own.where(F.col("longer").isNull() | (100 * wide("longer") < share * wide("a"))).drop("longer")
    names = vocabulary.select("id", "lang", "word")
    own = own.join(names.select(F.col("id").alias(PHRASE[0]), "lang", F.col("word").alias("t1")), PHRASE[0])
    # Ties are settled by the phrase, so only what can still be among the first is spelled out.
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    own = own.withColumn("place", F.rank().over(best)).where(F.col("place") <= top)
    for i, c in enumerate(PHRASE[1:], start=2):
        own = own.join(names.select(F.col("id").alias(c), F.col("word").alias(f"t{i}")), c, "left")
    own = own.withColumn("phrase", F.concat_ws(" ", *[f"t{i + 1}" for i in range(LONGEST)]))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = own.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


ORACLE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0),
grams AS (SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM places CROSS JOIN range(1, 5) r(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k AS size, phrase, concat(lang, chr(10), phrase) AS name, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
parts AS (
    SELECT lang, phrase, a, k, concat(lang, chr(10), array_to_string(w[1 : k], ' ')) AS head,
           concat(lang, chr(10), array_to_string(w[k + 1 :], ' ')) AS tail
    FROM candidates CROSS JOIN range(1, 4) t(k) WHERE k < size
), cuts AS (
    SELECT p.lang, p.phrase, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
    FROM parts p JOIN f l ON l.name = head JOIN f r ON r.name = tail
), worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, a, array_to_string(w[s : s + n - 1], ' ') AS phrase
    FROM candidates CROSS JOIN range(1, 5) t(s) CROSS JOIN range(2, 4) u(n) WHERE n < size AND s + n - 1 <= size
), longer AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY ALL),
kept AS (SELECT w.* FROM worst w LEFT JOIN longer g USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
