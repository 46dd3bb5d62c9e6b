"""SimHash groups, repeated substrings and neighbours against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import anchors, components, op6_neighbours, op8_simhash, op10_substrings, op12_circulant


def plain_simhash(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", lower)
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 3]).encode(), seed=42) for i in range(max(1, len(ws) - 2))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_groups(prints):
    """Smallest id reachable over links of at most two bits, by id."""
    ids = sorted(prints)
    home = {i: i for i in ids}

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                home[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("members", [1_024, 1])
def test_simhash_groups(small, monkeypatch, members):
    monkeypatch.setattr(op8_simhash, "CELL_MEMBERS", members)
    texts = {r["doc_id"]: r["text"] for r in small.select("doc_id", "text").collect()}
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    home = plain_groups(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op8_simhash.near_duplicates(small).collect()}
    assert got == {i: (f"{prints[i]:016x}", home[i]) for i in texts}


def test_links_find_every_pair_within_two_bits(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base:
        for flips in (1, 2, 3, 4):
            value = b
            for bit in rng.sample(range(64), flips):
                value ^= 1 << bit
            values.add(value)
    values |= {0, 1, 3, 7, 2**64 - 1, 2**63}
    signed = {v - 2**64 if v >= 2**63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in signed], "fp long").select("fp", F.col("fp").alias("doc_id"))
    roots = {r["fp"]: r["root"] for r in op8_simhash.groups(df).collect()}
    home = plain_groups({v: v % 2**64 for v in signed})
    assert Counter(Counter(roots.values()).values()) == Counter(Counter(home.values()).values())
    assert {(a, b) for a in signed for b in signed if roots[a] == roots[b]} == {
        (a, b) for a in signed for b in signed if home[a] == home[b]
    }


def test_components_of_a_long_path(spark):
    path = spark.range(0, 200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    got = {r["u"]: r["v"] for r in components.connected_components(path).collect()}
    assert got == {i: 0 for i in range(1, 201)}


def test_simhash_of_odd_and_empty_tables(odd, empty):
    got = op8_simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {4}
    assert op8_simhash.near_duplicates(empty).count() == 0
    kept = op8_simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id IN (1, 2, 8)").collect()) == sorted(
        {(r["doc_id"], r["text"]) for r in odd.where("doc_id IN (1, 8)").collect()}
    )
    assert kept.where("doc_id IS NULL").count() == 1
    assert op8_simhash.one_of_each_group(empty).count() == 0


def plain_similar_kept(texts):
    """Smallest id of every component of texts whose five-word shingles have a Jaccard similarity of 0.8."""
    sets = {}
    for i, t in texts.items():
        ws = (t or "").lower().split()
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    home = {i: i for i in texts}

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for a in sorted(sets):
        for b in sets:
            if a < b:
                shared, both = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                if 5 * shared >= 4 * both:
                    x, y = root(a), root(b)
                    home[max(x, y)] = min(x, y)
    return {i for i in texts if root(i) == i}


def test_pipeline_near_dedup_finds_every_similar_pair(spark, small):
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    texts = {r["doc_id"]: r["text"] for r in small.select("doc_id", "text").collect()}
    rng = random.Random(2)
    base = [f"w{rng.randrange(5_000)}" for _ in range(104)]
    for k in range(60):
        words = [*base, *(f"t{k}x{i}" for i in range(rng.choice([0, 8, 24, 25, 26, 40])))]
        words[rng.randrange(104)] = f"e{k}"
        texts[1_000_000 + k] = " ".join(words)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = [r["doc_id"] for r in stage(spark, table, "").collect()]
    assert sorted(got) == sorted(plain_similar_kept(texts))


def plain_repeats(rows):
    seen = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        seen.update(raw[s : s + 400] for s in range(len(raw) - 399))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for s in range(len(raw) - 399):
            if seen[raw[s : s + 400]] > 1:
                gone[s : s + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def crafted():
    rng = random.Random(5)
    text = lambda n, letters="abcdefgh ": "".join(rng.choice(letters) for _ in range(n))
    shared = [text(400), text(399), text(401), text(900), "x" * 1_500, "ab" * 500, text(1_200, "ab")]
    rows = []
    for k in range(24):
        parts = [text(rng.choice([0, 1, 5, 50, 300])) + rng.choice(shared)[rng.choice([0, 0, 0, 1, 7, 100]) :] for _ in range(2)]
        rows.append((k, "".join(parts)[rng.choice([0, 0, 3]) :]))
    rows += [(100, "y" * 399), (101, "y" * 400), (102, ""), (103, None), (104, rows[5][1]), (5, rows[5][1])]
    return rows + [(None, "é" * 350), (7, rows[7][1])]


@pytest.mark.parametrize("members", [65_536, 2])
def test_repeated_strings_of_crafted_texts(spark, monkeypatch, members):
    monkeypatch.setattr(op10_substrings, "CORE_MEMBERS", members)
    rows = crafted()
    got = op10_substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == plain_repeats(rows)


def test_cores_with_equal_short_digests_are_not_equal_strings(spark):
    """A passage under 400 bytes behind contexts whose cores agree in the top 31 bits of a 64-bit digest."""
    rng = random.Random(11)
    pool = "".join(rng.choice("abcdefghijklmnop") for _ in range(400_000))
    at = int(np.argmin(anchors.gram_hashes(pool.encode())))
    passage = (pool + pool)[at : at + 150]
    before, rows = {}, []
    for k in range(400_000):
        context = hashlib.shake_128(str(k).encode()).hexdigest(150)
        short = xxhash.xxh3_64_intdigest((context[-288:] + passage[:16]).encode()) >> 33
        if short in before:
            rows += [(len(rows), before[short] + passage), (len(rows) + 1, context + passage)]
        before[short] = context
    assert len(rows) >= 10
    got = op10_substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_removed"] == 0 for r in got)
    assert sorted(map(tuple, got), key=str) == plain_repeats(rows)


def test_repeated_strings_of_real_odd_and_empty_tables(small, odd, empty):
    for table in (small, odd.where("doc_id IS DISTINCT FROM 7")):
        rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
        got = op10_substrings.without_repeats(table).collect()
        assert sorted(map(tuple, got), key=str) == plain_repeats(rows)
    assert op10_substrings.without_repeats(odd).count() == odd.count()
    assert op10_substrings.without_repeats(empty).count() == 0


def test_neighbour_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], dtype=float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in op6_neighbours.nearest(table).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    queries = [k for k in range(len(ids)) if ids[k] % 50 == 0]
    assert sorted(got) == sorted(ids[queries].tolist())
    for k in queries:
        cosine = unit @ unit[k]
        cosine[k] = -9
        best = set(ids[np.argsort(-cosine)[:5]].tolist())
        found = sorted(got[ids[k]])
        assert [rank for rank, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine[np.flatnonzero(ids == v)[0]]) < 1e-12 for _, v, s in found)
        hits += len(best & {v for _, v, _ in found})
    assert hits / (5 * len(queries)) >= 0.9


def test_neighbours_of_one_id_with_different_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [0.0, 1.0]), (7, [1.0, 0.1]), (7, [1.0, 0.1])]
    got = op6_neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2).collect()
    lists = sorted((r["rank"], r["vec_id"], round(r["score"], 6)) for r in got if r["query_id"] == 0)
    near = round(1 / np.sqrt(1.01), 6)
    # The query (1, 0) finds 7's second vector and its own id's other one, or 7's first, both at a right angle.
    assert lists == [(1, 7, near), (1, 7, 1.0), (2, 0, 0.0), (2, 7, round(0.1 / np.sqrt(1.01), 6))]


def test_neighbours_of_odd_vectors(spark):
    v = lambda *x: [float(c) if c is not None else None for c in x]
    rows = [
        (0, v(1, 0)), (1, v(1, 0)), (2, v(2, 0)), (3, v(0, 0)), (4, None), (5, v(1, None)), (6, v(float("nan"), 1)),
        (7, v(float("inf"), 1)), (8, v(0, 1)), (50, v(-1, 0)), (50, v(-1, 0)), (None, v(1, 1)), (100, v(1, 2, 3)),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = op6_neighbours.nearest(table).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [
        (0, 1), (0, 2), (0, 8), (0, 50), (50, 8), (50, 0), (50, 1), (50, 2),
    ]
    assert op6_neighbours.nearest(table.limit(0)).count() == 0


def test_the_last_pairs_are_only_those_that_small_sets_allow(spark):
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 700, dtype=np.uint64)
    # Against the first set: 0.74 and 0.77 (under the bound), 0.80 and 0.9 (links).
    sets = [pool[:148], *(np.concatenate([pool[:k], pool[300 + 100 * i : 300 + 100 * i + extra]])
                          for i, (k, extra) in enumerate([(126, 22), (129, 20), (132, 17), (140, 8)]))]
    sets = [np.unique(s) for s in sets]
    long_bits = op12_circulant.four_bits(op12_circulant.signatures(sets, op12_circulant.LONG_COORDINATES))
    rows = [
        (i, 7, len(s), i, long_bits[i].tolist(), op12_circulant.folded_shingles(s).tolist(), [7], []) for i, s in enumerate(sets)
    ]
    schema = (
        "set_id long, key long, n_shingles long, root long, long_bits array<long>, folded array<smallint>, bands array<long>, "
        f"pivots {op12_circulant.PIVOTS}"
    )
    exact = {
        (i, j) for i in range(5) for j in range(i + 1, 5)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    found = op12_circulant._remaining(spark.createDataFrame(rows, schema), (80, 100))
    assert {tuple(r) for r in found.collect()} == exact and (0, 4) in exact and (0, 1) not in exact
    # Sets that are not folded go by the signature, which lets the near misses through and no link out.
    unfolded = spark.createDataFrame([(*r[:5], None, *r[6:]) for r in rows], schema)
    assert exact < {tuple(r) for r in op12_circulant._remaining(unfolded, (80, 100)).collect()}


def test_the_last_pairs_of_a_band_cut_into_blocks(spark, monkeypatch):
    """Folded sets give exactly the links, in blocks or not; larger ones, by their signature, lose none."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 900, dtype=np.uint64)
    sets = []
    for size in (90, 118, 130, 600, 800):
        for _ in range(12):
            own = rng.integers(0, 2**63, int(rng.integers(0, size // 6)), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([rng.permutation(base[:size])[: size - len(own)], own])))
    long_bits = op12_circulant.four_bits(op12_circulant.signatures(sets, op12_circulant.LONG_COORDINATES))
    schema = (
        "set_id long, key long, n_shingles long, root long, long_bits array<long>, folded array<smallint>, bands array<long>, "
        f"pivots {op12_circulant.PIVOTS}"
    )

    def found(largest):
        rows = [
            (i, key, len(s), i // 2, bits.tolist() if len(s) * 100 > largest * 80 else None,
             op12_circulant.folded_shingles(s).tolist() if len(s) <= largest else None, [7, 8], None)
            for i, (s, bits) in enumerate(zip(sets, long_bits, strict=True)) for key in (7, 8)
        ]
        return {tuple(r) for r in op12_circulant._remaining(spark.createDataFrame(rows, schema), (80, 100)).collect()}

    exact = {
        (i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if i // 2 != j // 2
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    }
    assert len(exact) > 50
    by_folding, by_signature = found(4_096), found(120)
    assert exact <= by_folding and len(by_folding) <= 1.2 * len(exact) and exact <= by_signature
    monkeypatch.setattr(op12_circulant, "BLOCK", 5)
    assert found(4_096) == by_folding and found(120) == by_signature


def test_tables_of_blank_texts_only(spark):
    table = spark.createDataFrame([(1, " "), (2, ""), (3, None)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in op12_circulant.near_duplicates(table).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_a_round_of_components_shuffles_its_links_three_times(spark):
    links = spark.range(0, 100).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    plan = components._small_star(components._large_star(links)).distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "Join" not in plan
