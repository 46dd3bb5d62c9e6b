"""Phrase mining, circulant MinHash and the filter audit against plain versions and their SQL."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op11_collocations, op12_circulant, op13_audit, queries

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ------------------------------------------------------------------ SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect(config={"max_temp_directory_size": "2GB"})
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert ours == sorted(want.select(*[f'"{c}"' for c in columns]).fetchall()) and ours


# ------------------------------------------------------------------ phrases


def plain_collocations(rows, least, share, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for n in range(1, 5):
                counts[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, f in counts.items():
        ranked = []
        frequent = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        for g, a in frequent.items():
            cuts = [(2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))]
            inside = [
                b for h, b in frequent.items()
                if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            ]
            if not any(100 * b >= share * a for b in inside):
                score, _, l, r = min(cuts)
                ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


PHRASE_SCHEMA = "doc_id long, text string, lang string, source string"


def phrase_rows():
    rng = random.Random(7)
    vocabulary = ["new", "york", "city", "Hall", "x", "été", "日本", "a", "the", "of"]
    out = []
    for k in range(120):
        ws = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        out.append((k, "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ", "]) for w in ws), rng.choice(["en", None, "", "und"]), "s"))
    return [*out, (1, None, "en", None), (2, "", None, None), (3, "...!", "zz", None), (3, "...!", "zz", None), (None, "new york " * 3_000, "en", "s")]


@pytest.mark.parametrize(("block", "slab"), [(1 << 19, 1 << 20), (50, 64)])
def test_phrases_of_crafted_texts(spark, monkeypatch, block, slab):
    monkeypatch.setattr(op11_collocations, "BLOCK_TOKENS", block)
    monkeypatch.setattr(op11_collocations, "SLAB_TOKENS", slab)
    rows = phrase_rows()
    table = spark.createDataFrame(rows, PHRASE_SCHEMA).repartition(3)
    for least, share, top in ((3, 80, 2000), (2, 50, 5)):
        got = op11_collocations.collocations(table, least, share, top).collect()
        assert sorted(map(tuple, got)) == plain_collocations([(r[2], r[1]) for r in rows], least, share, top)


def test_phrases_of_odd_and_empty_tables(odd, empty):
    rows = [(r["lang"], r["text"]) for r in odd.collect()]
    got = op11_collocations.collocations(odd, 30).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 30, 80, 2000)
    assert op11_collocations.collocations(empty).count() == 0


@pytest.mark.parametrize(("half", "slab_bits"), [(1, 0), (5, 3), (17, 7), (34, 0), (64, 12)])
def test_filters_lose_nothing(half, slab_bits):
    rng = np.random.default_rng(half)
    top = (1 << half) - 1
    hi = np.array([int(x) & top for x in rng.integers(0, 1 << 63, 500)], dtype=np.uint64)
    lo = np.array([int(x) & top for x in rng.integers(0, 1 << 63, 500)], dtype=np.uint64)
    keys = op11_collocations.permuted(hi, lo, half)
    back = op11_collocations.unpermuted(*keys, half)
    assert (back[0] == hi).all() and (back[1] == lo).all()
    order, first = op11_collocations.grouped(*keys)
    counts = np.diff(np.append(first, len(order))).astype(np.uint64) * np.uint64(300)
    distinct = [k[order][first] for k in keys]
    slabs = distinct[0] >> np.uint64(half - slab_bits)
    read = []
    for slab in np.unique(slabs):
        part = slabs == slab
        data = op11_collocations.filter_bytes(distinct[0][part], distinct[1][part], counts[part], half, slab_bits)
        read.append(op11_collocations.filter_entries(data, int(slab), half, slab_bits))
    for wrote, again in zip((*distinct, counts), zip(*read, strict=True), strict=True):
        assert (wrote == np.concatenate(again)).all()


# ------------------------------------------------------------------ circulant MinHash


def plain_components(rows, width=2, bound=(80, 100)):
    sets = []
    for _, text in rows:
        ws = words(lower(text))
        sets.append({tuple(ws[k : k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set())
    home = list(range(len(rows)))

    def root(i):
        while home[i] != i:
            i = home[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        shared, both = len(sets[i] & sets[j]), len(sets[i] | sets[j])
        if both and sets[i] and sets[j] and bound[1] * shared >= bound[0] * both:
            home[root(j)] = root(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(ids) if ids else None
    found = [(d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(((d, n, c, d is not None and d == c) for d, n, c in found), key=repr)


def near_rows():
    """A group of unequal copies whose original is no smallest id, copies of copies, and pairs on the bound."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(90)]
    out = []
    for k in range(80):
        ws = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 5, 8])):
            ws[rng.randrange(len(ws))] = f"e{rng.randrange(10_000)}"
        out.append((1_000 + k, " ".join(ws)))
    out.append((5_000, " ".join(base)))
    chain = list(base)
    for k in range(25):  # neighbours are alike, the ends are not
        chain[(7 * k) % 90] = f"c{k}"
        out.append((2_000 + k, " ".join(chain)))
    for k, extra in enumerate((20, 21, 22, 23, 24)):  # 89 shingles and some more
        out.append((3_000 + k, " ".join(["b" + w for w in base] + [f"x{k}y{i}" for i in range(extra)])))
    return out + [(3_100, " ".join("b" + w for w in base))]


def test_near_copies_of_crafted_and_real_texts(spark, small):
    rows = near_rows() + [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, op12_circulant.near_duplicates(table).collect()), key=repr)
    assert got == plain_components(rows)
    again = sorted(map(tuple, op12_circulant.near_duplicates(table, 5, (4, 5)).collect()), key=repr)
    assert again == plain_components(rows, 5, (4, 5))


def test_near_copies_of_odd_and_empty_tables(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = sorted(map(tuple, op12_circulant.near_duplicates(odd).collect()), key=repr)
    assert got == plain_components(rows)
    assert op12_circulant.near_duplicates(empty).count() == 0


def test_coordinates_estimate_the_similarity():
    """One circular shift a coordinate does as well as independent permutations; long sets go piece by piece."""
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 1 << 63, 150_000).astype(np.uint64))
    a, b = values[:100_000], values[20_000:120_000]
    both = op12_circulant.signatures([a, b, values[:10]])
    assert abs((both[0] == both[1]).mean() - 80_000 / 120_000) < 0.17
    alone = op12_circulant.signatures([values[:10]])
    assert (alone[0] == both[2]).all()
    assert len(set(op12_circulant._scramble(np.arange(1 << 16, dtype=np.uint32), op12_circulant.ORDER).tolist())) == 1 << 16


# ------------------------------------------------------------------ filter audit


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    parts = defaultdict(list)
    for doc_id, text, source in docs:
        t = text or ""
        ws = words(t)
        failed = "".join(
            c for c, hit in zip(
                "ABCDE",
                (
                    len(ws) < 200,
                    100 * len(set(ws)) < 50 * len(ws),
                    100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                    bool(re.search(r"[#$%&*|]", t)),
                    doc_id is not None and first[t] < doc_id,
                ),
                strict=True,
            ) if hit
        )
        parts[source or ""].append((failed, doc_id in good, doc_id in toxic))
    out = []
    for part, rows in parts.items():
        removed_by = Counter()
        orders = ["".join(o) for o in itertools.permutations("ABCDE")]
        steps = []
        for order in orders:
            left = rows
            for step, c in enumerate(order, start=1):
                gone = [r for r in left if c in r[0]]
                left = [r for r in left if c not in r[0]]
                removed_by[c] += len(gone)
                failing = sum(c in r[0] for r in rows)
                steps.append((order, step, len(left), len(gone), failing - len(gone), sum(r[0] == c for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(part, *s, removed_by[s[0][s[1] - 1]]) for s in steps]
    return sorted(out)


def test_audit_of_odd_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (8, 0, 1), (8, 1, None), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    got = op13_audit.audit(odd, labels).collect()
    assert sorted(map(tuple, got)) == plain_audit(docs, [tuple(r) for r in labels.collect()])
    assert op13_audit.audit(odd, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
    assert op13_audit.audit(empty, labels).count() == 0


def test_shapley_values_share_out_what_is_removed(spark, small, labels):
    got = op13_audit.audit(small, labels)
    totals = got.groupBy("part", "filter_order").agg(F.sum("removed").alias("all"), F.sum("shapley").alias("s"))
    assert totals.where("s <> 120 * all").count() == 0 and totals.count() > 0
