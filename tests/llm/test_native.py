"""Mixing and order MinHash against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from ledgerloom.llm import op3_mix, op4_order_minhash

PYTHON_NODES = ("ArrowEvalPython", "MapInArrow", "MapInPandas", "BatchEvalPython", "FlatMapGroups")


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_level(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def checked_mix(documents):
    given = defaultdict(int)
    for r in documents.select("source", "text").collect():
        given[r["source"]] += words(r["text"])
    target = water_level(given)
    got = op3_mix.mixture(documents).collect()
    assert len(got) == documents.count()
    by_size = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_size[round(r["target"], 6), r["source_size"]] += r["taken"]
    expected = defaultdict(int)
    for s, t in target.items():
        expected[round(t, 6), given[s]] += int(t + 1e-9)
    for key, taken in expected.items():
        assert abs(by_size[key] - taken) <= 2, key
    return got


def test_mix_of_real_documents(small):
    first = checked_mix(small)
    assert sorted(map(tuple, first)) == sorted(map(tuple, op3_mix.mixture(small.repartition(5)).collect()))


def test_documents_are_served_in_the_order_of_finish_times(small):
    """A plain queue that serves single words by finish time until the budget is spent."""
    queue = op3_mix.queued(small).collect()
    single = []
    for r in queue:
        for p in range(3):
            sent = p * r["source_size"] + r["start"]
            single += [((sent + k + 1) / r["target"], r["row"], r["at"], p) for k in range(r["size"])]
    taken = defaultdict(int)
    for _, _, at, _ in sorted(single)[: sum(r["size"] for r in queue)]:
        taken[at] += 1
    ours = sorted((r["doc_id"], r["taken"]) for r in op3_mix.mixture(small).collect())
    assert sum(t for _, t in ours) == sum(r["size"] for r in queue)
    plain = sorted((r["doc_id"], taken.get(r["at"], 0)) for r in queue)
    # Words of equal finish times may be exchanged at the cut.
    assert sum(abs(a - b) for (_, a), (_, b) in zip(ours, plain, strict=True)) <= 20


def test_mix_shares_the_excess_of_small_sources(spark):
    docs = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 900), ("b", 5), ("c", 7), ("c", 7), ("é", 40), (None, 11)])]
    checked_mix(spark.createDataFrame(docs, "doc_id long, text string, source string"))


def test_mix_of_odd_and_empty_tables(odd, empty):
    checked_mix(odd)
    assert op3_mix.mixture(empty).count() == 0
    assert op3_mix.mixed_documents(empty).count() == 0


def test_whole_documents_come_near_the_targets(small):
    mixed = op3_mix.mixed_documents(small)
    assert mixed.columns == small.columns
    target = {(r["source_size"], round(r["target"], 6)) for r in op3_mix.mixture(small).collect()}
    got = defaultdict(int)
    for r in mixed.select("source", "text").collect():
        got[r["source"]] += words(r["text"])
    assert abs(sum(got.values()) - sum(t for _, t in target)) < 0.2 * sum(t for _, t in target)
    copies = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert copies <= 3


@pytest.mark.parametrize("run", [op3_mix.mixture, op4_order_minhash.fingerprints])
def test_no_python_on_the_main_path(small, run):
    plan = run(small)._jdf.queryExecution().toString()
    assert not any(node in plan for node in PYTHON_NODES)


def edited_texts(documents):
    rows = [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]
    return sorted(rows)


def test_edited_texts_and_equal_fingerprints(small):
    given = edited_texts(small)
    got = {r["doc_id"]: r for r in op4_order_minhash.fingerprints(small).collect()}
    prints = defaultdict(set)
    for k, (doc_id, text) in enumerate(given):
        half = len(text) // 2
        following = given[(k + 1) % len(given)][1]
        edited = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        prints[text].add(r["fingerprint"])
    assert max(map(len, prints.values())) == 1
    long = [got[i] for i, t in given if len(t.split()) > 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.97 * len(long)




def test_order_counts_not_only_vocabulary(spark):
    base = " ".join(f"t{i}" for i in range(400))
    halves = base.split()
    swapped = " ".join(halves[200:] + halves[:200])
    docs = spark.createDataFrame([(1, base), (2, swapped), (3, base.replace("t7 ", "x7 "))], "doc_id long, text string")
    sign = {r[0]: r[1] for r in docs.select("doc_id", op4_order_minhash.signature(docs["text"])).collect()}
    same = lambda a, b: len(set(sign[a]) & set(sign[b])) / len(sign[a])
    assert same(1, 2) < 0.75 < 0.9 < same(1, 3)


def test_occurrences_are_numbered(spark):
    docs = spark.createDataFrame([(1, "a b c " * 3), (2, "a b c " * 40), (3, "a b c " * 40)], "doc_id long, text string")
    got = {r[0]: r[1] for r in docs.select("doc_id", op4_order_minhash.signature(docs["text"])).collect()}
    assert got[2] == got[3] != got[1] and len(got[2]) > len(got[1])


def test_odd_single_and_empty_tables(odd, empty, spark):
    got = op4_order_minhash.fingerprints(odd).collect()
    assert len(got) == odd.count()
    assert all(r["fingerprint"] == "" for r in got if r["n_chars"] == 0)
    assert op4_order_minhash.fingerprints(empty).count() == 0
    one = op4_order_minhash.fingerprints(spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()
