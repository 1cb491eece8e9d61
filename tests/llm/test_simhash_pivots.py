"""Fingerprints and components beside a plain version."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ballotlake.llm import common, simhash_pivots


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=2):
    """prints: [(doc_id, fp)] -> smallest doc_id of each row's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return [ids.get(find(i)) for i in range(len(prints))]


def test_query_equals_plain_version(spark, sf):
    rows = common.table(spark, sf, "documents").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in rows]
    expected = {(d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints))}
    found = simhash_pivots.query(spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == expected
    assert len(found) == len(rows)


@pytest.mark.parametrize("dense", [4, 64])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, dense):
    """Chains and clouds of close fingerprints, paired or linked by shared words."""
    monkeypatch.setattr(simhash_pivots, "DENSE", dense)
    dice = random.Random(3)
    prints = set()
    for _ in range(20):
        at = dice.getrandbits(64)
        for _ in range(12):
            prints.add(at)
            for _ in range(dice.randint(1, 4)):
                at ^= 1 << dice.randrange(64 if dice.random() < 0.5 else 8)
    prints |= {dice.getrandbits(64) for _ in range(50)} | {0, 1, 3, 7, (1 << 64) - 1}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    edges = [(r.a, r.b) for r in simhash_pivots.links(frame).collect()]
    for a, b in edges:
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2
    roots = {r.node: r.root for r in simhash_pivots.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    order = list(signed)
    expected = plain_components(list(enumerate(order)))
    groups = {}
    for place, p in enumerate(order):
        root = roots.get(signed[p], signed[p])
        assert groups.setdefault(root, expected[place]) == expected[place]
    assert len(groups) == len(set(expected))


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(5, None, "x"), (3, "", "x"), (9, " \t\n", None), (None, "", "y"), (4, "A b c d", "x"), (4, "A b c d", "x"),
         (2, "a B c d", "z"), (None, "one two", "q"), (7, "word " * 30000, "x"), (8, "x" * 200000, "x")],
        "doc_id long, text string, source string",
    ).withColumn("lang", F.lit(None).cast("string")).withColumn("fp", F.lit("clash")).withColumn("_key", F.lit(1))
    rows = simhash_pivots.grouped(docs).collect()
    assert len(rows) == 10
    found = {(r.doc_id, r.fp == 0): r.component_id for r in rows}
    assert found[(5, True)] == found[(3, True)] == found[(9, True)] == found[(None, True)] == 3
    assert found[(4, False)] == found[(2, False)] == 2 and found[(None, False)] is None
    kept = simhash_pivots.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text)) for r in kept.collect()) == [(0, 7), (2, 7), (3, 0), (7, 150000), (8, 200000)]
    assert simhash_pivots.grouped(docs.limit(0)).count() == 0
    assert simhash_pivots.stage(spark, docs.limit(0), "").count() == 0
