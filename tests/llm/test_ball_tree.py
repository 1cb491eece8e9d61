"""Bounds and pruning beside plain scores; whole searches beside a plain version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ballotlake.llm import ball_tree as B


def made(rows, width, seed=1):
    """Sparse rows that fall into groups, and the weight of every term."""
    dice = np.random.default_rng(seed)
    centres = dice.integers(0, width, (6, 12))
    parts = []
    for k in range(rows):
        terms = np.unique(np.append(dice.choice(centres[k % 6], 8), dice.integers(0, width, 3)))
        parts.append((terms, dice.integers(1, 1_000_000, len(terms))))
    return parts, dice.integers(1, 20_000, width)


def plain_scores(parts, weight, terms):
    asked = set(terms.tolist())
    return [sum(int(weight[t]) * int(v) for t, v in zip(*part) if t in asked) for part in parts]


def test_bounds_hold_and_nodes_are_pruned():
    parts, weight = made(4000, 300)
    tree = B.tree_of(parts, weight)
    dice, opened = random.Random(2), 0
    for _ in range(40):
        terms = parts[dice.randrange(len(parts))][0]
        scores = np.array(plain_scores(parts, weight, terms))[tree.order]
        bounds = tree.bounds(terms, weight[terms])
        for low, high, bound in zip(tree.low, tree.high, bounds):
            assert scores[low:high].max() <= bound
        best, dense = [], np.zeros(len(weight), np.int64)
        dense[terms] = weight[terms]
        tree.search(terms, weight[terms], dense, list(range(0, -len(parts), -1)), best, 10)
        want = sorted(((s, -int(k)) for s, k in zip(scores, tree.order) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
        opened += sum(1 for k, left in enumerate(tree.left) if left < 0 and bounds[k] >= best[0][0])
    assert opened < 0.7 * 40 * sum(left < 0 for left in tree.left)


def test_equal_rows_make_a_shallow_tree():
    rows = [(np.array([1, 2]), np.array([500, 7]))] * 3000
    tree = B.tree_of(rows, np.array([1, 2, 3]))
    assert max(h - low for low, h, left in zip(tree.low, tree.high, tree.left) if left < 0) <= B.LEAF
    best, dense = [], np.array([0, 2, 3])
    tree.search(np.array([1, 2]), np.array([2, 3]), dense, list(range(0, -3000, -1)), best, 5)
    assert sorted(best, reverse=True) == [(1021, -k) for k in range(5)]


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered) if w]


def plain_search(docs, items, limit):
    texts = [(d, words(t)) for d, t in docs]
    texts = [(d, w) for d, w in texts if w]
    total, length = len(texts), sum(len(w) for _, w in texts)
    held = Counter(t for _, w in texts for t in set(w))
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for doc, own in texts:
            counts, m = Counter(own), 50 + (50 * len(own) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * held[t] + 1)))
                        * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 20 * m)) for t in terms if t in counts)
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores)[:limit], 1)]
    return out


@pytest.mark.parametrize("tree_rows, block", [(1 << 15, 200_000), (7, 12)])
def test_search_is_that_of_a_plain_version(spark, monkeypatch, tree_rows, block):
    dice = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ärger", "naïve"]
    text = lambda n: " ".join(dice.choice(vocabulary[: dice.choice((5, 30, 62))]) for _ in range(n))
    docs = [(k, text(dice.randrange(0, 40))) for k in range(300)]
    docs += [(1000 + k, "w1 w2 w40 copies") for k in range(150)] + [(7, None), (8, ""), (9, "...")]
    items = [(k, text(dice.randrange(1, 12))) for k in range(9)] + [(3, "w50 W51"), (77, None), (78, "absent words"), (79, "W1-w40")]
    monkeypatch.setattr(B, "DOCUMENTS", tree_rows)
    monkeypatch.setattr(B, "BLOCK", block)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = B.search(frame, spark.createDataFrame(items, "item_id long, text string"), 20)
    assert sorted(map(tuple, found.collect())) == sorted(plain_search(docs, items, 20))


def test_edge_cases(spark, odd_docs):
    items = spark.createDataFrame([(1, "words and line"), (1, "same"), (None, "a"), (2, None), (3, "")], "item_id long, text string")
    items = items.withColumns({name: B.F.lit(1) for name in ("term", "rank", "doc_id", "score")})
    rows = B.search(odd_docs, items).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["item_id"] is None] == [(1, 9), (2, 10)]
    assert {r["doc_id"] for r in rows if r["item_id"] == 1} == {1, 5, 7}
    assert sorted(r["rank"] for r in rows if r["item_id"] == 1) == [1, 2, 3, 4]
    assert {r["item_id"] for r in rows} == {1, None}
    assert B.search(odd_docs.limit(0), items).count() == 0
    assert B.search(odd_docs, items.limit(0)).count() == 0


def test_null_doc_ids_come_last_among_equals(spark):
    docs = spark.createDataFrame([(None, "x y"), (2, "x y"), (1, "x y"), (3, "z"), (4, "z z")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [r["doc_id"] for r in B.search(docs, items).orderBy("rank").collect()] == [1, 2, None]
