"""Targets, evenness and what is taken, beside plain versions."""

import math
import random
from collections import Counter

import pytest

from ballotlake.llm import common
from ballotlake.llm import mixing as M


def plain_targets(sizes):
    """sizes: {source: words}; fill round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.CYCLE[k % len(M.CYCLE)] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        shares = {s: weight[s] * left / sum(weight[f] for f in free) for s in free}
        over = {s: 2 * sizes[s] for s in free if shares[s] > 2 * sizes[s]}
        if not over:
            return {**shares, **capped}
        capped.update(over)


def frame_of(spark, sizes):
    rows = [(k, " ".join(["w"] * n), s) for k, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_takes_what_the_targets_say(spark):
    dice = random.Random(3)
    sizes = [("hot" if dice.random() < 0.4 else dice.choice(["a", "B", "é", None, "tiny"]), int(dice.expovariate(0.01))) for _ in range(400)]
    per_source = Counter()
    for s, n in sizes:
        per_source[s] += n
    expected = plain_targets(per_source)
    result, slots = M.mix(frame_of(spark, sizes))
    rows = result.collect()
    assert len(rows) == len(sizes)
    taken = Counter()
    for r in rows:
        source, size = sizes[r.doc_id]
        assert (r.size, r.source_size) == (size, per_source[source]) and r.target == pytest.approx(expected[source])
        assert 0 <= r.taken <= 2 * size
        taken[source] += r.taken
    # Blocks are single words here.
    for source, words in taken.items():
        assert abs(words - expected[source]) <= 2 + math.log2(sum(taken.values()))
    # The schedule: every rank once, and evenly spread all along.
    listed = slots.orderBy("slot").collect()
    total = sum(r.words for r in listed)
    assert total == sum(taken.values())
    by_source = {}
    for r in listed:
        assert r["rank"] == by_source.get(r.sid, 0)
        by_source[r.sid] = r["rank"] + 1
    counts, seen = Counter(r.sid for r in listed), Counter()
    for place, r in enumerate(listed, 1):
        seen[r.sid] += 1
        for sid, number in counts.items():
            assert abs(seen[sid] - place * number / len(listed)) <= 5


def test_documents_have_what_the_slots_take(spark, monkeypatch):
    """Word by word along the slots, in blocks of several words and over two laps."""
    monkeypatch.setattr(M, "SLOTS", 300)
    dice = random.Random(9)
    sizes = [(dice.choice(["a", "a", "b", None, "small" if k % 20 == 0 else "a"]), dice.randrange(0, 30)) for k in range(150)]
    frame = frame_of(spark, sizes)
    result, slots = M.mix(frame)
    streams = {}
    order = {r.doc_id: r.shuffle for r in M.sized(frame).collect()}
    for doc in sorted(order, key=lambda d: (order[d], sizes[d][1])):
        streams.setdefault(sizes[doc][0], []).extend([doc] * sizes[doc][1])
    names = sorted({s for s, _ in sizes}, key=lambda s: (s is None, s or ""))
    taken, first, last = Counter(), {}, {}
    for r in slots.orderBy("slot").collect():
        stream = streams[names[r.sid]]
        for k in range(r.words):
            doc = stream[(r.start + k) % len(stream)]
            taken[doc] += 1
    by_rank = {}
    for r in slots.collect():
        for k in range(r.words):
            by_rank[r.sid, r["rank"], k] = (streams[names[r.sid]][(r.start + k) % len(streams[names[r.sid]])], r.slot)
    for key in sorted(by_rank):
        doc, slot = by_rank[key]
        first.setdefault(doc, slot)
        last[doc] = slot
    for r in result.collect():
        assert (r.taken, r.first_slot, r.last_slot) == (taken[r.doc_id], first.get(r.doc_id), last.get(r.doc_id))
        assert r.taken <= 2 * r.size


def test_the_points_decide(spark):
    dice = random.Random(4)
    frame = frame_of(spark, [(dice.choice("abcd"), dice.randrange(0, 60)) for _ in range(80)])
    golden = sorted(map(tuple, M.mix(frame)[0].collect()))
    other = sorted(map(tuple, M.mix(frame, lambda slot: M.F.abs(M.F.hash(slot)) / 2.0**31)[0].collect()))
    assert [r[:4] for r in golden] == [r[:4] for r in other]
    assert [r[4] for r in golden] != [r[4] for r in other] and [r[5] for r in golden] != [r[5] for r in other]


def test_reruns_agree(spark, sf):
    first = sorted(tuple(r) for r in M.query(spark, sf).collect())
    docs = common.table(spark, sf, "documents").repartition(13)
    assert sorted(tuple(r) for r in M.mix(docs)[0].collect()) == first


def test_edge_cases(spark, odd_docs):
    result, _ = M.mix(odd_docs)
    rows = result.collect()
    assert len(rows) == odd_docs.count()
    assert all(r.taken <= 2 * r.size for r in rows) and sum(r.taken for r in rows) > 0
    assert M.mix(odd_docs.limit(0))[0].count() == 0
    empty = frame_of(spark, [("a", 0), ("b", 0)])
    assert [(r.size, r.taken, r.target) for r in M.mix(empty)[0].collect()] == [(0, 0, 0.0)] * 2
    assert sorted((r.size, r.taken) for r in M.mix(frame_of(spark, [("a", 5)]))[0].collect()) == [(5, 7)]
