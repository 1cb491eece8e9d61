"""Whitened rows beside numpy's eigenvectors over the distinct vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballotlake.llm import common
from ballotlake.llm import whitening as W


def plain(rows, scale=W.SCALE, size=W.COMPONENTS):
    """{(vec_id, component): (n, deviation, |whitened|, explained)}"""
    kept = [(k, [math.floor(scale * c) for c in v]) for k, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    widest = max(len(v) for _, v in kept)
    kept = [(k, tuple(v + [0] * (widest - len(v)))) for k, v in kept]
    fit = np.array(sorted({v for _, v in kept}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    away = fit - sums / n
    values, vectors = np.linalg.eigh(away.T @ away / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for key, v in kept:
        for k in range(min(size, len(values))):
            if values[k] > values.sum() * W.FLAT:
                y = (np.array(v) - sums / n) @ vectors[:, k] / math.sqrt(values[k])
                out.append((key, k + 1, n, int(sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))), abs(y), values[k] / values.sum()))
    return out


def agrees(found, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    found, want = sorted(map(tuple, found), key=key), sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    for a, b in zip(found, want):
        assert abs(a[4]) == pytest.approx(b[4], abs=1e-9)
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert 0 <= a[6] < 1e-9
    assert len({r[6] for r in found}) <= 1


def test_query(spark, sf):
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in common.table(spark, sf, "embeddings").collect()]
    agrees(W.query(spark, sf).collect(), plain(rows))


def test_blocks_of_rows_and_columns(spark, monkeypatch):
    monkeypatch.setattr(W, "BLOCK_ROWS", 16)
    monkeypatch.setattr(W, "BLOCK_COLUMNS", 5)
    dice = np.random.default_rng(1)
    rows = [(k, (dice.normal(size=12) * np.arange(1, 13)).tolist()) for k in range(100)]
    rows += [(1000 + k, rows[0][1]) for k in range(60)]  # a vector of many rows counts once
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    agrees(W.whiten(frame).collect(), plain(rows))


def test_one_sign_for_all_rows(spark):
    rows = [(k, [float(k), 2.0 * k + (k % 3), 1.0]) for k in range(20)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    first = [r.whitened for r in W.whiten(frame).filter("component = 1").orderBy("vec_id").collect()]
    assert first == sorted(first) or first == sorted(first, reverse=True)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25, 0.0]), (1, [0.5, -0.25, 0.0]), (2, [1.0, 2.0, -0.0]), (None, [0.25, 0.25]), (3, None), (4, [1.0, None, 2.0]),
            (5, [nan, 1.0, 1.0]), (6, [1.0, inf, 1.0]), (7, [1.0, -inf, 1.0]), (8, []), (9, [-1.0, 0.004, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({name: F.lit(7) for name in ("x", "_row", "_id", "n", "y", "component")})
    agrees(W.whiten(frame).collect(), plain(rows))
    for few in (frame.limit(0), frame.filter("vec_id = 1"), frame.filter("vec_id = 3"), frame.filter("vec_id = 8")):
        result = W.whiten(few)
        assert result.count() == 0
        assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_wide_vectors_are_refused(spark, monkeypatch):
    monkeypatch.setattr(W, "WIDEST", 2)
    with pytest.raises(ValueError, match="3 entries"):
        W.whiten(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id long, embedding array<double>"))
