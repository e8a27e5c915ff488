import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, anchor=lambda v: v % 50 == 0, positives=5, keep=3, low=50, high=95):
    """Every anchor against every other row, with whole numbers."""
    fine = []
    for k, (v, label, x) in enumerate(rows):
        if label is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            fine.append((k, v, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for k, v, label, q in fine:
        if v is None or not anchor(v):
            continue
        scored = [(sum(a * b for a, b in zip(q, p)), w, other) for j, w, other, p in fine if j != k]
        for ps, pv, _ in sorted((t for t in scored if t[2] == label), key=order)[:positives]:
            fit = sorted((t for t in scored if t[2] != label and low * ps <= 100 * t[0] <= high * ps), key=order)[:keep]
            out += [(v, pv, r + 1, nv, ps, ns) for r, (ns, nv, _) in enumerate(fit)]
    return sorted(out, key=str)


def vectors(n, d=16, labels=4, seed=1):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    return [(k, k % labels if rng.random() < 0.8 else rng.randrange(labels), [rng.gauss(0, 0.5) + m for m in middles[k % labels]]) for k in range(n)]


def mined(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % 50 == 0, **how).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    rows = vectors(700)
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want
    # Several blocks of anchors, several parts of rows, other ranges and counts: the same pairs.
    monkeypatch.setattr(negatives, "FIRST", 20)
    monkeypatch.setattr(negatives, "GROWTH", 4)
    assert mined(spark, rows, block_bytes=8_000) == want
    assert mined(spark, rows, levels=1, bits=2) == want
    assert mined(spark, rows, positives=2, negatives=7, low=10, high=80) == brute(rows, positives=2, keep=7, low=10, high=80)


def test_odd_rows(spark):
    """Nulls, non-finite components, ties, repeated rows and ids, other lengths, zero and far vectors, one hot vector."""
    rows = vectors(260, d=7, labels=3)
    rows += [(None, 1, [0.5] * 7), (None, 2, [0.25] * 7), (1001, None, [1.0] * 7), (1002, 1, None), (1003, 1, [0.1, None, 0.2]), (1004, 1, [float("nan")] * 7), (1005, 2, [float("inf")] + [0.0] * 6)]
    rows += [(2000 + k, k % 3, [0.5, 0.25, 0.0, -0.5, 0.5, 1.0, 0.125]) for k in range(150)]  # many ties, three anchors among them
    rows += [(50, 1, [0.75] * 7), (50, 1, [0.75] * 7), (100, 2, [0.3] * 70), (150, 0, []), (200, 1, [0.0] * 7), (-50, 2, [1.0, 2.0, 3.0]), (2**40, 1, [100.0] * 7)]
    assert mined(spark, rows) == brute(rows)
    extra = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS row", "'x' AS part", "'x' AS slot", "'x' AS q", "'x' AS draw")
    assert sorted(map(tuple, negatives.mine(extra, F.col("vec_id") % 50 == 0).collect()), key=str) == brute(rows)
    assert mined(spark, []) == [] and mined(spark, [(50, 1, [1.0])]) == [] and mined(spark, [(51, 1, [1.0]), (52, 1, [1.0])]) == []


def test_too_large_takes_no_part(spark):
    rows = vectors(200)
    assert mined(spark, [*rows, (5000, 1, [4097.0] * 16), (5001, 1, [3e38] * 16)]) == brute(rows)


@pytest.mark.parametrize("d,most", [(5, 0.1), (64, 0.2), (100, 0.3), (300, 0.7)])
def test_intervals_hold_every_score(d, most):
    """No pair inside the range is lost, and six levels leave few outside it."""
    rng = np.random.default_rng(d)
    width = max(64, 1 << (d - 1).bit_length())
    q = np.zeros((400, width), np.int64)
    q[:, :d] = np.floor(256 * rng.normal(size=(400, d)) / d**0.5)
    q[7], q[8] = 0, q[9]
    assert np.allclose(negatives.rotated(q) @ negatives.rotated(q).T, q @ q.T)
    codes, align, lengths = negatives.encode(q)
    anchors = {"q": q[:60], **negatives.planes(q[:60])}
    exact = q @ q[:60].T
    low, high = np.full(60, np.percentile(exact, 98)), np.full(60, np.percentile(exact, 99.5))
    allowed = rng.random(exact.shape) < 0.9
    i, j, scores = negatives.survivors(codes, align, lengths, q, anchors, np.arange(60), low, high, allowed)
    assert (scores == exact[i, j]).all() and allowed[i, j].all()
    want = set(zip(*np.nonzero(allowed & (exact >= low) & (exact <= high))))
    assert want <= set(zip(i, j)) and len(i) < most * exact.size
