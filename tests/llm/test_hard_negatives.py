"""Hard negatives against scoring every row; SQL is compared in test_native."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiosklake.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score string, r string, block string"


def plain(rows, asks, positives=5, negatives=10, lowest=30, highest=90):
    """All scores, sorted."""
    held = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y in rows
            if None not in (i, v, y) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, u, y in held:
        if not asks(a):
            continue
        scored = [(-sum(p * q for p, q in zip(u, w)), b, z) for b, w, z in held if b != a and len(w) == len(u)]
        for s, b, _ in sorted(x for x in scored if x[2] == y)[:positives]:
            inside = sorted(x for x in scored if x[2] != y and -lowest * s <= -100 * x[0] <= -highest * s)[:negatives]
            out += [(a, b, k + 1, c, -s, -t) for k, (t, c, _) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, step=10, **given):
    frame = spark.createDataFrame([(i, v, y, "x", "x", "x", "x") for i, v, y in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives.mine(frame, asks=F.col("vec_id") % step == 0, **given).collect())


def vectors(n, dim, labels, seed, spread=1.0):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, spread) for _ in range(dim)] for _ in range(labels)]
    out = []
    for i in range(n):
        y = 0 if rnd.random() < 0.4 else rnd.randrange(labels)  # a label with much of all rows
        out.append((i, [c + rnd.gauss(0, 0.7) for c in centres[y]], (y + (i % 7 == 0)) % labels))
    return out


@pytest.mark.parametrize("dim, given", [(3, {}), (24, {}), (17, {"positives": 2, "negatives": 3, "lowest": 10, "highest": 60})])
def test_against_all_scores(spark, monkeypatch, dim, given):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)  # several groups
    rows = vectors(600, dim, 4, dim)
    want = plain(rows, lambda a: a % 10 == 0, **given)
    assert len(want) > 300 and mined(spark, rows, **given) == want


def test_ties_nulls_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, 0.25], i % 2) for i in range(40)]  # everything ties
    rows += [(40, None, 1), (41, [1.0, None], 1), (42, [nan, 1.0], 0), (43, [inf, 1.0], 0), (44, [1.0, 1.0], None), (None, [1.0, 1.0], 0)]
    rows += [(50, [1.0], 0), (51, [0.9], 0), (52, [0.5], 1), (60, [], 0), (61, [], 0), (62, [], 1), (70, [-1.0, 0.0, 0.0], 2)]
    rows += [(3, [0.125, 0.125], 0), (3, [0.125, 0.125], 0)]  # a repeated row
    assert mined(spark, rows) == plain(rows, lambda a: a % 10 == 0)


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 0)]) == []


def test_scores_that_would_not_be_exact_fail(spark):
    with pytest.raises(Exception, match="exact"):
        mined(spark, [(10, [1e6, 1e6], 0), (11, [1e6, 1e6], 0)])


def test_bounds_rule_rows_out(monkeypatch):
    """Few rows are read to the end when the first dimensions tell."""
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(2000, 64)) * np.geomspace(400, 1, 64)).astype(np.int64)
    block = hard_negatives._Block({
        "dim": 64, "n": 2000, "ids": np.arange(2000).tobytes(), "labels": np.zeros(2000, np.int64).tobytes(),
        "low": vectors.min(axis=0).tobytes(), "high": vectors.max(axis=0).tobytes(), "columns": [c.tobytes() for c in vectors.T],
    })
    left = []

    def prune(least, most):
        left.append(len(least))
        return most >= hard_negatives._kth(least, 5)

    rows, score = block.scan(vectors[0].astype(float), np.ones(2000, bool), prune)
    exact = vectors @ vectors[0]
    assert left[0] == 2000 and left[-1] < 100
    assert set(np.argsort(-exact)[:5]) <= set(rows) and (score == exact[rows]).all()
