"""Hard negatives against a plain search over all pairs, and what the angles promise."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from countypanel.llm import hard_negatives
from countypanel.llm.hard_negatives import Side, angles, directions, mine, top, windows


def brute(rows, positives=5, negatives=10, low=30, high=90):
    good = sorted({(i, lab, tuple(math.floor(256.0 * x) for x in v)) for i, v, lab in rows
                   if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = set()
    for i, lab, a in good:
        if i % 10:
            continue
        scored = [(min(max(sum(x * y for x, y in zip(a, v, strict=False)), -(2**63)), 2**63 - 1), j, other == lab) for j, other, v in good]
        first = sorted((-s, j) for s, j, same in scored if same and j != i)[:positives]
        for s, p in first:
            hard = sorted((-n, j) for n, j, same in scored if not same and low * -s <= 100 * n <= high * -s)
            out |= {(i, p, k + 1, j, -s, -n) for k, (n, j) in enumerate(hard[:negatives])}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_mining_is_exact(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 5)
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], rng.randint(0, 3)) for i in range(160)]
    rows += [(200 + i, rows[40][1], i % 2) for i in range(60)]  # hot copies: ties among positives and negatives, anchors among them
    rows += [(300 + i, [0.0] * 6, i % 3) for i in range(30)] + [(350 + i, [-x for x in rows[i][1]], 2) for i in range(20)]
    rows += [(400, None, 1), (410, [None] * 6, 1), (420, [float("nan")] * 6, 1), (430, [float("inf")] + [0.0] * 5, 1), (440, [1.0] * 6, None),
             (None, rows[0][1], 1), rows[0], (450, [1.0, 2.0], 1), (460, [1e30, 0, 0, 0, 0, 1], 1), (470, [3e38] * 6, 2), (480, [-1e25] * 6, 1),
             (490, [2e5, 1e4, 3, 2, 1, 0], 1), (490, [2e5, 1e4, 3, 2, 1, 9], 1), (500, [-0.001] * 6, 7), (510, [], 1)]
    rows = [(i, None if v is None else [x if x is None else float(x) for x in v], lab) for i, v, lab in rows]
    data = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, score int")
    exact = [(r.vec_id, r.embedding, r.label) for r in data.collect()]
    got = [tuple(r) for r in mine(data, F.col("vec_id") % 10 == 0).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(exact)
    few = mine(data, F.col("vec_id") % 10 == 0, positives=2, negatives=3, low=60, high=100, n_directions=1).collect()
    assert {tuple(r) for r in few} == brute(exact, 2, 3, 60, 100)
    assert mine(data.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert mine(data, F.lit(False)).count() == 0


def test_bounds_hold_the_score_and_spare_pairs():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(4, 32))
    v = np.floor(256 * np.vstack([centre[k] + rng.normal(size=(100, 32)) * 0.05 for k in range(4)] + [np.zeros((1, 32)), -centre[:1]]))
    refs = directions(v, 8)
    norm, found = angles(v, refs)
    side = Side(pd.DataFrame({"cid": range(len(v)), "label": 0, "v": list(v), "norm": norm, "angles": list(found)}), 32)
    every = np.arange(len(v))
    low, high = side.bounds(side, every, every)
    score = v @ v.T
    assert (low <= score).all() and (score <= high).all()
    lo, hi = windows(int(score[0, 1]), 30, 90)
    assert ((high[0] >= lo) & (low[0] <= hi)).mean() < 0.7  # most pairs of one cluster lie above the window for sure


def test_top_keeps_the_first_of_equals():
    scores = np.array([[5, 7, 7, 1, 7], [0, 0, 0, 0, 0], [1, 2, 3, 4, 5]])
    among = np.array([[1, 1, 1, 1, 1], [0, 1, 0, 1, 1], [0, 0, 0, 0, 1]], bool)
    assert top(scores, among, 2).astype(int).tolist() == [[0, 1, 1, 0, 0], [0, 1, 0, 1, 0], [0, 0, 0, 0, 1]]
    assert windows(-10, 30, 90) == (-3, -9) and windows(0, 30, 90) == (0, 0) and windows(7, 30, 90) == (3, 6)
