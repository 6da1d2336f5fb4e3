"""Pivot-table clustering against brute force with Python integers."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException

from opsanalytics.llm import op13_laesa_clusters as op13


def want(rows, k, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cent = [v for _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(cent))
            out.append((i, c, d, v))
        return out
    for _ in range(rounds):
        got = assign()
        for c in range(len(cent)):
            mine = [v for _, j, _, v in got if j == c]
            if mine:
                cent[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = assign()
    per = Counter()
    for _, c, d, _ in last:
        per[c] += d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in cent]
    return Counter((i, c, d, per[c], sum(per.values()), digest[c]) for i, c, d, _ in last)


def vectors(n: int, seed: int, groups: int = 6):
    r = np.random.default_rng(seed)
    mid = r.normal(0, 0.1, (groups, 64))
    rows = [(i, (mid[i % groups] + r.normal(0, 0.02, 64)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(0, rows[0][1]), (1, rows[5][1]), (None, rows[7][1]), (None, rows[8][1])] + [(500 + i, rows[3][1]) for i in range(40)]
    rows += [(901, None), (902, []), (903, [0.5] * 63), (904, [0.5] * 65), (905, [0.5] * 63 + [None]),
             (906, [0.5] * 63 + [float("nan")]), (907, [0.5] * 63 + [float("-inf")]), (908, [-0.0] * 64)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id bigint, embedding array<float>, q string, d int").repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters(spark, seed):
    rows = vectors(150, seed)
    got = op13.report(*op13.clusters(frame(spark, rows), k=12, rounds=3))
    assert Counter(tuple(r) for r in got.collect()) == want(rows, 12, 3)


def test_fewer_vectors_than_centroids(spark):
    rows = vectors(9, 3)[:9]
    got = op13.report(*op13.clusters(frame(spark, rows)))
    assert Counter(tuple(r) for r in got.collect()) == want(rows, 40, 5)


def test_empty_and_unusable(spark):
    assert op13.report(*op13.clusters(frame(spark, vectors(9, 3)[-8:-1]))).count() == 0


def test_too_large(spark):
    with pytest.raises(PySparkException, match="too large"):
        op13.clusters(frame(spark, [(1, [1e30] * 64)]))


def test_pivots_spare_distances():
    r = np.random.default_rng(5)
    mid = np.floor(256 * r.normal(0, 0.3, (40, 64))).astype(np.int64)
    q = mid[r.integers(0, 40, 4000)] + r.integers(-8, 9, (4000, 64))
    pivots = op13.far_apart(mid, 12)
    d = np.stack([np.sqrt(op13.squared(q, p)) for p in pivots], axis=1)
    at, best, measured = op13.nearest(q, d, mid, pivots)
    full = np.stack([op13.squared(q, c) for c in mid], axis=1)
    assert (at == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert measured < 0.1 * full.size
