"""Mined negatives against all scores in plain integers, and the bounds against true scores."""

import math

import numpy as np
import pytest

from loanmart.llm import hard_negatives as M

SCHEMA = "vec_id long, embedding array<float>, label int, q string, rank string"


def plain(rows, every=100, positives=5, negatives=10):
    part = []
    for i, v, k in rows:
        if k is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        k = (k + 1) % 10 if i is not None and i % 7 == 0 else k
        part.append((i, k, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    out = []
    for i, k, q in {p for p in part if p[0] is not None and p[0] % every == 0}:
        scored = [(sum(x * y for x, y in zip(q, o[2])), o) for o in part if len(o[2]) == len(q)]
        order = lambda t: (-t[0], t[1][0] is None, t[1][0] or 0)
        for ps, p in sorted((t for t in scored if t[1][1] == k and t[1][0] != i), key=order)[:positives]:
            near = sorted((t for t in scored if t[1][1] != k and 30 * ps <= 100 * t[0] <= 90 * ps), key=order)[:negatives]
            out += [(i, p[0], r, n[0], ps, s) for r, (s, n) in enumerate(near, 1)]
    return sorted(out, key=str)


def run(spark, rows, parts=3, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)
    got = M.hard_negatives(df, **how)
    return sorted((tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def vectors(seed, n, dims, spread=0.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)) + spread * rng.standard_normal((1, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1::9] = x[::9][: len(x[1::9])]  # copies, so ties
    return [(int(i), [float(c) for c in v], int(k)) for i, (v, k) in enumerate(zip(x.astype(np.float32), rng.integers(0, 10, n)))]


@pytest.mark.parametrize("dims,spread,how", [(64, 0, {}), (64, 1.0, {"anchors_at_once": 3}), (5, 0.5, {}), (64, 0.3, {"first_share": 2})])
def test_equals_all_scores(spark, dims, spread, how):
    rows = vectors(dims, 1300, dims, spread)
    assert run(spark, rows, **how) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(1, 400, 4, 1.0)
    rows += [(500, None, 1), (600, [], 1), (700, [nan, 0.0, 0.0, 0.0], 1), (800, [inf, 0.0, 0.0, 0.0], 1), (900, [None, 0.0, 0.0, 0.0], 1), (1000, [1.0, 0.0, 0.0, 0.0], None), (None, [0.5, 0.5, 0.5, 0.5], 2), (None, [0.5, 0.5, 0.5, 0.5], 3),
             (100, [0.5, 0.5, 0.5, 0.5], 3), (100, [0.5, 0.5, 0.5, 0.5], 3), (200, [0.0] * 4, 5), (1100, [0.25, 0.5], 1), (1101, [0.5, 0.5], 1), (1102, [0.2, 0.4], 2), (-300, [0.5, 0.4, 0.1, 0.0], 4), (1200, [3e38, -3e38, 1e30, 0.0], 1)]
    want = plain([r for r in rows if r[0] != 1200])
    assert run(spark, [r for r in rows if r[0] != 1200]) == want
    assert any(r[1] is None for r in want) or any(r[3] is None for r in want)
    run(spark, rows)  # huge components are held within a limit
    assert run(spark, []) == [] and run(spark, rows[:1]) == []


def test_bounds_hold_true_scores():
    rng = np.random.default_rng(0)
    for dims in (1, 7, 64):
        q = rng.integers(-300, 300, (60, dims)).astype(np.int32) + rng.integers(-200, 200, (60, 1)).astype(np.int32)
        mean, deviation = (s.astype(np.float32) for s in M.summaries(q))
        v = M.Vectors(np.arange(60), np.zeros(60, np.int64), q, mean, deviation)
        true = q.astype(np.int64) @ q.T
        widths = []
        for length, m, d in v.levels:
            reach = d @ d.T + 1e-6 * v.norm[:, None] * v.norm[None, :] + 1
            assert (np.abs(true - length * (m @ m.T)) <= reach).all()
            widths.append(reach.mean())
        assert widths[1] <= widths[0]
        # only pairs within the window come back, all of them
        low, high = np.full(60, np.quantile(true, 0.7)), np.full(60, np.quantile(true, 0.9))
        i, j, score = M.possible(v, v, np.ones((60, 60), bool), low, high)
        assert (score == true[i, j]).all()
        inside = {(a, b) for a, b in zip(*np.nonzero((true >= low[0]) & (true <= high[0])))}
        assert inside <= set(zip(i.tolist(), j.tolist()))


def test_smooth_vectors_are_ruled_out_by_summaries():
    rng = np.random.default_rng(3)
    q = np.repeat(rng.integers(-200, 200, (500, 4)), 16, axis=1).astype(np.int32)
    v = M.Vectors(np.arange(500), np.zeros(500, np.int64), q, *(s.astype(np.float32) for s in M.summaries(q)))
    true = q.astype(np.int64) @ q.T
    i, _, _ = M.possible(v, v, np.ones((500, 500), bool), np.full(500, np.quantile(true, 0.99)), np.full(500, M.MOST))
    assert len(i) < 0.011 * true.size


def test_query_runs(spark):
    from loanmart.llm import queries
    from tests.conftest import SF_SMALL
    out = queries.QUERIES["op13_hard_negatives"](spark, SF_SMALL)
    assert out.count() and {r.rank for r in out.select("rank").distinct().collect()} == set(range(1, 11))
