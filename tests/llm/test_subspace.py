"""The subspace join against all pairs in double precision, with regions of every kind."""

import numpy as np
import pytest

from loanmart.llm import subspace

SCHEMA = "vec_id long, embedding array<float>, label int, node string, component_id string"


def plain(rows, cosine=0.98):
    """(vec_id, n_links, component_id, kept) of every row, from all pairs."""

    def usable(v):
        return v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(c != 0 for c in v)

    ok = [r[2] is not None and usable(r[1]) for r in rows]
    unit = [None if not o else np.array(r[1], np.float32).astype(np.float64) for r, o in zip(rows, ok)]
    unit = [u if u is None else u / np.sqrt(u @ u) for u in unit]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, least is not None and rows[i][0] == least))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    got = subspace.near_vectors(df, **how)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def planted(seed, n, dims, copies, labels=3):
    """Random vectors, with chains and clusters of copies at all distances around the limit."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = rng.integers(0, labels, n)
    for _ in range(copies):
        a, b = rng.integers(0, n, 2)
        step = rng.standard_normal(dims)
        x[b] = x[a] + step / np.linalg.norm(step) * rng.choice([0, 1e-4, 0.05, 0.15, 0.19, 0.2, 0.21, 0.25])
        x[b] *= rng.choice([1, 1, 0.01, 300])
        label[b] = label[a]
    return [(int(i), [float(c) for c in v], int(k)) for i, (v, k) in enumerate(zip(x.astype(np.float32), label))]


@pytest.mark.parametrize("dims,how", [(64, {}), (64, {"region_rows_": 40}), (64, {"block_dims": 8, "region_rows_": 25}), (3, {"region_rows_": 60}), (20, {"block_dims": 6}), (1, {})])
def test_equals_all_pairs(spark, dims, how):
    rows = planted(dims, 300, dims, 260)
    assert run(spark, rows, **how) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 0.0], [1.0, 2.0, 0.05]
    rows = [(1, a, 1), (1, a, 1), (1, b, 1), (2, [2.0, 4.0, 0.0], 1), (None, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [nan, 1.0, 1.0], 1), (9, [inf, 0.0, 0.0], 1),
            (10, [None, 1.0, 1.0], 1), (11, [1.0, 2.0], 1), (12, [1.0, 2.0], 1), (13, [3e38, 3e38, 0.0], 1), (14, [1e-40, 1e-40, 0.0], 1), (None, [5.0, 0.0, 0.0], 7), (None, [5.0, 0.1, 0.0], 7), (-5, [-1.0, -2.0, 0.0], 1), (15, [-0.0, 0.0, -1.0], 3), (16, [0.0, -0.0, -1.0], 3)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, region_rows_=2) == plain(rows)
    assert run(spark, []) == [] and run(spark, [(1, None, None)]) == [(1, 0, 1, True)]


def test_copies_and_a_crowd_in_one_cell(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(64)
    crowd = base + rng.standard_normal((150, 64)) * 0.02
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(np.concatenate([np.repeat(base[None], 200, axis=0), crowd, rng.standard_normal((50, 64))]).astype(np.float32))]
    assert run(spark, rows, region_rows_=30) == plain(rows) == run(spark, rows)


def test_pairs_left_open_by_rounding_are_decided(spark):
    angle = np.arccos(0.98)
    rows = [(k, [float(np.cos(t)), float(np.sin(t))], 1) for k, t in enumerate(angle * np.array([0, 1 - 1e-6, 1 + 1e-6, 2 - 1e-6, 9, 10, 10.00001]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = np.array([r[1] for r in rows])
    near = x @ x.T >= 0.98
    reach = np.linalg.matrix_power(near.astype(int), len(x)) > 0
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in subspace.near_vectors(df).collect())
    assert got == [(k, int(near[k].sum()) - 1, int(np.flatnonzero(reach[k])[0])) for k in range(len(x))]
    assert near[0, 1] and not near[0, 2] and near[2, 3]


def test_blocks_hold_every_near_pair():
    """Each pair within the limit is within its share in some block; cells never part such a pair."""
    rng = np.random.default_rng(2)
    budget = subspace.Budget(64, 0.98, 16)
    x = subspace.unit_rows(rng.standard_normal((400, 64)))
    y = subspace.unit_rows(x + rng.standard_normal((400, 64)) * 0.2 / 8 * rng.uniform(0.5, 1, (400, 1)))
    cx, cy = (np.rint(v @ subspace.rotation(64) * subspace.SCALE).astype(np.int16) for v in (x, y))
    near = (x * y).sum(axis=1) >= 0.98
    assert near.sum() > 100
    parts = np.stack([((cx[:, budget.block(b)].astype(np.int64) - cy[:, budget.block(b)]) ** 2).sum(axis=1) for b in range(4)], axis=1)
    within = parts <= np.array(budget.shares)
    assert within[near].any(axis=1).all()
    for b in range(4):
        both = np.concatenate([cx, cy])
        row, cell, home = subspace.cells(both, budget, b, 4)
        seen = {}
        for r, c, h in zip(row.tolist(), cell.tolist(), home.tolist()):
            seen.setdefault(r, {})[c] = h
        for i in np.flatnonzero(within[:, b]).tolist():
            p, q = seen[i], seen[400 + i]
            assert sum(p[c] or q[c] for c in p.keys() & q.keys()) == 1


def test_query_runs(spark):
    from loanmart.llm import queries
    from tests.conftest import SF_SMALL
    assert queries.QUERIES["op12_subspace"](spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").count()
