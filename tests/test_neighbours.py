"""Places of the least entries: the same as from whole rows, without ordering whole rows."""

import numpy as np
import pytest

from tillwise.operators import neighbours


@pytest.mark.parametrize("kind", ["plain", "ties", "equal", "infinite", "missing", "large", "narrow"])
@pytest.mark.parametrize("n", [1, 5])
def test_least_places_are_those_of_whole_rows(kind, n):
    random = np.random.default_rng(n)
    costs = random.random((40, 12 if kind == "narrow" else 900))
    if kind == "ties":
        costs = random.integers(0, 200, costs.shape) + random.uniform(-4e-10, 4e-10, costs.shape)
    elif kind == "equal":
        costs[:] = 2.0
    elif kind == "infinite":
        costs[random.random(costs.shape) < 0.99] = np.inf
    elif kind == "missing":
        costs[random.random(costs.shape) < 0.9] = np.nan
        costs[3] = np.nan
    elif kind == "large":
        costs = np.round(costs * 50) * 1e6 + 1e-3
    want = np.nonzero(neighbours.n_least(costs, n))
    got = neighbours.least_places(costs, n)
    assert np.array_equal(want[0], got[0]) and np.array_equal(want[1], got[1])


def test_wide_rows_are_not_ordered_whole(monkeypatch):
    def whole(*_):
        raise AssertionError("whole rows")

    monkeypatch.setattr(neighbours, "n_least", whole)
    costs = np.random.default_rng(0).random((30, 4000))
    at, near = neighbours.least_places(costs, 5)
    assert np.array_equal(at, np.repeat(np.arange(30), 5))
    assert np.array_equal(near.reshape(30, 5), np.sort(np.argsort(costs, axis=1)[:, :5], axis=1))


@pytest.mark.parametrize("kind", ["plain", "ties", "far", "equal"])
@pytest.mark.parametrize("skip", [True, False])
def test_cells_find_what_all_pairs_find(spark, monkeypatch, kind, skip):
    """Rows that meet only some cells of the pool have the same neighbours, also if they tie, repeat or lie far from the pool."""
    monkeypatch.setattr(neighbours, "LEAF", 8)
    monkeypatch.setattr(neighbours, "ROW_BLOCK", 50)
    random = np.random.default_rng(3)
    x = random.normal(size=(400, 3))
    if kind == "ties":
        x = random.integers(0, 4, x.shape).astype(float)
    elif kind == "far":
        x[:20] *= 1000
    elif kind == "equal":
        x[100:] = [1.0, 2.0, 0.0]
    y = x if skip else np.concatenate([x[::7], random.normal(size=(60, 3)) * 3])
    keys = [f"k{i:03d}" for i in range(400)]
    own = keys if skip else [f"k{i:03d}" for i in range(len(y))]
    pool = spark.createDataFrame([(k, v.tolist(), int(k[1:]) % 3) for k, v in zip(keys, x)], "id STRING, x ARRAY<DOUBLE>, label INT")
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in zip(own, y)], "id STRING, x ARRAY<DOUBLE>").repartition(3)
    met = []
    meet = neighbours._meet
    monkeypatch.setattr(neighbours, "_meet", lambda rows, *rest: met.append(rows) or meet(rows, *rest))
    got = neighbours.nearest(rows, pool.repartition(5), 3, "id", "x", "label", skip_self=skip, block=40).collect()
    gaps = np.round(((y[:, None] - x[None]) ** 2).sum(axis=2), 9)
    if skip:
        np.fill_diagonal(gaps, np.inf)
    order = np.argsort(gaps, axis=1, kind="stable")[:, :3]
    want = {(own[i], j + 1, keys[order[i, j]], int(order[i, j]) % 3) for i in range(len(y)) for j in range(3)}
    assert {(r.id, r["rank"], r.near_key, r.near_label) for r in got} == want and len(got) == 3 * len(y)
    if kind == "plain":
        # ten cells and more, of which a row meets few: what grows is the number of rows, not that of pairs of blocks
        assert len(met) == 2 and met[1].count() < 5 * len(y)
