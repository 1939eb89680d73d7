import numpy as np
import pytest

from nearfill.operators import neighbors


def rows_of(case, seed=7, d=40):
    rng = np.random.default_rng(seed)
    q, r = rng.normal(size=(700, d)), rng.normal(size=(5000, d))
    if case == "outlier":
        r[7, 3], q[2, 5] = 1e5, -4e4
    elif case == "shifted":
        q, r = q + 1e4, r + 1e4
    elif case == "ties":
        q, r = np.round(q), np.round(r)
        r[200:2400] = r[:2200]
    elif case in ("tiny", "huge"):
        q, r = (x * (1e-9 if case == "tiny" else 1e9) for x in (q, r))
    return q, r


def found(q, r, theta, metric, k=5):
    """Neighbours by ``_search``: a tenth of the cells is outside the masks, and some pairs take no part."""
    rng = np.random.default_rng(3)
    bit, mask = rng.integers(0, 30, len(r)), rng.integers(0, 2 ** 62, len(q)) | rng.integers(0, 2 ** 62, len(q)) | rng.integers(0, 2 ** 62, len(q))
    mine, theirs = np.arange(len(q)), np.arange(len(r)) % 900
    outside = lambda i, j, paired=False: theirs[j] == mine[i] if paired else theirs[j, None] == mine[None, i]
    i, j, dist = neighbors._search(q, theta, mask.astype(np.uint64), r, bit, np.arange(len(r))[::-1].copy(), outside, k, metric, 1.0)
    may = (mask[i] >> bit[j]) & 1
    assert may.all() and not (theirs[j] == mine[i]).any()
    return sorted(zip(i.tolist(), j.tolist(), dist.tolist()))


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
@pytest.mark.parametrize("case", ["plain", "outlier", "shifted", "ties", "tiny", "huge"])
def test_runs_of_references_find_what_single_cells_find(monkeypatch, metric, case):
    q, r = rows_of(case)
    whole = found(q, r, np.full(len(q), np.inf), metric)
    kth = np.zeros(len(q))
    np.maximum.at(kth, [i for i, _, _ in whole], [d for _, _, d in whole])
    near = found(q, r, neighbors._slack(kth, metric), metric)
    some = found(q, r, np.where(np.arange(len(q)) % 2, kth * 0.9, np.inf), metric)
    monkeypatch.setattr(neighbors, "_search_wide", lambda *_: None)
    assert whole == near == found(q, r, np.full(len(q), np.inf), metric)
    kept = {i for i in range(len(q)) if i % 2 == 0}
    old = found(q, r, np.where(np.arange(len(q)) % 2, kth * 0.9, np.inf), metric)
    inside = lambda rows: [x for x in rows if x[0] in kept or x[2] <= kth[x[0]] * 0.9]
    assert inside(some) == inside(old) and {i for i, _, _ in some if i in kept} == kept


@pytest.mark.parametrize("metric", ["manhattan", "chebyshev"])
def test_pairs_of_many_features_are_bounded_without_a_pass_over_each_feature(monkeypatch, metric):
    """With a theta no pair is bounded by steps of its features, one feature after the other, and few are added up."""
    q, r = rows_of("plain", d=64)
    whole = found(q, r, np.full(len(q), np.inf), metric)
    kth = np.zeros(len(q))
    np.maximum.at(kth, [i for i, _, _ in whole], [d for _, _, d in whole])
    met, exact = [], neighbors._pair_distances
    monkeypatch.setattr(neighbors, "_near_pairs", lambda *_: pytest.fail("bounded feature by feature"))
    monkeypatch.setattr(neighbors, "_pair_distances", lambda a, *rest: (met.append(len(a)), exact(a, *rest))[1])
    assert found(q, r, neighbors._slack(kth, metric), metric) == whole
    assert sum(met) < 0.02 * len(q) * len(r)
