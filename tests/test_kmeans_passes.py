import numpy as np
import pytest

from nearfill.operators import clustering


def test_all_models_of_a_search_share_their_passes(spark, monkeypatch):
    """Passes serve all models at a time (twelve fits of their own would take hundreds); every model ends where Lloyd's iteration does."""
    rng = np.random.default_rng(4)
    xs, cls = rng.normal(size=(600, 2)), np.arange(600) % 3
    df = spark.createDataFrame([(int(c), float(a), float(b)) for c, (a, b) in zip(cls, xs)], "_cls int, _x0 double, _x1 double")
    passes, sums = [], clustering._sums
    monkeypatch.setattr(clustering, "_sums", lambda rows, xcols, models, parts: (passes.append(dict(models)), sums(rows, xcols, models, parts))[1])
    found = clustering.kmeans_search(df, ["a", "b", "c"], 2, {c: [2, 3] for c in range(3)}, n_init=2)
    assert len(passes[0]) == 12 and len(passes) < 12 * 4
    assert all(set(later) <= set(passes[0]) for later in passes[1:])
    for i, c in enumerate("abc"):
        centres, x = np.array(found.centres[c]), xs[cls == i]
        d2 = ((x[:, None] - centres[None]) ** 2).sum(-1)
        assert found.inertia[c] == pytest.approx(d2.min(1).sum())
        means = np.array([x[d2.argmin(1) == j].mean(0) for j in range(len(centres))])
        assert np.allclose(means, centres, atol=1e-3) and sum(found.counts[c]) == 200


def test_sums_of_many_rows_are_added_up_by_spark(spark, monkeypatch):
    df = spark.createDataFrame([(0, float(i % 10 // 5 * 50 + i % 5)) for i in range(400)], "_cls int, _x0 double")
    few = clustering.kmeans_search(df, [None], 1, {0: [2]}, n_init=2)
    monkeypatch.setattr(clustering, "FETCHED_ROWS", 0)
    monkeypatch.setattr(clustering, "FIT_ROWS", 50)
    many = clustering.kmeans_search(df, [None], 1, {0: [2]}, n_init=2)
    assert sorted(few.centres[None]) == sorted(many.centres[None]) == [[2.0], [52.0]]
    assert few.inertia == many.inertia == {None: pytest.approx(800.0)}


def test_a_pass_reads_packed_rows_and_moves_models_together(spark):
    """Some thousands of rows are one row of bytes for a pass, and the models that are moved by one product end where each one alone does."""
    from nearfill.operators import steps
    rng = np.random.default_rng(5)
    xs, cls = rng.normal(size=(20_000, 3)).round(1), np.arange(20_000) % 2
    df = spark.createDataFrame([(int(c), *map(float, x)) for c, x in zip(cls, xs)], "_cls int, _x0 double, _x1 double, _x2 double")
    xcols = ["_x0", "_x1", "_x2"]
    packed = steps.table(clustering._packed(steps.numbered(df.coalesce(1), "rows"), xcols), "packed")
    assert packed.count() == 4
    models = {(c, k, i): rng.normal(size=(k, 3)) + c for c in (0, 1) for k in (1, 2, 7) for i in range(3)}
    sums, costs = clustering._sums(packed, xcols, models, 1), clustering._costs(packed, models, 1)
    for t, centres in models.items():
        x = xs[cls == t[0]]
        own, d2 = clustering._nearest(x.T, centres)
        assert np.allclose(sums[t], np.column_stack([np.bincount(own, w, len(centres)) for w in (None, *x.T)]))
        assert costs[t] == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(-1).min(1).sum()) == pytest.approx(d2.sum())


def test_ties_and_far_features_take_the_first_nearest_centre():
    x = np.array([[1e9, 1e9 + 1, 1e9 + 2, 1e9 + 3]])
    same = np.array([[[1e9], [1e9 + 2], [1e9 + 2]], [[1e9 + 3], [1e9 + 1], [1e9]]])
    found = clustering._moved(x, same)
    assert found[0, :, 0].tolist() in ([2.0, 2.0, 0.0], [1.0, 3.0, 0.0]) and found[1, 0, 0] + found[1, 1, 0] + found[1, 2, 0] == 4
    assert found[0, 2, 0] == 0
