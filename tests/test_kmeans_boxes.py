import numpy as np
import pytest

from nearfill.operators import clustering, steps


def packed_chunks(x):
    x = x[:, clustering._neighbouring(x)]
    return [np.ascontiguousarray(x[:, at:at + clustering.CHUNK]) for at in range(0, x.shape[1], clustering.CHUNK)]


def test_rows_of_a_chunk_and_of_a_box_are_neighbours():
    rng = np.random.default_rng(1)
    for n in (0, 1, 31, 33, 8193, 40_001):
        x = rng.random((2, n))
        order = clustering._neighbouring(x)
        assert sorted(order.tolist()) == list(range(n))
    wide = [np.ptp(b, axis=1).max() for b in np.split(x[:, order[:40_000]], 1250, axis=1)]
    assert np.median(wide) < 0.1  # 1,250 boxes of a unit square
    assert max(np.ptp(c, axis=1).prod() for c in packed_chunks(x)) < 0.5


@pytest.mark.parametrize("case", ["plain", "grid", "same", "far"])
@pytest.mark.parametrize("k", [1, 2, 7])
def test_boxes_move_centres_as_single_rows_do(case, k):
    rng = np.random.default_rng(k)
    x = rng.normal(size=(3, 20_011))
    x = {"plain": x, "grid": np.round(x), "same": np.ones_like(x), "far": x + 1e7}[case]
    centres = np.stack([x[:, rng.integers(0, x.shape[1], k)].T for _ in range(4)])
    centres[1, -1] = centres[1, 0]  # ties go to the first
    chunks = packed_chunks(x)
    whole, rest = clustering._whole_boxes(chunks)
    assert whole[0].size + rest.shape[1] == x.shape[1] and rest.shape[1] < clustering.BOX_ROWS
    got = clustering._moved_boxes(whole, clustering._boxes_of(whole), centres) + clustering._moved(rest, centres)
    want = clustering._moved(x, centres)
    assert np.allclose(got, want, rtol=1e-9) and (got[:, :, 0] == want[:, :, 0]).all()


def test_a_pass_looks_at_the_rows_of_few_boxes(monkeypatch):
    """Away from the bisectors whole boxes move, so no pass over all rows is made for each centre."""
    rng = np.random.default_rng(2)
    x, centres = rng.random((3, 65_536)), rng.random((5, 3, 3))
    whole, _ = clustering._whole_boxes(packed_chunks(x))
    want = clustering._moved(x, centres)
    looked = []
    bincount = np.bincount
    monkeypatch.setattr(clustering, "_moved", lambda *_: pytest.fail("a pass over all rows"))
    monkeypatch.setattr(np, "bincount", lambda v, *a, **kw: (looked.append(len(v)), bincount(v, *a, **kw))[1])
    got = clustering._moved_boxes(whole, clustering._boxes_of(whole), centres)
    assert np.allclose(got, want) and sum(looked) / 4 < 0.4 * x.shape[1] * len(centres)


def test_draws_are_the_least_of_all_rows_however_few_are_weighed(spark):
    """Rows that cannot be drawn are left out before their distances; the drawn ones are those that all rows' weights give."""
    rng = np.random.default_rng(3)
    xs = rng.normal(size=(30_000, 2))
    df = spark.createDataFrame([(0, *map(float, x)) for x in xs], "_cls int, _x0 double, _x1 double")
    rows = steps.numbered(df.coalesce(1), "rows")
    packed, found = steps.table(clustering._packed(rows, ["_x0", "_x1"]), "packed"), rows.toPandas()
    number, x = found[steps.ROW].to_numpy(), found[["_x0", "_x1"]].to_numpy()
    for turn, centres in ((0, np.zeros((0, 2))), (1, xs[:1]), (2, xs[:7])):
        models = {(0, k, i): centres for k in (2, 3) for i in range(2)}
        got = clustering._drawn(packed, ["_x0", "_x1"], models, 42, turn)
        for t in models:
            wait = -np.log(clustering._draws(number, 42, *t, turn))
            if len(centres):
                wait = wait / np.maximum(clustering._nearest(x.T, centres)[1], 1e-300)
            want = x[np.argsort(wait)[:2 * t[1] if turn else 1]]
            assert np.array_equal(np.array(got[t]), want)


def test_passes_over_pickled_chunks_give_the_sums_of_the_packed_table(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(int(c), *map(float, x)) for c, x in zip(rng.integers(0, 3, 9000), rng.normal(size=(9000, 2)))], "_cls int, _x0 double, _x1 double")
    packed = steps.table(clustering._packed(steps.numbered(df, "rows"), ["_x0", "_x1"]), "packed")
    chunks, path = clustering._pickled(packed)
    models = {(c, k, 0): rng.normal(size=(k, 2)) for c in (0, 2) for k in (2, 5)}
    one, two = (clustering._sums(x, ["_x0", "_x1"], models, 9) for x in (packed, chunks))
    assert all(np.allclose(one[t], two[t]) for t in models) and clustering._costs(chunks, models, 9) == pytest.approx(clustering._costs(packed, models, 9))
    steps.discard_path(spark, path)
