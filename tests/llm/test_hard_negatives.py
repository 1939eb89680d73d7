"""Hard negatives against all scores in plain Python, the walk's bounds, and odd tables."""
import math

import numpy as np
import pytest

from nearfill.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v int, c1 int"


def plain(rows, scale=256, every=10, positives=5, negatives=5):
    """All scores as Python integers."""
    usual = {}
    good = [r for r in rows if None not in r and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    dim = max({len(r[1]) for r in good}, key=lambda d: sum(len(r[1]) == d for r in good), default=0)
    for vec_id, v, label in good:
        if len(v) == dim:
            row = (label, [math.floor(scale * x) for x in v])
            usual[vec_id] = min(usual.get(vec_id, row), row)
    out = set()
    for anchor, (label, v) in usual.items():
        if anchor % every:
            continue
        all_scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in usual.items() if i != anchor)
        for s, i, _ in [r for r in all_scores if r[2] == label][:positives]:
            inside = [r for r in all_scores if r[2] != label and -80 * s <= -100 * r[0] <= -100 * s]
            out.update((anchor, i, rank, j, -s, -t) for rank, (t, j, _) in enumerate(inside[:negatives], 1))
    return out


def mined(spark, rows, scale=256, every=10, **kw):
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    whole = hard_negatives.whole_rows(table, scale)
    got = [tuple(r) for r in hard_negatives.mine(whole, table.where(f"vec_id % {every} = 0"), **kw).collect()]
    assert len(set(got)) == len(got)
    return set(got)


def made(seed, n, dim, clusters=0, labels=4):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(clusters, 1), dim)) * (3 if clusters else 0)
    spread = 0.2 if clusters else 1.0
    x = centres[r.integers(0, len(centres), n)] + spread * r.normal(size=(n, dim))
    return [(int(i), [float(a) for a in v], int(y)) for i, v, y in zip(r.permutation(n * 2)[:n], x, r.integers(0, labels, n))]


@pytest.mark.parametrize("n, dim, clusters", [(400, 64, 0), (500, 8, 12), (300, 3, 5), (200, 1, 0), (6, 4, 0)])
def test_equals_all_scores(spark, monkeypatch, n, dim, clusters):
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 20)
    rows = made(n + dim, n, dim, clusters)
    assert mined(spark, rows, every=5) == plain(rows, every=5)


def test_hot_vector_and_small_blocks(spark, monkeypatch):
    """A third of the rows are one vector, over several blocks; ties go to the smaller id."""
    monkeypatch.setattr(hard_negatives, "FIRST_ROWS", 10)
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 32)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 4)
    rows = made(5, 300, 6, 4)
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(150)]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = made(9, 80, 4, 3)
    v = rows[0][1]
    rows += [(None, v, 1), (2001, None, 1), (2002, v, None), (2003, [1.0, None, 2.0, 3.0], 1), (2004, [math.nan] * 4, 1), (2005, [math.inf] * 4, 1),
             (2006, [], 1), (2007, [1.0], 1), rows[3], rows[3], (rows[4][0], [0.5] * 4, 2), (2010, [0.0] * 4, 1), (2020, [-x for x in v], 0)]
    assert mined(spark, rows) == plain(rows)
    one_label = [(i, [float(i), 1.0], 3) for i in range(40)]
    assert mined(spark, one_label) == plain(one_label) == set()
    assert mined(spark, [(1, None, None)]) == set()
    big = [(r[0], [x * 4.0e5 for x in r[1]], r[2]) for r in made(3, 60, 4)]
    big = [r for r in big if max(map(abs, r[1])) * 256 < 2**27 - 1]
    assert mined(spark, big) == plain(big)


def test_other_numbers(spark):
    rows = made(12, 200, 5, 3)
    got = mined(spark, rows, scale=16, positives=2, negatives=3)
    assert got == plain(rows, scale=16, positives=2, negatives=3)


def test_bounds_and_order_of_the_walk():
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 6)) * 256
    books = (hard_negatives._centres(x[:, :3], 8, r), hard_negatives._centres(x[:, 3:], 8, r))
    own = [hard_negatives._nearest(p, b) for p, b in zip((x[:, :3], x[:, 3:]), books)]
    far = [np.sqrt(((p - b[o]) ** 2).sum(axis=1)) for p, b, o in zip((x[:, :3], x[:, 3:]), books, own)]
    radii = tuple(np.array([f[o == c].max(initial=0) for c in range(8)]) for f, o in zip(far, own))
    cells = hard_negatives.Cells(books, radii, np.ones((8, 8), np.int64))
    for q in x[:20]:
        first, second, margin = cells.bounds(q)
        assert (first[own[0]] + second[own[1]] + margin >= x @ q).all()
        walked = list(hard_negatives.descend(first, second))
        assert len({(i, j) for _, i, j in walked}) == 64
        assert [b for b, _, _ in walked] == sorted((b for b, _, _ in walked), reverse=True)


def test_scores_are_exact():
    a, b = np.array([[2.0**26, -(2.0**26 - 1)]]), np.array([[2.0**26 + 1, 2.0**26], [1.0, 2.0]])
    assert hard_negatives.scores(a, b).tolist() == [[2**26 * (2**26 + 1) - (2**26 - 1) * 2**26, 2**26 - 2 * (2**26 - 1)]]
    assert "op13_hard_negatives" in queries.QUERIES and "op13_hard_negatives" in queries.ORACLE
