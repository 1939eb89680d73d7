import numpy as np
import pandas as pd
import pytest

from nearfill.operators import neighbors


def _brute(q, r, k, metric, p=3.0, groups=None, exclude_self=False):
    out = {}
    for i, qi in enumerate(q["id"]):
        X = r[[c for c in r.columns if c.startswith("f")]].to_numpy()
        x = q.loc[i, [c for c in q.columns if c.startswith("f")]].to_numpy(dtype=float)
        diff = np.abs(X - x)
        if metric == "euclidean":
            d = np.sqrt((diff ** 2).sum(1))
        elif metric == "manhattan":
            d = diff.sum(1)
        elif metric == "chebyshev":
            d = diff.max(1)
        elif metric == "minkowski":
            d = (diff ** p).sum(1) ** (1 / p)
        else:
            d = 1 - (X @ x) / (np.linalg.norm(X, axis=1) * np.linalg.norm(x))
        ok = np.ones(len(r), dtype=bool)
        if groups:
            ok &= r["g"].to_numpy() == q.loc[i, "g"]
        if exclude_self:
            ok &= r["id"].to_numpy() != qi
        idx = [j for j in np.lexsort((r["id"].to_numpy(), d)) if ok[j]][:k]
        out[qi] = [(int(r["id"][j]), float(d[j])) for j in idx]
    return out


def _data(n, d, seed, clustered=False):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    if clustered:
        X += rng.integers(0, 4, size=(n, 1)) * 5
    X = np.round(X, 2)  # ties
    pdf = pd.DataFrame(X, columns=[f"f{j}" for j in range(d)])
    pdf.insert(0, "id", np.arange(n))
    pdf["g"] = rng.integers(0, 3, n)
    return pdf


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski", "cosine"])
def test_knn_join_equals_brute_force(spark, metric):
    pdf = _data(400, 3, 5, clustered=True)
    df = spark.createDataFrame(pdf)
    feats = ["f0", "f1", "f2"]
    got = neighbors.knn_join(df, df, 4, feats, query_id="id", ref_id="id", metric=metric, p=3.0,
                             exclude_self=True).toPandas()
    exp = _brute(pdf, pdf, 4, metric, exclude_self=True)
    for qi, grp in got.groupby("id"):
        g = grp.sort_values("rank")
        assert [int(x) for x in g.neighbor_id] == [e[0] for e in exp[qi]]
        assert np.allclose(g.distance.to_numpy(), [e[1] for e in exp[qi]])
    assert got.id.nunique() == len(pdf)


def test_knn_join_groups_small_blocks_and_wide(spark):
    pdf = _data(300, 20, 9)
    q, r = pdf.iloc[:60].reset_index(drop=True), pdf.iloc[60:].reset_index(drop=True)
    feats = [f"f{j}" for j in range(20)]
    got = neighbors.knn_join(spark.createDataFrame(q), spark.createDataFrame(r), 5, feats, query_id="id",
                             ref_id="id", group=["g"], block_rows=7, n_pivots=16).toPandas()
    exp = _brute(q, r, 5, "euclidean", groups=True)
    for qi, grp in got.groupby("id"):
        assert [int(x) for x in grp.sort_values("rank").neighbor_id] == [e[0] for e in exp[qi]]


def test_cosine_of_zero_vectors(spark):
    """A zero vector is at distance 1 from everything."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4))
    x[::7] = 0
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(300), **{f"f{j}": x[:, j] for j in range(4)}}))
    got = neighbors.knn_join(df, df, 6, [f"f{j}" for j in range(4)], query_id="id", ref_id="id", metric="cosine", exclude_self=True).toPandas()
    norm = np.sqrt((x * x).sum(1))
    unit = np.divide(x, norm[:, None], out=np.zeros_like(x), where=norm[:, None] > 0)
    for i, g in got.groupby("id"):
        d = 1 - unit @ unit[i]
        d[i] = np.inf
        assert np.allclose(np.sort(g.distance), np.sort(d)[:6])


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski", "cosine"])
def test_many_dimensions_and_super_cells(spark, metric):
    """More cells than a super-cell holds, correlated features, all bounds at work."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(900, 3)) @ rng.normal(size=(3, 24)) + 0.05 * rng.normal(size=(900, 24))
    pdf = pd.DataFrame(base, columns=[f"f{j}" for j in range(24)])
    pdf.insert(0, "id", np.arange(900))
    q = pdf.iloc[:50].reset_index(drop=True)
    got = neighbors.knn_join(spark.createDataFrame(q), spark.createDataFrame(pdf), 4, [f"f{j}" for j in range(24)], query_id="id",
                             ref_id="id", metric=metric, p=3.0, n_pivots=150, block_rows=100, exclude_self=True).toPandas()
    exp = _brute(q, pdf, 4, metric, exclude_self=True)
    for qi, grp in got.groupby("id"):
        assert [int(x) for x in grp.sort_values("rank").neighbor_id] == [e[0] for e in exp[qi]]
    assert got.id.nunique() == 50


def test_knn_join_fewer_refs_than_k(spark):
    pdf = _data(6, 2, 1)
    df = spark.createDataFrame(pdf)
    got = neighbors.knn_join(df, df, 10, ["f0", "f1"], query_id="id", ref_id="id").toPandas()
    assert (got.groupby("id").size() == 6).all()


def test_weighted_vote_zero_distance_and_ties(spark):
    nb = pd.DataFrame({"q": [1, 1, 1, 2, 2], "distance": [0.0, 0.0, 1.0, 1.0, 1.0], "lab": [1, 0, 0, 1, 0]})
    v = neighbors.weighted_vote(spark.createDataFrame(nb), "q", "lab", [0, 1]).toPandas().set_index("q")
    # q1: only the zero-distance neighbours count, equally → tie → first class
    assert v.loc[1, "prediction"] == 0 and v.loc[1, "proba_1"] == pytest.approx(0.5)
    assert v.loc[2, "prediction"] == 0 and v.loc[2, "proba_0"] == pytest.approx(0.5)


def test_uniform_votes_many_k(spark):
    nb = pd.DataFrame({"q": [1] * 5 + [2] * 2, "rank": [1, 2, 3, 4, 5, 1, 2], "lab": [1, 0, 0, 1, 1, 5, 4]})
    v = neighbors.uniform_votes(spark.createDataFrame(nb), "q", "lab", [1, 3, 5]).toPandas()
    assert dict(zip(v.k[v.q == 1], v.prediction[v.q == 1])) == {1: 1, 3: 0, 5: 1}
    assert dict(zip(v.k[v.q == 2], v.prediction[v.q == 2])) == {1: 5}  # two neighbours cannot vote for k = 3


def test_votes_in_long_form_equal_the_wide_ones(spark):
    rng = np.random.default_rng(3)
    nb = pd.DataFrame({"q": np.repeat(np.arange(80), 6), "distance": rng.integers(0, 4, 480).astype(float), "lab": rng.integers(0, 5, 480)})
    df = spark.createDataFrame(nb)
    wide = neighbors.weighted_vote(df, "q", "lab", list(range(5))).toPandas().set_index("q")
    shares = neighbors.vote_shares(df, "q", "lab")
    top = neighbors.top_share(shares, "q").toPandas().set_index("q")
    assert (top.prediction.sort_index() == wide.prediction.sort_index()).all()
    for r in shares.collect():
        assert r.share == pytest.approx(wide.loc[r.q, f"proba_{r['class']}"])


def test_repeated_and_null_ids_keep_their_rows(spark):
    """Every query row has its own neighbours; a NULL id is nobody's copy."""
    rows = [(1, 0.0), (1, 9.0), (None, 5.0), (None, 5.1), (2, 3.0)]
    q = spark.createDataFrame(rows, "id int, x double")
    r = spark.createDataFrame([(7, 0.1), (7, 0.2), (None, 5.0), (8, 9.1), (1, 3.0)], "id int, x double")
    got = neighbors.knn_join(q, r, 2, ["x"], query_id="id", ref_id="id", query_carry=["x"], ref_carry=["x"], exclude_self=True).toPandas()
    assert got.query_row.nunique() == 5 and (got.groupby("query_row").size() == 2).all()
    near = {x: sorted(g.nb_x) for x, g in got.groupby("x")}
    assert near == {0.0: [0.1, 0.2], 9.0: [5.0, 9.1], 5.0: [3.0, 5.0], 5.1: [3.0, 5.0], 3.0: [3.0, 5.0]}


def test_unknown_metric(spark):
    df = spark.createDataFrame(_data(10, 2, 1))
    with pytest.raises(ValueError):
        neighbors.knn_join(df, df, 2, ["f0", "f1"], query_id="id", ref_id="id", metric="hamming")


def test_copies_of_a_row_do_not_grow_with_the_table(spark):
    """Blocks hold about as many references at every size; few of them meet a query with few features."""
    for n in (3_000, 30_000, 300_000):
        run, place = neighbors._runs(np.full(min(n // 128, neighbors.MAX_PIVOTS), 128), 2048)
        held = np.bincount(run) * 128
        assert place.max() < neighbors.MASK_CELLS and held.min() >= 1024 and held.max() <= 2 * 2048
    run, place = neighbors._runs(np.array([0] * 200 + [5000] + [1] * 100), 1000)
    assert place.max() == neighbors.MASK_CELLS - 1 and (np.diff(run) >= 0).all() and (np.bincount(run) > 0).all()


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "chebyshev", "minkowski", "cosine"])
@pytest.mark.parametrize("k,d", [(3, 2), (40, 3), (3, 12)])
def test_search_of_a_block_equals_brute_force_and_holds_few_pairs(monkeypatch, metric, k, d):
    rng = np.random.default_rng(d + k)
    q, r = rng.normal(size=(300, d)) * 100, rng.normal(size=(5000, d)) * 100
    if metric == "cosine":
        q, r = (x / np.linalg.norm(x, axis=1)[:, None] for x in (q, r))
    seen, best_of = [], neighbors._best_of
    monkeypatch.setattr(neighbors, "_best_of", lambda i, *a: (seen.append(len(i)), best_of(i, *a))[1])
    bit = rng.integers(0, 4, 5000)
    mask = rng.integers(1, 16, 300).astype(np.uint64)
    i, j, dist = neighbors._search(q, np.full(300, np.inf), mask, r, bit, np.arange(5000), lambda *_: None, k, metric, 3.0)
    assert max(seen) <= 8 * k * 300
    for x in range(300):
        may = np.flatnonzero(mask[x] >> bit.astype(np.uint64) & np.uint64(1))
        exact = neighbors._pair_distances(np.repeat(q[x:x + 1], len(may), 0), r[may], metric, 3.0)
        by = np.lexsort((may, exact))[:k]
        got = np.lexsort((j[i == x], dist[i == x]))
        assert j[i == x][got].tolist() == may[by].tolist() and (dist[i == x][got] == exact[by]).all()


def test_votes_sort_a_bounded_number_of_rows_in_a_task(spark):
    """Partitions of neighbours grow in number with the rows, not in size; a vote for many k copies no row."""
    df = spark.range(10).selectExpr("id AS q", "1 AS rank", "1.0D AS distance", "id % 2 AS lab")
    for rows in (1_000, 5_000_000, 50_000_000):
        parts = neighbors._dealt(df, "q", rows).rdd.getNumPartitions()
        assert rows / parts <= max(neighbors.SORTED_NEIGHBORS[0], 1_000)
    plan = neighbors.uniform_votes(df, "q", "lab", range(3, 31, 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.index("Generate") < plan.index("Aggregate")  # rows are multiplied last


def test_uniform_votes_equal_plain_counts(spark):
    rng = np.random.default_rng(5)
    nb = pd.DataFrame({"q": np.repeat(np.arange(60), 9), "rank": np.tile(np.arange(1, 10), 60), "lab": rng.integers(0, 4, 540), "fold": np.repeat(np.arange(60) % 3, 9)})
    df = spark.createDataFrame(nb).selectExpr("q", "rank", "nullif(lab, 3) AS lab", "fold")
    got = neighbors.uniform_votes(df, "q", "lab", [7, 2, 11, 4], carry=["fold"]).collect()
    assert len(got) == 180 and {r.k for r in got} == {2, 4, 7}
    for r in got:
        some = nb[(nb.q == r.q) & (nb["rank"] <= r.k)].lab.replace(3, -1)  # NULL is the first class
        assert (-1 if r.prediction is None else r.prediction) == some.value_counts().sort_index().idxmax() and r.fold == r.q % 3


@pytest.mark.parametrize("metric,p", [("manhattan", 1.0), ("chebyshev", 1.0), ("minkowski", 3.0), ("minkowski", 2.5), ("minkowski", 7.0)])
@pytest.mark.parametrize("case", ["plain", "outlier", "shifted", "ties", "tiny", "huge"])
def test_cheap_bounds_leave_few_pairs_and_lose_none(metric, p, case):
    rng = np.random.default_rng(11)
    q, r = rng.normal(size=(90, 40)), rng.normal(size=(1500, 40))
    if case == "outlier":
        r[7, 3], q[2, 5] = 1e5, -4e4
    elif case == "shifted":
        q, r = q + 1e4, r + 1e4
    elif case == "ties":
        q, r = np.round(q), np.round(r)
        r[200:400] = r[:200]
    elif case in ("tiny", "huge"):
        q, r = (x * (1e-9 if case == "tiny" else 1e9) for x in (q, r))
    exact = neighbors._pair_distances(np.repeat(q, len(r), 0), np.tile(r, (len(q), 1)), metric, p).reshape(len(q), -1)
    out = rng.random((len(r), len(q))) < 0.1
    exact[out.T] = np.inf
    kth = np.sort(exact, axis=1)[:, 4]
    for theta in (np.full(len(q), np.inf), neighbors._slack(kth, metric), kth / 2):
        i, j, dist = neighbors._near_pairs(q, r, out, theta, 5, metric, p)
        assert not out[j, i].any() and (dist == exact[i, j]).all()
        got = {x: set(j[i == x]) for x in range(len(q))}
        for x in range(len(q)):
            need = np.flatnonzero(exact[x] <= min(theta[x], kth[x]))
            assert set(need) <= got[x]
    if case == "plain" and p <= 4:  # most pairs are never added up in single precision
        assert neighbors._few_pairs(q, r, out, neighbors._slack(kth, metric), 5, metric, p) is not None


@pytest.mark.parametrize("metric,p", [("euclidean", 2.0), ("manhattan", 2.0), ("chebyshev", 2.0), ("minkowski", 3.0)])
def test_boxes_of_rows_ask_few_pivots_and_lose_none(metric, p):
    """With few features a row meets a small part of the pivots, and among them its nearest and every cell within reach."""
    from nearfill.operators import neighbors as nb
    rng = np.random.default_rng(6)
    x, pivots = np.column_stack([rng.integers(0, 25, 6000), rng.normal(size=6000) * 9]), rng.normal(size=(800, 2)) * [7, 9] + [12, 0]
    theta, rmax = rng.random(6000), rng.random(800)
    whole = nb._np_dist(x, pivots, metric, p)
    asked, seen = 0, np.zeros(len(x), int)
    for rows, some in nb._pivots_near(x, pivots, metric, p, theta, rmax):
        seen[rows] += 1
        asked += len(rows) * len(some)
        assert np.isin(whole[rows].argmin(1), some).all()
        reach = whole[rows] - rmax <= theta[rows, None]
        assert np.isin(np.flatnonzero(reach.any(axis=0)), some).all()
    assert (seen == 1).all() and asked < whole.size / 4


def test_few_bytes_are_dealt_over_all_cores(spark):
    """A table of many narrow rows in one file is not searched in one task."""
    from nearfill.operators import steps
    table = steps.table(spark.range(100_000).coalesce(1), "narrow")
    cores = spark.sparkContext.defaultParallelism
    assert table.rdd.getNumPartitions() < cores <= steps.spread(table, 100_000).rdd.getNumPartitions()
    assert steps.parts(spark, 100) == 1 and steps.parts(spark, 10_000_000) >= 50
