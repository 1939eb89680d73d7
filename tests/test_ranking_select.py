import numpy as np
import pandas as pd

from nearfill.operators import classify, ranking, select


def test_prefix_count_matches_sorted_order(spark):
    rng = np.random.default_rng(4)
    n = 2000
    pdf = pd.DataFrame({"p": rng.choice([0, 1], n, p=[0.9, 0.1]), "v": rng.integers(0, 40, n).astype(float),
                        "t": np.arange(n), "w": rng.integers(0, 3, n)})
    got = ranking.prefix_count(spark.createDataFrame(pdf), ["p"], "v", ["t"], weight="w", buckets=8).toPandas()
    for p, g in pdf.groupby("p"):
        g = g.sort_values(["v", "t"])
        exp = dict(zip(g.t, g.w.cumsum() - g.w))
        sub = got[got.p == p]
        assert all(exp[t] == b for t, b in zip(sub.t, sub._before))


def test_digamma_sql(spark):
    # psi(n) = H(n-1) - Euler's constant for integers
    vals = [1, 2, 3, 7, 50, 1000]
    exp = [sum(1.0 / i for i in range(1, v)) - select.EULER for v in vals]
    row = spark.range(1).selectExpr(*[f"{select.digamma_sql(str(v))} AS d{v}" for v in vals]).collect()[0]
    assert np.allclose([row[f"d{v}"] for v in vals], exp, atol=1e-12)


def brute_mi(x, y, k=3):
    """All pairs: psi(N) + mean psi(k_i) - mean psi(n_y) - mean psi(m_i)."""
    keep = np.array([(y == v).sum() > 1 for v in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        near = np.sort(np.abs(x[(y == y[i]) & (np.arange(len(x)) != i)] - x[i]))
        kk = min(k, len(near))
        r = near[kk - 1] * (1 - 1e-9)
        m = max(1, int(((x > x[i] - r) & (x < x[i] + r)).sum()))
        total += select.digamma(kk) - select.digamma(len(near) + 1) - select.digamma(m)
    return max(0.0, float(select.digamma(len(x)) + total / len(x)))


def test_mutual_information_over_many_ranges_equals_all_pairs(spark, monkeypatch):
    """Rare labels reach over many ranges; a label of one row takes no part."""
    rng = np.random.default_rng(8)
    n = 400
    y = np.where(np.arange(n) % 40 == 0, 9, rng.integers(0, 3, n))
    y[5], y[6], y[7] = 77, 78, 78
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "a": y % 3 + rng.normal(size=n), "b": rng.normal(size=n) ** 3})
    df = spark.createDataFrame(pdf)
    want = {f: brute_mi((pdf[f] / pdf[f].std(ddof=0)).to_numpy(), y) for f in ("a", "b")}
    for rows in (1000, 100, 11):
        monkeypatch.setattr(select, "RANGE_ROWS", rows)
        got = {r.feature: r.score for r in select.mutual_information(df, "y", "id", ["a", "b"]).collect()}
        assert all(abs(got[f] - want[f]) < 1e-9 for f in want), (rows, got, want)
    assert select.mutual_information(df.where("false"), "y", "id", ["a"]).collect()[0].score == 0


def test_mutual_information_ranks_informative_feature(spark):
    rng = np.random.default_rng(2)
    n = 600
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "good": y * 3 + rng.normal(size=n),
                        "noise": rng.normal(size=n)})
    sc = select.mutual_information(spark.createDataFrame(pdf), "y", "id", ["good", "noise"]).toPandas()
    s = dict(zip(sc.feature, sc.score))
    assert s["good"] > 0.3 and s["noise"] < 0.05
    assert select.top_features(spark.createDataFrame(sc), 1, ["noise", "good"]) == ["good"]
    m = classify.fit(spark.createDataFrame(pdf), "y", "id", n_neighbors=5, n_features=1)
    assert m.selected == ["good"]
