import inspect

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nearfill.operators import clustering, impute_kmeans, impute_knn


def _blobs(n=240, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 3, n)
    X = rng.normal(size=(n, 2)) + np.array([[0, 0], [6, 0], [0, 6]])[c]
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "a": X[:, 0] + 20, "b": X[:, 1] + 20,
                        "z": rng.integers(1, 50, n).astype(float)})
    pdf.loc[rng.random(n) < 0.15, "z"] = 0.0
    return pdf


def test_silhouette_matches_mllib(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler
    pdf = _blobs()
    pdf["cl"] = ((pdf.a > 23).astype(int) + 2 * (pdf.b > 23).astype(int))
    df = spark.createDataFrame(pdf)
    ours = clustering.silhouette(df, ["a", "b"], "cl").collect()[0][0]
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ref = ClusteringEvaluator(predictionCol="cl", distanceMeasure="squaredEuclidean").evaluate(vec)
    assert ours == pytest.approx(ref, abs=1e-9)


def test_assign_nearest_matches_numpy(spark):
    pdf = _blobs()
    centres = {None: [[20.0, 20.0], [26.0, 20.0], [20.0, 26.0]]}
    got = clustering.assign_nearest(spark.createDataFrame(pdf), ["a", "b"], centres).toPandas().sort_values("id")
    C = np.array(centres[None])
    exp = ((pdf[["a", "b"]].to_numpy()[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
    assert got.cluster.tolist() == exp.tolist()


def test_kmeans_search_inertia_falls_with_k(spark):
    pdf = _blobs()
    df = spark.createDataFrame(pdf).select(F.lit(0).alias("_cls"), F.col("id").alias("_key"),
                                           F.col("a").alias("_x0"), F.col("b").alias("_x1"))
    s = clustering.kmeans_search(df, [None], 2, {0: [2, 3, 4, 5]}, n_init=3)
    inert = {k: i for _, k, _, i, _ in s.scores}
    assert inert[2] >= inert[3] >= inert[4] >= inert[5]
    assert s.k[None] == 3  # three blobs


def test_kmeans_imputer_properties(spark):
    pdf = _blobs()
    df = spark.createDataFrame(pdf)
    m = impute_kmeans.fit(df, "y", "id", ["z"], n_init=2)
    out = impute_kmeans.transform(m, df).toPandas().sort_values("id")
    src = pdf.sort_values("id")
    keep = src.z.to_numpy() != 0
    assert np.array_equal(out.z.to_numpy()[keep], src.z.to_numpy()[keep])  # real values never change
    assert (out.z.to_numpy() != 0).all()  # no sentinel left
    assert out.dtypes["z"] == np.float64
    sizes = m.sizes.toPandas()
    assert sizes.groupby("y")["count"].sum().to_dict() == src.groupby("y").size().to_dict()


def test_kmeans_imputer_unseen_class_and_missing_target(spark):
    pdf = _blobs()
    df = spark.createDataFrame(pdf)
    m = impute_kmeans.fit(df, "y", "id", ["z"], n_clusters=2, n_init=1)
    new = spark.createDataFrame(pd.DataFrame({"id": [1000], "y": [7], "a": [20.0], "b": [20.0], "z": [0.0]}))
    got = impute_kmeans.transform(m, new).collect()[0]["z"]
    assert got == pytest.approx(pdf.z[pdf.z != 0].median())
    with pytest.raises(ValueError):
        impute_kmeans.transform(m, df.drop("y"))


def test_kmeans_imputer_global_model(spark):
    pdf = _blobs()
    df = spark.createDataFrame(pdf)
    m = impute_kmeans.fit(df, "y", "id", ["z"], class_aware=False, n_clusters=3, n_init=2)
    out = impute_kmeans.transform(m, df).toPandas()
    assert (out.z != 0).all()
    assert impute_kmeans.summary(m).collect()[0]["n_clusters"] == "3"


def _knn_impute_numpy(pdf, cols, feats, k):
    """Straight transcription of the documented algorithm for a check."""
    data = pdf.copy()
    gm = {c: data.loc[data[c] != 0, c].median() for c in cols}
    out = []
    for y, grp in data.groupby("y"):
        g = grp.copy()
        filled = g.copy()
        for c in cols:
            med = g.loc[g[c] != 0, c].median()
            filled[c] = g[c].replace(0, med if not np.isnan(med) else gm[c])
        mu = filled[feats].mean()
        sd = filled[feats].std(ddof=0).replace(0, 1)
        if len(g) < k:
            for c in cols:
                g.loc[g[c] == 0, c] = gm[c]
            out.append(g)
            continue
        for c in cols:
            zero = g[g[c] == 0]
            don = g[g[c] != 0]
            if len(zero) == 0:
                continue
            if len(don) < k:
                g.loc[zero.index, c] = gm[c]
                continue
            others = [f for f in feats if f != c]
            D = ((don[feats] - mu) / sd)[others].to_numpy()
            for idx, row in zero.iterrows():
                qv = row[feats].copy()
                for f in feats:
                    if f in cols and qv[f] == 0:
                        qv[f] = gm[f]
                qz = ((qv - mu) / sd)[others].to_numpy(dtype=float)
                d = np.sqrt(((D - qz) ** 2).sum(1))
                order = np.lexsort((don["id"].to_numpy(), d))[:k]
                w = 1 / (d[order] + 1e-10)
                g.loc[idx, c] = float((w * don[c].to_numpy()[order]).sum() / w.sum())
        out.append(g)
    return pd.concat(out).sort_values("id")


def test_knn_imputer_matches_numpy(spark):
    rng = np.random.default_rng(11)
    n = 150
    pdf = pd.DataFrame({"id": np.arange(n), "y": rng.integers(0, 2, n),
                        "p": rng.normal(5, 2, n).round(2), "q": rng.normal(50, 10, n).round(1),
                        "r": rng.normal(0, 1, n).round(3)})
    pdf.loc[rng.random(n) < 0.2, "p"] = 0.0
    pdf.loc[rng.random(n) < 0.2, "q"] = 0.0
    df = spark.createDataFrame(pdf)
    m = impute_knn.fit(df, "y", "id", ["p", "q"], n_neighbors=4)
    got = impute_knn.transform(m, df).toPandas().sort_values("id")
    exp = _knn_impute_numpy(pdf, ["p", "q"], ["p", "q", "r"], 4)
    assert np.allclose(got.p.to_numpy(), exp.p.to_numpy(), atol=1e-9)
    assert np.allclose(got.q.to_numpy(), exp.q.to_numpy(), atol=1e-9)


def test_knn_imputer_small_class_fallback(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3, 4, 5], "y": [0, 0, 0, 1, 1], "p": [0.0, 2.0, 4.0, 0.0, 8.0],
                        "r": [1.0, 2.0, 3.0, 4.0, 5.0]})
    df = spark.createDataFrame(pdf)
    m = impute_knn.fit(df, "y", "id", ["p"], n_neighbors=3)
    got = impute_knn.transform(m, df).toPandas().set_index("id")
    assert got.loc[4, "p"] == 4.0  # class 1 has 2 < k rows → global median of non-zero p
    assert got.loc[1, "p"] == 4.0  # class 0 has 2 donors < k → global median


def test_more_restarts_never_raise_the_inertia_and_ten_are_the_default(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 4, (9, 2))  # uneven and overlapping
    xs = np.concatenate([rng.normal(c, 0.8, (n, 2)) for c, n in zip(centres, (120, 60, 30, 15, 10, 8, 6, 5, 4))])
    df = spark.createDataFrame([(0, float(a), float(b)) for a, b in xs], "_cls int, _x0 double, _x1 double").persist()
    found = [clustering.kmeans_search(df, [None], 2, {0: [8]}, **kw).inertia[None] for kw in ({"n_init": 1}, {"n_init": 3}, {"n_init": 10}, {})]
    assert found[0] >= found[1] >= found[2] == found[3]
    for fn in (clustering.kmeans_search, impute_kmeans.fit):
        assert inspect.signature(fn).parameters["n_init"].default == 10
    df.unpersist()
