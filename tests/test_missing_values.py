"""Rows with missing values are never lost without a word."""
import math

import numpy as np
import pandas as pd
import pytest

from nearfill.operators import classify, clustering, impute_kmeans, impute_knn, quantiles, sampling
from nearfill.plans import workflow


def frame(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % 2
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "y": y, "a": rng.normal(size=n) + 3 * y, "b": rng.normal(size=n)}))


def with_nulls(df, column, every):
    return df.selectExpr(*[f"CASE WHEN id % {every} <> 0 THEN {c} END AS {c}" if c == column else c for c in df.columns])


def test_rows_without_a_class_are_refused(spark):
    df = with_nulls(frame(spark), "y", 10)
    for call in (sampling.stratified_split, sampling.stratified_folds):
        with pytest.raises(ValueError, match="6 rows"):
            call(df, "y", ["id"])


def test_split_ranks_only_the_bucket_of_the_quota(spark):
    df = frame(spark)
    split = sampling.stratified_split(df, "y", ["id"], 0.2, 7)
    ranked = sampling.hash_rank(df, "y", ["id"], 7).toPandas()
    want = set(ranked[ranked._rank <= 24].id)
    assert {r.id for r in split.where("split = 'train'").collect()} == want and split.columns == [*df.columns, "split"]


def test_every_row_is_predicted_or_null(spark):
    df = frame(spark)
    model = classify.fit(df, "y", "id", n_neighbors=3)
    out = classify.prediction_table(model, with_nulls(df, "a", 10))
    rows = {r.id: r for r in out.collect()}
    assert len(rows) == 60 and all((rows[i].Prediction is None) == (i % 10 == 0) for i in rows)
    with pytest.raises(ValueError, match="6 rows"):
        classify.evaluate(model, with_nulls(df, "a", 10))
    with pytest.raises(ValueError, match="6 training rows"):
        classify.fit(with_nulls(df, "b", 10), "y", "id", n_neighbors=3)
    nan = df.selectExpr("id", "y", "CASE WHEN id = 5 THEN double('NaN') ELSE a END AS a", "b")
    assert classify.predict(model, nan).where("id = 5").first().prediction is None


def test_rows_without_a_key_of_their_own_are_all_predicted(spark):
    train = frame(spark)
    rows = [(1, 0.0, 0.1), (1, 3.0, 0.2), (None, 0.1, 0.3), (None, 3.2, 0.0), (2, 2.9, 0.5)]
    test = spark.createDataFrame([(i, int(a > 1), a, b) for i, a, b in rows], "id long, y long, a double, b double")
    model = classify.fit(train, "y", "id", n_neighbors=5)
    out = classify.prediction_table(model, test).collect()
    alone = {(r.a, r.b): classify.prediction_table(model, test.where(f"a = {r.a} AND b = {r.b}")).first() for r in out}
    assert sorted((r.id or 0, r.a) for r in out) == sorted((i or 0, a) for i, a, _ in rows)
    assert all((r.Prediction, r.Probability) == (alone[r.a, r.b].Prediction, alone[r.a, r.b].Probability) for r in out)
    assert classify.evaluate(model, test).first().tp >= 0
    with pytest.raises(ValueError, match="4 predictions for 5 rows"):
        classify.evaluate(model, test, predictions=classify.prediction_table(model, test.where("a > 0")))


def test_imputed_rows_without_a_key_of_their_own(spark):
    rows = [(i % 5 if i % 3 else None, i % 2, float(i % 4), float(i)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, y int, v double, w double")
    unique = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], "id long, y int, v double, w double")
    got = sorted((r.y, r.w, r.v) for r in impute_knn.fit_transform(df, "y", "id", ["v"]).collect())
    want = sorted((r.y, r.w, r.v) for r in impute_knn.fit_transform(unique, "y", "id", ["v"]).collect())
    assert len(got) == 80 and got == want and all(v for _, _, v in got)


def test_more_classes_than_columns(spark, monkeypatch):
    """Beyond the wide form votes are rows: the same predictions and shares."""
    rng = np.random.default_rng(4)
    y = np.arange(240) % 12
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(240), "y": y, "a": rng.normal(size=240) + y, "b": rng.normal(size=240)}))
    train, test = df.where("id < 180"), df.where("id >= 180")
    wide = {r.id: r for r in classify.predict(classify.fit(train, "y", "id", n_neighbors=5), test).collect()}
    monkeypatch.setattr(classify, "WIDE_CLASSES", 5)
    model = classify.fit(train, "y", "id", n_neighbors=5)
    assert model.classes is None
    for r in classify.predict(model, test).collect():
        assert r.prediction == wide[r.id].prediction and r.probability == pytest.approx(wide[r.id][f"proba_{r.prediction}"])
    for r in classify.predict_proba(model, test).collect():
        assert r.probability == pytest.approx(wide[r.id][f"proba_{r['class']}"])


def test_a_k_that_some_fold_cannot_supply_is_not_scored(spark):
    model = classify.fit(frame(spark, 16), "y", "id")
    assert max(model.k_score_map) == 11 and model.k <= 11  # folds of up to 4 rows leave 12 references


def test_features_are_selected_at_fit(spark):
    model = classify.fit(frame(spark, 120), "y", "id", n_neighbors=3, n_features=1)
    assert model.selected == ["a"]
    found = classify.summary(model).first()
    assert set(found.feature_importances) == {"a", "b"} and found.feature_importances["a"] > found.feature_importances["b"]


def test_a_column_without_another_feature_takes_the_global_median(spark):
    df = spark.createDataFrame([(i, i % 2, float(i % 5)) for i in range(40)], "id long, y int, v double")
    out = impute_knn.fit_transform(df, "y", "id", ["v"]).toPandas()
    assert (out.v != 0).all() and set(out.v[::5]) == {2.5}


def test_both_imputers_fill_rows_without_a_class_with_the_global_median(spark):
    rows = [(i, i % 2, float(i % 7), float(i)) for i in range(60)] + [(100, None, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "id long, y int, v double, w double")
    for fill in (lambda d: impute_knn.fit_transform(d, "y", "id", ["v"]),
                 lambda d: impute_kmeans.fit_transform(d, "y", "id", ["v"], n_clusters=2, n_init=1)):
        out = {r.id: r.v for r in fill(df).collect()}
        assert len(out) == 61 and all(v != 0 for v in out.values()) and out[100] == 3.0


@pytest.mark.parametrize("centres", [2, 302])
def test_rows_with_nan_have_no_nearest_centre(spark, centres):
    df = spark.createDataFrame([(1, 0.2), (2, math.nan), (3, None)], "id long, x double")
    got = {r.id: (r.cluster, r.d) for r in clustering.assign_nearest(df, ["x"], {None: [[float(i)] for i in range(centres)]}, dist_out="d").collect()}
    assert got[1][0] == 0 and got[1][1] == pytest.approx(0.2) and got[2] == got[3] == (None, None)


def test_clusters_are_fitted_with_missing_features(spark):
    df = with_nulls(frame(spark), "b", 9).selectExpr("*", "CAST(id % 4 AS DOUBLE) AS z")
    model = impute_kmeans.fit(df, "y", "id", ["z"], n_clusters=2, n_init=1)
    assert sum(sum(v) for v in model.search.counts.values()) == 60
    out = impute_kmeans.transform(model, df).collect()
    assert all(r.z for r in out) and sum(r.b is None for r in out) == 7


def test_many_clusters_are_not_cut_short(spark):
    df = spark.createDataFrame([(0, float(i % 40), float(i // 40)) for i in range(1000)], "_cls int, _x0 double, _x1 double")
    found = clustering.kmeans_search(df, [None], 2, {0: [400]}, n_init=1, max_iter=5)
    assert found.k[None] == 400


def test_medians_scan_without_shuffling_rows(spark):
    rows = [(i % 3 if i % 10 else None, float(i % 17), None if i % 4 else float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    got = {(r.g, r.column): r.median for r in quantiles.grouped_median(df, ["g"], ["a", "b"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "a", "b"]).dropna(subset=["g"])
    for c in ("a", "b"):
        for g, v in pdf.groupby("g")[c].median().items():
            assert got[g, c] == v
    whole = {r.column: r.median for r in quantiles.grouped_median(df, [], ["a", "b"]).collect()}
    assert whole == pd.DataFrame(rows, columns=["g", "a", "b"])[["a", "b"]].median().to_dict()


def test_settings_reach_the_classifier_and_a_global_imputer_runs(spark, tmp_path):
    df = frame(spark).selectExpr("*", "CAST(id % 4 AS DOUBLE) AS z")
    out = workflow.run(df, "y", "id", imputer="kmeans", impute_cols=["z"], class_aware=False, n_clusters=2, n_init=1,
                       classifier_args={"n_neighbors": 5, "metric": "manhattan"}, output=str(tmp_path), fmt="parquet")
    assert out["metrics"].first().n_neighbors == 5 and "clusters_per_class" not in out
    assert out["classifier_summary"].first().metric == "manhattan"
    assert spark.read.parquet(f"{tmp_path}/predictions").count() == 12


def test_fit_evaluate_write(spark, tmp_path):
    df = frame(spark)
    model, predictions, scores = classify.fit_evaluate_write(
        df.where("id < 45"), df.where("id >= 45"), "y", "id", str(tmp_path / "p"), n_neighbors=3)
    assert predictions.count() == 15 and scores.first().tp + scores.first().fn == 8
    assert spark.read.option("header", True).csv(str(tmp_path / "p")).count() == 15
