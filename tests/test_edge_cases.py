import numpy as np
import pandas as pd
import pytest

from nearfill.operators import classify, impute_kmeans, neighbors, scaling, stats


def test_empty_reference_side(spark):
    df = spark.createDataFrame(pd.DataFrame({"id": [1, 2], "a": [1.0, 2.0]}))
    empty = df.where("id < 0")
    assert neighbors.knn_join(df, empty, 3, ["a"], query_id="id", ref_id="id").count() == 0
    assert neighbors.knn_join(empty, df, 3, ["a"], query_id="id", ref_id="id").count() == 0


def test_null_features_take_no_part(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3, 4], "a": [1.0, None, 3.0, 4.0], "b": [0.0, 0.0, 0.0, 1.0]})
    df = spark.createDataFrame(pdf)
    nb = neighbors.knn_join(df, df, 5, ["a", "b"], query_id="id", ref_id="id").toPandas()
    assert 2 not in set(nb.id) and 2 not in set(nb.neighbor_id)
    assert (nb.groupby("id").size() == 3).all()


def test_duplicate_rows_zero_distance_vote(spark):
    # the query duplicates a training row of class 1; that neighbour alone decides
    train = spark.createDataFrame(pd.DataFrame({"id": [1, 2, 3, 4], "y": [1, 0, 0, 0],
                                                "a": [5.0, 5.1, 4.9, 5.2], "b": [1.0, 1.0, 1.0, 1.0]}))
    m = classify.fit(train, "y", "id", n_neighbors=3)
    test = spark.createDataFrame(pd.DataFrame({"id": [10], "y": [1], "a": [5.0], "b": [1.0]}))
    row = classify.predict(m, test).collect()[0]
    assert row.prediction == 1 and row.proba_1 == pytest.approx(1.0)


def test_constant_feature_scaler(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [2.0, 2.0, 2.0]}))
    sc = scaling.fit_scaler(df, ["a"]).collect()[0]
    assert sc.scale == 1.0 and sc.mean == 2.0


def test_all_zero_impute_column(spark):
    rng = np.random.default_rng(1)
    n = 60
    pdf = pd.DataFrame({"id": np.arange(n), "y": rng.integers(0, 2, n), "a": rng.normal(size=n),
                        "z": np.zeros(n)})
    df = spark.createDataFrame(pdf)
    m = impute_kmeans.fit(df, "y", "id", ["z"], n_clusters=2, n_init=1)
    out = impute_kmeans.transform(m, df).toPandas()
    assert (out.z == 0.0).all()  # no evidence anywhere: the global fallback is the column median, 0
    gm = stats.global_medians(df, ["z"]).collect()[0]
    assert gm.median == 0.0


def test_empty_table_profiles(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [0, 1], "x": [1.0, 0.0]})).where("y < 0")
    prof = stats.split_profile(df.withColumn("split", df.y.cast("string")), "split", "y").collect()
    assert prof == []
    gm = stats.global_medians(df, ["x"]).collect()
    assert gm[0].median is None


def test_row_key_unique_and_partition_independent(spark):
    from nearfill.sources import with_row_key
    pdf = pd.DataFrame({"a": [1, 1, 1, 1, 2, 3, 3], "b": [0.5, 0.5, 0.5, 0.5, 1.0, None, None]})
    one = with_row_key(spark.createDataFrame(pdf).repartition(1)).toPandas()
    many = with_row_key(spark.createDataFrame(pdf).repartition(5)).toPandas()
    assert one._row_key.is_unique and len(one) == 7
    assert sorted(one._row_key) == sorted(many._row_key)
