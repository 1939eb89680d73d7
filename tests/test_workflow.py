import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from nearfill.plans import workflow
from nearfill.plans.workflow import run
from nearfill.sources import read_checked, read_table, write_table


def _frame(spark, n=160, seed=5):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": np.arange(n), "y": y, "a": (y * 2 + rng.normal(size=n)).round(3),
                        "z": rng.integers(1, 40, n).astype(float), "w": rng.normal(10, 2, n).round(2)})
    pdf.loc[rng.random(n) < 0.2, "z"] = 0.0
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("imputer,mode", [("knn", "train_fitted"), ("kmeans", "refit"), (None, "train_fitted")])
def test_run_paths_and_sinks(spark, imputer, mode):
    out_dir = tempfile.mkdtemp(prefix="nearfill-run-")
    res = run(_frame(spark), "y", "id", imputer=imputer, impute_cols=["z"], test_imputation=mode,
              output=out_dir, n_neighbors=3) if imputer == "knn" else \
        run(_frame(spark), "y", "id", imputer=imputer, impute_cols=["z"], test_imputation=mode, output=out_dir,
            **({"n_clusters": 2, "n_init": 1} if imputer == "kmeans" else {}))
    m = res["metrics"].collect()[0]
    assert m.tn + m.fp + m.fn + m.tp == 32 and 0 <= m.accuracy <= 1
    preds = read_table(spark, os.path.join(out_dir, "predictions"))
    assert preds.count() == 32 and {"Prediction", "Probability"} <= set(preds.columns)
    if imputer is not None:
        assert res["train_imputed"].where("z = 0").count() == 0
        assert res["imputation_profile"].count() == 1


def test_nothing_stays_cached(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, i % 2, float(i % 5), float(rng.normal())) for i in range(60)], "id long, y int, v double, w double")
    spark.catalog.clearCache()
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    workflow.run(df, "y", "id", imputer="knn", impute_cols=["v"], classifier_args={"n_neighbors": 3})
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_a_folder_is_rewritten_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(50).selectExpr("id", "id % 3 AS g"), path)
    schema = "id long, g long"
    write_table(read_table(spark, path, schema).where("g = 1"), path)
    assert sorted(r.id for r in read_table(spark, path, schema).collect()) == list(range(1, 50, 3))
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_malformed_rows(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("a,b\n1,x\nno,y\n3,z,9\n4\n5,v\n")
    schema = "a int, b string"
    assert read_table(spark, str(path), schema).count() == 5
    good, bad, counts = read_checked(spark, str(path), schema)
    assert sorted(r.a for r in good.collect()) == [1, 5] and counts.get == {"rows": 5, "malformed": 3}
    assert sorted(r._malformed for r in bad.collect()) == ["3,z,9", "4", "no,y"]
    assert good.select("b").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        read_table(spark, str(path), schema, malformed="refuse").collect()
    with pytest.raises(ValueError):
        read_table(spark, str(path), malformed="apart")
