import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nearfill.operators import quantiles, scaling, stats


def _frame(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    g = rng.choice(["a", "b", "c"], size=n, p=[0.7, 0.2, 0.1])  # one hot group
    x = np.round(rng.normal(10, 3, n), 1)
    x[rng.random(n) < 0.1] = 0.0
    y = rng.integers(0, 5, n).astype(float)  # many ties
    pdf = pd.DataFrame({"k": np.arange(n), "g": g, "x": x, "y": y})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("method", ["ranked", "builtin"])
def test_grouped_median_matches_pandas(spark, method):
    pdf, df = _frame(spark)
    got = quantiles.grouped_median(df, ["g"], ["x", "y"], method=method).toPandas()
    for _, r in got.iterrows():
        exp = pdf.loc[pdf.g == r["g"], r["column"]].median()
        assert r["median"] == pytest.approx(exp, abs=1e-12)


def test_ranked_median_small_and_even_groups(spark):
    pdf = pd.DataFrame({"g": [1, 1, 2, 2, 2, 3], "v": [1.0, 4.0, 5.0, 5.0, 7.0, 2.0]})
    got = quantiles.grouped_median(spark.createDataFrame(pdf), ["g"], ["v"]).toPandas().set_index("g")
    assert got.loc[1, "median"] == 2.5 and got.loc[2, "median"] == 5.0 and got.loc[3, "median"] == 2.0


def test_global_and_class_medians_fallbacks(spark):
    pdf = pd.DataFrame({"c": [0, 0, 1, 1], "a": [0.0, 0.0, 0.0, 0.0], "b": [0.0, 2.0, 4.0, 6.0]})
    df = spark.createDataFrame(pdf)
    gm = {r["column"]: r["median"] for r in stats.global_medians(df, ["a", "b"]).collect()}
    assert gm == {"a": 0.0, "b": 4.0}  # all-zero column → its own median (0)
    cm = {(r["c"], r["column"]): r["median"] for r in stats.class_medians(df, "c", ["a", "b"]).collect()}
    assert cm[(0, "b")] == 2.0 and cm[(1, "b")] == 5.0
    assert cm[(0, "a")] == 0.0  # no evidence → global → 0


def test_median_fill_only_touches_sentinels(spark):
    pdf, df = _frame(spark)
    med = stats.class_medians(df, "g", ["x"])
    out = stats.median_fill(df, ["x"], med, ["g"]).toPandas().sort_values("k")
    src = pdf.sort_values("k")
    keep = src.x.to_numpy() != 0
    assert np.array_equal(out.x.to_numpy()[keep], src.x.to_numpy()[keep])
    assert (out.x.to_numpy()[~keep] != 0).all()


def test_population_scaler_and_constant_column(spark):
    pdf = pd.DataFrame({"g": [0, 0, 0, 1, 1], "x": [1.0, 2.0, 4.0, 3.0, 3.0]})
    df = spark.createDataFrame(pdf)
    sc = scaling.fit_scaler(df, ["x"], ["g"]).toPandas().set_index("g")
    assert sc.loc[0, "scale"] == pytest.approx(np.std([1, 2, 4]))  # population sd
    assert sc.loc[1, "scale"] == 1.0  # constant → 1
    z = scaling.apply_scaler(df, ["x"], scaling.fit_scaler(df, ["x"], ["g"]), ["g"]).toPandas()
    assert z[z.g == 1].x.tolist() == [0.0, 0.0]


def test_imputation_profile_columns(spark):
    pdf, df = _frame(spark)
    med = stats.class_medians(df, "g", ["x"])
    filled = stats.median_fill(df, ["x"], med, ["g"])
    prof = stats.imputation_profile(df, filled, ["x"]).toPandas().iloc[0]
    assert prof.zeros_replaced == int((pdf.x == 0).sum())
    assert prof.original_median == pytest.approx(pdf.x[pdf.x != 0].median())
    assert prof.original_mean == pytest.approx(pdf.x[pdf.x != 0].mean())
