import pandas as pd
import pytest

from nearfill.operators import classify, metrics, validate


def test_metrics_and_single_class(spark):
    df = spark.createDataFrame(pd.DataFrame({"y": [1, 1, 0, 0, 1], "p": [1, 0, 0, 1, 1]}))
    m = metrics.classification_metrics(df, "y", "p").collect()[0]
    assert (m.tn, m.fp, m.fn, m.tp) == (1, 1, 1, 2)
    assert m.precision == pytest.approx(2 / 3) and m.recall == pytest.approx(2 / 3)
    one = spark.createDataFrame(pd.DataFrame({"y": [0, 0], "p": [0, 0]}))
    m1 = metrics.classification_metrics(one, "y", "p").collect()[0]
    assert (m1.tn, m1.tp, m1.f1, m1.precision) == (2, 0, 0.0, 0.0)


def test_non_numeric_feature_rejected(spark):
    df = spark.createDataFrame(pd.DataFrame({"id": [1], "y": [0], "s": ["x"]}))
    with pytest.raises(ValueError):
        validate.feature_columns(df, "y", exclude=["id"])


def test_classifier_k1_predicts_own_label(spark):
    pdf = pd.DataFrame({"id": range(40), "y": [i % 2 for i in range(40)], "a": [float(i) for i in range(40)],
                        "b": [float(i * i % 7) for i in range(40)]})
    df = spark.createDataFrame(pdf)
    m = classify.fit(df, "y", "id", n_neighbors=1)
    pred = classify.predict(m, df, carry=["y"]).toPandas()
    assert (pred.prediction == pred.y).all()
    assert ((pred.proba_0 + pred.proba_1 - 1).abs() < 1e-12).all()


def test_entry_contract():
    import __spark_entry__ as e
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q)
    dealt = {n.split("_")[0] for n in q if n[:2] == "op" and n[2:3].isdigit()}
    present = e.subpackage("nearfill.llm")
    assert dealt == ({f"op{i}" for i in range(1, 14)} if present else set())
    assert ("pipeline" in q) == (present and e.subpackage("corpus_pipeline"))
    assert len(q) - len(dealt) - ("pipeline" in q) >= 43


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and "Prediction" in df.columns
