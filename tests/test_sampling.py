import pandas as pd
import pytest
from pyspark.sql import functions as F

from nearfill.operators import sampling, stats


def test_allocate_matches_reference_sizes():
    # 500 / 268 rows, test_size 0.2 → train 400 + 214 (614), test 100 + 54
    assert sampling.allocate({0: 500, 1: 268}, 614) == {0: 400, 1: 214}


def _labels(spark, n0=500, n1=268):
    pdf = pd.DataFrame({"id": range(n0 + n1), "y": [0] * n0 + [1] * n1})
    return spark.createDataFrame(pdf)


def test_split_exact_disjoint_complete_stable(spark):
    df = _labels(spark)
    a = sampling.stratified_split(df, "y", ["id"], 0.2, 42).toPandas()
    assert len(a) == 768 and a.id.is_unique
    cnt = a.groupby(["split", "y"]).size().to_dict()
    assert cnt == {("test", 0): 100, ("test", 1): 54, ("train", 0): 400, ("train", 1): 214}
    b = sampling.stratified_split(df.repartition(7), "y", ["id"], 0.2, 42).toPandas()
    assert a.sort_values("id").split.tolist() == b.sort_values("id").split.tolist()
    c = sampling.stratified_split(df, "y", ["id"], 0.2, 7).toPandas()
    assert a.sort_values("id").split.tolist() != c.sort_values("id").split.tolist()


def test_quotas_of_very_many_classes(spark, monkeypatch):
    """The class table's largest remainders, ranked in one task or by distributed prefix counts."""
    sizes = {c: 2 + (c * 37) % 11 for c in range(1500)}
    df = spark.createDataFrame([(c * 100 + i, c) for c, n in sizes.items() for i in range(n)], "id long, y int")
    n_train = sum(sizes.values()) - -(-sum(sizes.values()) * 3 // 10)
    want = sampling.allocate(sizes, n_train)
    quotas = lambda: {r.y: r._quota for r in sampling.split_quotas(df, "y", 0.3).collect()}
    assert quotas() == want
    monkeypatch.setattr(sampling, "RANKED_AT_ONCE", 10)
    assert quotas() == want
    got = sampling.stratified_split(df, "y", ["id"], 0.3).where("split = 'train'").groupBy("y").count().collect()
    assert {r.y: r["count"] for r in got} == {c: q for c, q in want.items() if q}
    folds = sampling.stratified_folds(df, "y", ["id"], 5).groupBy("y").agg(F.count("fold").alias("n")).collect()
    assert {r.y: r.n for r in folds} == sizes


def test_split_rejects_singleton_class(spark):
    pdf = pd.DataFrame({"id": range(5), "y": [0, 0, 0, 0, 1]})
    with pytest.raises(ValueError):
        sampling.stratified_split(spark.createDataFrame(pdf), "y", ["id"])


def test_split_missing_target(spark):
    with pytest.raises(ValueError, match="nope"):
        sampling.stratified_split(_labels(spark), "nope", ["id"])


def test_folds_balanced(spark):
    f = sampling.stratified_folds(_labels(spark), "y", ["id"], 5, 42).toPandas()
    sizes = f.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()


def test_hash_rank_is_a_permutation(spark):
    r = sampling.hash_rank(_labels(spark), "y", ["id"], 3).toPandas()
    for y, grp in r.groupby("y"):
        assert sorted(grp._rank) == list(range(1, len(grp) + 1))


def test_split_profile(spark):
    s = sampling.stratified_split(_labels(spark), "y", ["id"])
    p = stats.split_profile(s, "split", "y").toPandas().set_index("split")
    assert p.loc["train", "total"] == 614 and p.loc["test", "positive"] == 54
    assert p.loc["test", "positive_ratio"] == pytest.approx(54 / 154)
