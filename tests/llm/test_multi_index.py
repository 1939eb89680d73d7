"""The inverted multi-index against brute force."""
import numpy as np

from nearfill.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, score double, rank int"


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if v is None else [None if c is None else float(c) for c in v], 0.0, 1)
                                  for i, v in zip(ids, x)], SCHEMA)


def brute(x, queries, k):
    x = x.astype(np.float32).astype(np.float64)
    out = {}
    for q in queries:
        s = multi_index.cosine(x, x[q])
        s[q] = -np.inf
        out[q] = np.lexsort((np.arange(len(x)), -s))[:k].tolist()
    return out


def test_recall_and_scores(spark):
    x = np.random.default_rng(0).normal(size=(1500, 16))
    df = frame(spark, x)
    index = multi_index.fit(df, k=5)
    rows = multi_index.search(df, df.where("vec_id % 50 = 0"), index).collect()
    want = brute(x, range(0, 1500, 50), 5)
    hits = sum(r.vec_id in want[r.query_id] for r in rows)
    assert len(rows) == 150 and hits / 150 >= 0.9
    x32 = x.astype(np.float32).astype(np.float64)
    for r in rows:
        assert r.score == multi_index.cosine(x32[[r.vec_id]], x32[r.query_id])[0] and r.vec_id != r.query_id


def test_a_full_walk_is_exact_with_ties_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "ROW_BLOCK", 16)
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 3)
    x = np.random.default_rng(1).normal(size=(200, 6))
    x[40:140] = x[40]  # half of the rows are one vector
    df = frame(spark, x)
    index = multi_index.fit(df, k=5)
    index = multi_index.Index(index.books, 1.0, index.dim)
    got: dict = {}
    for r in multi_index.search(df, df.where("vec_id % 10 = 0"), index).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(x, range(0, 200, 10), 5)


def test_vectors_that_take_no_part(spark):
    x = [[1, 0], [0, 1], None, [0, 0], [1, None], [float("nan"), 1], [float("inf"), 1], [], [1, 1, 1], [2, 0], [2, 0]]
    ids = [0, 50, 100, 150, 200, 250, 300, 350, 400, 1, 1]
    df = frame(spark, x, ids)
    rows = multi_index.search(df, df, multi_index.fit(df)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in rows] == [(0, 1, 1), (0, 2, 50), (1, 1, 0), (1, 2, 50), (50, 1, 0), (50, 2, 1)]
    none = df.where("embedding is null")
    assert multi_index.fit(none) is None and multi_index.search(none, none, None).count() == 0
    assert multi_index.search(none, none, multi_index.fit(df)).count() == 0


def test_walk_is_in_order_of_the_summed_distances():
    rng = np.random.default_rng(2)
    a, b = rng.random(7), rng.random(5)
    pairs = list(multi_index.walk(a, b))
    sums = [a[i] + b[j] for i, j in pairs]
    assert len(set(pairs)) == 35 and sums == sorted(sums)
