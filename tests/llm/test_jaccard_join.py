"""The Jaccard join against all pairs."""
import random

import pyarrow as pa
import pytest

from nearfill.llm import graph, jaccard_join, textbytes

SCHEMA = "doc_id long, text string, n_shingles string, c int"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    parent = {i: i for i in sets if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(parent)
    for a in keys:
        for b in keys:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, len(shingles(t)), None if i is None else top(i)) for i, t in rows), key=str)


def noisy(seed, copies=90, others=60):
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(70)]
    passage = " ".join(f"p{i}" for i in range(55))
    rows = []
    for i in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(5)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(copies, copies + others):
        rows.append((i, passage + " " + " ".join(f"y{rnd.randrange(10**6)}" for _ in range(rnd.choice([2, 9, 30, 80])))))
    return rows


ODD = [(200, None), (201, ""), (202, " \n\t"), (203, "a b"), (204, "A  b"), (205, "a b c d e"), (206, "a b c d e"), (206, "a b c d e"),
       (None, "a b c d e"), (None, None), (207, "one " * 4000), (208, "one " * 3000), (-5, "w0 w1 w2")]


@pytest.mark.parametrize("small_tile", [4])
def test_components_equal_all_pairs(spark, monkeypatch, small_tile):
    monkeypatch.setattr(jaccard_join, "SMALL_TILE", small_tile)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rows = noisy(small_tile) + ODD
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in jaccard_join.components(docs).collect()), key=str)
    assert got == brute(rows)


def test_keep_one_keeps_one_row_of_each_component(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other words stand here now"), (4, None), (None, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs).where("doc_id is not null").collect())
    assert kept == [(1, "a b c d e f"), (2, "other words stand here now"), (4, None)]
    assert jaccard_join.keep_one(docs).where("doc_id is null").count() == 1


KEYS = [(1, "a1 a2 a3 a4 a5 a6"), (2, "a1 a2 a3 a4 a5 a6"), (2, "b1 b2 b3 b4 b5 b6"), (3, "b1 b2 b3 b4 b5 b6"), (4, "c1 c2 c3 c4 c5"),
        (4, "d1 d2 d3 d4 d5"), (5, "d1 d2 d3 d4 d5"), (0, "c1 c2 c3 c4 c5"), (6, ""), (6, "e1 e2 e3 e4 e5")]


def test_keys_with_several_texts(spark):
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in KEYS], SCHEMA)
    got = sorted((tuple(r) for r in jaccard_join.components(docs).collect()), key=str)
    assert got == brute(KEYS)
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect())
    assert kept == sorted([KEYS[0], KEYS[2], KEYS[7], KEYS[5], KEYS[8], KEYS[9]])


def test_words_that_collide_modulo_powers_of_two_are_different(spark):
    word = "a"
    while len(word) < 8192:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"{word} x y z u"), (4, f"{other} x y z u"), (5, word)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in jaccard_join.components(docs).collect()), key=str) == brute(rows)


def test_production_tiles_equal_all_pairs(spark):
    """Tiles above the production size, with members of many components."""
    rnd = random.Random(2)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"t{rnd.randrange(12)}" for _ in range(9)])) for i in range(jaccard_join.SMALL_TILE * 3)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in jaccard_join.components(docs).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert jaccard_join.components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bitmaps_bound_the_overlap():
    import numpy as np

    rnd = random.Random(0)
    for _ in range(100):
        words = [str(rnd.randrange(60)) for _ in range(rnd.randrange(5, 200))]
        texts = [" ".join(words), " ".join(words[:rnd.randrange(5, len(words) + 1)]) + " z"]
        x, y = (s for t in textbytes.slices(pa.array(texts)) for s in textbytes.shingle_sets(t))
        bits = [np.frombuffer(jaccard_join.bitmap(s), np.uint64) for s in (x, y)]
        assert jaccard_join.overlap_bound(len(x), bits[0], len(y), bits[1]) >= len(np.intersect1d(x, y))


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100
