"""Pfair mixing: deviation, completeness and epochs."""
from collections import Counter

import pytest

from nearfill.llm import mixing

SCHEMA = "doc_id long, source string, slots int, parts string, text string"


def frame(spark, sizes):
    rows, at = [], 0
    for src, n in sizes.items():
        for _ in range(n):
            rows.append((at, src, 1, "p", None if at % 3 else "t"))
            at += 1
    return spark.createDataFrame(rows, SCHEMA)


def test_deviation_stays_below_one_block(spark):
    docs = frame(spark, {"a": 300, "b": 90, "c": 60, None: 50})
    weights = {"a": 50, "b": 30, "c": 13, None: 7}
    rows = mixing.positions(docs, weights, block_docs=5, max_epochs=50, period=100).collect()
    blocks = {r["__slot"]: r["source"] for r in rows}
    assert sorted(blocks) == list(range(len(blocks)))  # no slot is empty, none is used twice
    seen = Counter()
    for t in range(len(blocks)):
        seen[blocks[t]] += 1
        for src, w in weights.items():
            assert abs(seen[src] - (t + 1) * w / 100) < 1
    assert {r.doc_id for r in rows} == set(range(500))


def test_epochs_are_bounded_and_every_document_is_used(spark):
    docs = frame(spark, {"big": 400, "tiny": 3})
    rows = mixing.positions(docs, {"big": 50, "tiny": 50}, block_docs=4, max_epochs=3, period=10).collect()
    times = Counter(r.doc_id for r in rows)
    assert {times[i] for i in range(400)} == {1} and {times[i] for i in range(400, 403)} == {3}
    assert len({(r["__slot"], r["__place"]) for r in rows}) == len(rows)


def test_mix_orders_and_keeps_columns(spark):
    docs = frame(spark, {"a": 40, "b": 20})
    want = mixing.positions(docs, block_docs=4, period=20).orderBy("__slot", "__place")
    got = mixing.mix(docs, block_docs=4, period=20)
    assert got.columns == docs.columns
    assert [r.doc_id for r in got.collect()] == [r.doc_id for r in want.collect()]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", 1, "p", "x")] * 3 + [(None, "a", 1, "p", None)] * 2 + [(None, None, None, None, None)], SCHEMA)
    assert mixing.mix(docs, block_docs=2, max_epochs=1, period=10).count() == 6
    assert mixing.mix(docs.where("false")).count() == 0


def test_wrong_weights_are_refused(spark):
    docs = frame(spark, {"a": 3, "b": 3})
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 1})
    with pytest.raises(ValueError):
        mixing.mix(docs, period=1)


@pytest.mark.parametrize("small", [900, 1500])  # each below one part of 1000, and more sources than slots
def test_a_hot_source_keeps_its_weight_beside_many_small_ones(spark, small):
    docs = frame(spark, {"hot": small // 2, **{f"t{i}": 1 for i in range(small)}})
    rows = mixing.positions(docs, alpha=1, block_docs=1).collect()
    assert {r.doc_id for r in rows} == set(range(small // 2 + small))
    blocks = {r["__slot"]: r["source"] for r in rows}
    assert len(blocks) == len(rows)  # no slot is used twice
    seen = Counter()
    for n, t in enumerate(sorted(blocks), 1):
        seen[blocks[t] == "hot"] += 1
        assert abs(seen[True] - n / 3) < 5
    times = Counter(blocks.values())
    assert max(times[f"t{i}"] for i in range(small)) <= 2


def test_sources_far_below_one_part_are_not_repeated(spark):
    docs = frame(spark, {"big": 400, "tiny": 1, "wee": 1})
    rows = mixing.positions(docs, {"big": 398, "tiny": 1, "wee": 1}, block_docs=1, period=10).collect()
    times = Counter(r["source"] for r in rows)
    assert len({r["__slot"] for r in rows}) == len(rows) and {r.doc_id for r in rows} == set(range(402))
    assert times["tiny"] <= 2 and times["wee"] <= 2


def test_every_tree_gives_each_source_its_weight():
    for share in ([1.0], [1.0] * 5000, [1e6, 1.0], [1e9, 1e3, 1.0, 1.0], [float(i % 7 + 1) for i in range(3000)] + [4e4]):
        nodes, _ = mixing._tree(share, 1000)
        rate, got = {0: 1.0}, {}
        for at, members in enumerate(nodes):
            assert sum(p for p, _, _ in members) == 1000 and len(members) <= 1000
            for p, i, n in members:
                if i is not None:
                    got[i] = rate[at] * p / 1000
                elif n is not None:
                    rate[n] = rate[at] * p / 1000
        assert sorted(got) == list(range(len(share)))
        for i, s in enumerate(share):
            assert abs(got[i] / (s / sum(share)) - 1) < 0.2  # parts are whole on each level
