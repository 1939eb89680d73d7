"""Repeated windows against plain Python, and odd tables."""
import hashlib
import random
import re

import numpy as np
import pytest

from nearfill.llm import queries, window_dedup

SCHEMA = "doc_id long, text string, a int, h string, key string"


def plain(rows, window):
    """doc_id, text -> (n_words, n_removed, kept words), documents in order of doc_id (nulls last)."""
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    seen, out = set(), {}
    for nokey, key, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = set()
        for i in range(len(w) - window + 1):
            name = tuple(w[i:i + window])
            if name in seen:
                gone.update(range(i, i + window))
            seen.add(name)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[None if nokey else key, text] = len(w), len(gone), kept
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "h", "k") for r in rows], SCHEMA).repartition(parts)


def check(spark, rows, window, parts=3):
    want = plain(rows, window)
    got = window_dedup.clean(frame(spark, rows, parts), window).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.text) for r in got) == sorted(
        (r[0] is None, r[0] or 0, *want[r[0], r[1] or ""]) for r in rows)


def made(seed, n=150, vocabulary=40):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "Ñandú", "W1"]
    shared = [[r.choice(words) for _ in range(r.randrange(3, 90))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(r.randrange(4)):
            w += [r.choice(words) for _ in range(r.randrange(25))]
            piece = r.choice(shared)
            a = r.randrange(len(piece))
            w += piece[a:a + r.randrange(60)]
        if r.random() < 0.1:
            w += [r.choice(words)] * r.randrange(60)
        rows.append((i * 3 + 1, r.choice([" ", "\n", "\t \r"]).join(w) if w or r.random() < 0.5 else None))
    return rows


@pytest.mark.parametrize("window, vocabulary", [(20, 40), (8, 4), (5, 3), (4, 2), (3, 2), (1, 30), (33, 3)])
def test_equals_plain_python(spark, window, vocabulary):
    check(spark, made(window, 90, vocabulary), window)


def test_result_does_not_depend_on_the_partitions(spark):
    rows = made(77) + [(10_000 + i, made(77)[5][1]) for i in range(60)]
    check(spark, rows, 20, 1)
    check(spark, rows, 20, 17)


def test_odd_tables(spark):
    text = " ".join(f"u{i}" for i in range(50))
    check(spark, [(None, text), (5, text), (5, text), (-3, "x " + text), (7, ""), (8, None), (9, " \n "), (10, " ".join(["a"] * 3000))], 20)
    check(spark, [(1, "lone words only"), (2, None)], 20)
    check(spark, [(2, ("ab" * 100_000 + " ") * 25), (1, ("ab" * 100_000 + " ") * 21)], 20)
    assert window_dedup.report(frame(spark, [(1, "t")]).where("false")).collect() == []


def test_texts_of_one_key(spark):
    """Different texts of one key are documents of their own: one of them keeps the passage."""
    text = " ".join(f"u{i}" for i in range(40))
    got = window_dedup.clean(frame(spark, [(1, text + " end"), (1, "start " + text), (2, text)])).collect()
    by_text = sorted((r.doc_id, r.n_removed) for r in got)
    assert by_text == [(1, 0), (1, 40), (2, 40)]


def test_least_grams_and_levels():
    r = np.random.default_rng(3)
    grams = r.integers(0, 9, 200).astype(np.uint64)
    for span in (1, 2, 3, 5, 8, 11, 16):
        got = window_dedup.least_grams(grams, span)
        assert got.tolist() == [i + int(grams[i:i + span].argmin()) for i in range(200 - span + 1)]
    assert window_dedup.levels(20) == [5, 10] and window_dedup.levels(3) == [] and window_dedup.levels(80) == [5, 10, 20, 40]


def test_hostile_words(spark):
    """Words whose polynomial hashes collide modulo 2^64 stay different."""
    thue = "a"
    while len(thue) < 2048:
        thue += thue.translate(str.maketrans("ab", "ba"))
    other = thue.translate(str.maketrans("ab", "ba"))
    base = [f"u{i}" for i in range(19)]
    check(spark, [(1, " ".join([*base, thue])), (2, " ".join([*base, other])), (3, " ".join([*base, thue]))], 20)


def test_report_digests(spark):
    rows = made(9, 30)
    want = plain(rows, 20)
    for r in window_dedup.report(frame(spark, rows)).collect():
        n, gone, kept = next(v for (k, _), v in want.items() if k == r.doc_id)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
    assert "op12_window_dedup" in queries.QUERIES and "op12_window_dedup" in queries.ORACLE
