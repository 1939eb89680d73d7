"""Importance resampling and quality rules: counts against plain Python, models by held-out accuracy."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from nearfill.llm import importance, quality_rules, textbytes

SCHEMA = "doc_id long, text string, kept string, quality int"
TEXTS = [None, "", "a", "a b c a b c\na b c\n\na b c\n a b c", "# x | y <z> $ % & *", "é ñ 日本", "x\t\ty\x0bz\r\n\r\nx", "w " * 6000]


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    often = Counter(zip(w, w[1:], w[2:]))
    inside = {i + j for i in range(len(w) - 2) if often[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def corpus(n=400, seed=1):
    rnd = random.Random(seed)
    good = [f"{a}{b}" for a in ("th", "in", "re", "on", "an") for b in ("er", "at", "ing", "es", "ly", "on")]
    rows = []
    for i in range(n):
        words = [rnd.choice(good) for _ in range(rnd.randrange(60, 160))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 8 else [w + rnd.choice(["***", "###"]) for w in words]
        rows.append((i, " ".join(words), "k", 0 if bad else 1))
    return rows


def frames(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows + [(900, None, "k", 0), (901, "", "k", 0), (None, "ther inly", "k", 0)], SCHEMA)
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows if i % 2 == 0] + [(None, 1), (1, None)], "doc_id long, quality int")
    return rows, docs, labels


def test_counts_equal_plain_python(spark):
    model = quality_rules.Model(np.zeros(65536), 0.0)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(TEXTS)], SCHEMA)
    rows = quality_rules.scored(docs, model).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r["quality"][n] for n in names) for r in rows] == [brute_counts(t) for t in TEXTS]
    for r, t in zip(rows, TEXTS):
        n, _, _, _, repeat = brute_counts(t)
        assert r["quality"]["base_failed"] == (n < 50 or 100 * repeat > 50 * n)


def test_rules_on_held_out_rows(spark):
    rows, docs, labels = frames(spark)
    model = quality_rules.fit(quality_rules.labelled_grams(docs, labels))
    kept = {r.doc_id for r in quality_rules.keep(docs, model).collect()}
    held = [(i, q) for i, _, _, q in rows if i % 2]
    assert all((i in kept) == (q == 1) for i, q in held)
    assert quality_rules.keep(docs, model).columns == docs.columns
    p = [r["quality"]["p_good"] for r in quality_rules.scored(docs.drop("quality"), model).where("doc_id < 400").orderBy("doc_id").collect()]
    y = np.array([q for _, _, _, q in rows])
    assert np.mean((np.array(p) - y) ** 2) < 0.02  # calibrated: small Brier score


def test_resampling_on_held_out_rows(spark):
    rows, docs, labels = frames(spark)
    model = importance.fit(docs, labels)
    got = importance.resample(docs, model).collect()
    assert len(got) == docs.count()
    kept = {r.doc_id for r in got if r.kept}
    assert np.mean([(i in kept) == (q == 1) for i, _, _, q in rows if i % 2]) > 0.98
    few = importance.resample(docs, model, k=50).where("kept").count()
    assert few == 50
    assert importance.keep(docs, model).columns == docs.columns
    assert {r.doc_id for r in importance.keep(docs, model).collect()} == kept


def brute_buckets(text):
    """Every n-gram's bucket, one by one."""
    raw = (text or "").encode()
    words = [np.frombuffer(w, np.uint8) for w in raw.split()]
    one = np.array([textbytes.Spans(w).hash(np.array([0]), np.array([len(w)]))[0] for w in words], np.uint64)
    out = [int(h) % 32768 for h in one]
    for a, b in zip(one, one[1:]):
        out.append(0 if a == b else int(textbytes.grams(np.array([a, b]), 2)[0]) % 32768)
    for i in range(len(raw) - 3):
        code = int.from_bytes(raw[i:i + 4], "little")
        out.append(((code ^ code >> 15) * 0x2C1B3C6D % 2**32 >> 17) + 32768)
    return out


def test_resampling_equals_plain_python(spark):
    """Counts, ratios, weights, Gumbel keys and the sample, document by document."""
    rows = corpus(120, seed=3)
    texts = {i: t for i, t, _, _ in rows} | {500 + i: t for i, t in enumerate(TEXTS)}
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in texts.items()], SCHEMA)
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows if i % 2 == 0], "doc_id long, quality int")
    buckets = {i: brute_buckets(t) for i, t in texts.items()}
    count = lambda ids: np.bincount(np.concatenate([np.array(buckets[i], np.int64) for i in ids]), minlength=65536).astype(float)
    assert (importance.gram_counts(docs) == count(texts)).all()
    model = importance.fit(docs, labels)
    ratio = importance.log_ratio(count([i for i, _, _, q in rows if i % 2 == 0 and q]), count(texts))
    assert np.allclose(model.ratio, ratio)
    weight = {i: model.slope * (np.mean(ratio[b]) if b else 0.0) + model.shift for i, b in buckets.items()}
    hashed = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 13) AS h").collect()}
    noise = {i: -np.log(-np.log(((h % 2**64 >> 11) + 0.5) / 2**53)) for i, h in hashed.items()}
    key = {i: round((weight[i] + noise[i]) * 1e6) / 1e6 for i in texts}
    got = {r.doc_id: r for r in importance.resample(docs, model).collect()}
    k = sum(w + model.log_odds >= 0 for w in weight.values())
    best = set(sorted(key, key=key.get, reverse=True)[:k])
    for i in texts:
        assert abs(got[i].log_weight - weight[i]) < 1e-9 and abs(got[i].sample_key - key[i]) < 2e-6
        assert got[i].kept == (i in best)


def test_without_labels_and_without_documents(spark):
    _, docs, labels = frames(spark)
    none = labels.where("false")
    assert importance.resample(docs, importance.fit(docs, none)).where("kept").count() == docs.count()
    rows = quality_rules.labelled_grams(docs, none)
    assert len(rows) == 0 and quality_rules.fit(rows).probability(*[np.zeros(1)] * 4)[0] == 0.5
    assert importance.resample(docs.where("false"), importance.fit(docs.where("false"), none)).count() == 0


def test_kth_largest(spark):
    rnd = random.Random(5)
    values = [rnd.randrange(-10**12, 10**12) for _ in range(300)] + [7] * 40
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 150, 340):
        assert importance.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(df, "v", 0) is None and importance.kth_largest(df, "v", 999) == min(values)


def test_log_ratio_is_a_ratio_of_distributions():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 50, 65536).astype(float)
    target = rng.binomial(raw.astype(int), 0.3).astype(float)
    ratio = importance.log_ratio(target, raw)
    for part in (slice(0, 32768), slice(32768, 65536)):
        q = (raw[part] + 1) / (raw[part] + 1).sum()
        assert np.isclose((np.exp(ratio[part]) * q).sum(), 1)


def test_measure_handles_one_text_longer_than_a_slice():
    text = "ab cd " * 300_000
    t = next(textbytes.slices(pa.array([text])))
    got = quality_rules.measure(t, quality_rules.Model(np.zeros(65536), 0.0))
    assert got["n_words"][0] == got["n_repeat_words"][0] == 600_000
