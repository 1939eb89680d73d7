"""Masked pseudo-likelihood against a plain reading of the network."""
import random

import numpy as np
import pyarrow as pa

from nearfill.llm import masked_lm, textbytes

SCHEMA = "doc_id long, text string, n_tokens string"


def plain(w, text):
    t = next(iter(textbytes.slices(pa.array([text]))))
    spans = textbytes.words(t)
    ids = (textbytes.Spans(t.buf, True).hash(spans.start, spans.end) >> np.uint64(20)).astype(int) % masked_lm.VOCABULARY
    total = 0.0
    for i, token in enumerate(ids):
        z = w["shift"].astype(float).copy()
        for place, at in enumerate(masked_lm.PLACES):
            near = ids[i + at] if 0 <= i + at < len(ids) else masked_lm.VOCABULARY
            z += w["embed"][near].astype(float) * w["place"][place]
        h = np.tanh(z)
        for logits, right in ((h @ w["group"] + w["group_shift"], token // 32),
                              (h @ w["member"] + w["member_shift"][token // 32], token % 32)):
            total += logits[right] - np.log(np.exp(logits).sum())
    return len(ids), total


def test_scores_equal_the_plain_sum(spark):
    vector = masked_lm.initial(1)
    w = masked_lm.unflatten(vector)
    texts = ["One two three four five six", "a", "x y", "Wort " * 40, "repeated", "repeated"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)
    for r in masked_lm.score(docs, vector).collect():
        n, total = plain(w, texts[r.doc_id])
        assert r.n_tokens == n and np.isclose(r.log_likelihood, total, rtol=1e-4)
        assert np.isclose(r.perplexity, np.exp(-total / n), rtol=1e-3)


def test_probabilities_sum_to_one():
    w = masked_lm.unflatten(masked_lm.initial(2))
    token = np.arange(masked_lm.VOCABULARY)
    context = np.tile([5, 6, 7, 8], (len(token), 1))
    assert np.isclose(np.exp(masked_lm.log_probabilities(w, token, context)).sum(), 1, rtol=1e-4)


def test_training_learns_both_sides(spark):
    rnd = random.Random(0)
    pairs = [(f"l{i}", f"m{i}", f"r{i}") for i in range(12)]
    texts = [" ".join(w for _ in range(60) for w in rnd.choice(pairs)) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(2)
    start, trained = masked_lm.initial(3), masked_lm.train(docs.where("doc_id < 60"), rounds=4)
    held = docs.where("doc_id >= 60")
    mean = lambda v: np.mean([r.mean_log_likelihood for r in masked_lm.score(held, v).collect()])
    assert mean(trained) > mean(start) + 1
    shuffled = spark.createDataFrame([(0, " ".join(rnd.sample(texts[70].split(), 180)), "x")], SCHEMA)
    assert masked_lm.score(shuffled, trained).first().mean_log_likelihood < mean(trained)


def test_every_token_is_a_target_once_in_each_number_of_rounds():
    place = np.arange(4096)
    for rounds in (1, 2, masked_lm.ROUNDS, 5):
        of = masked_lm._round(place, rounds)
        assert set(of) == set(range(rounds)) and (np.sort(of[:rounds * 800].reshape(-1, rounds)) == np.arange(rounds)).all()
        for period in (2, 3, 4):
            for number in range(rounds):
                assert np.bincount(place[of == number] % period, minlength=period).min() > 4096 / rounds / period / 2


def test_every_place_of_a_text_is_learnt_by_default(spark):
    columns = [[f"{c}{i}" for i in range(3)] for c in "abcd"]
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(words) for _ in range(300) for words in columns) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(2)
    token, context, _ = masked_lm.tokens(next(iter(textbytes.slices(pa.array(texts[:1])))))
    start, trained = (masked_lm.log_probabilities(masked_lm.unflatten(v), token, context)
                      for v in (masked_lm.initial(3), masked_lm.train(docs)))
    for place in range(4):
        assert trained[place::4].mean() > start[place::4].mean() + 1


def test_gradient_is_the_slope():
    rng = np.random.default_rng(4)
    w = masked_lm.unflatten(masked_lm.initial(5))
    token, context = rng.integers(0, masked_lm.VOCABULARY, 64), rng.integers(0, masked_lm.VOCABULARY + 1, (64, 4))
    past = {k: np.full(v.shape, 1e-6) for k, v in w.items()}
    before = masked_lm.log_probabilities(w, token, context).mean()
    for _ in range(5):
        masked_lm.descend(w, past, token, context)
    assert masked_lm.log_probabilities(w, token, context).mean() > before


def test_nulls_empty_texts_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b", "x"), (1, None, "x"), (2, " \n", "x")], SCHEMA)
    rows = {r.doc_id: r for r in masked_lm.score(docs, masked_lm.train(docs)).collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == 0 and rows[1].log_likelihood == 0 and rows[1].perplexity is None
    assert rows[None].n_tokens == 2
    empty = docs.where("false")
    assert (masked_lm.train(empty) == masked_lm.initial()).all() and masked_lm.score(empty, masked_lm.initial()).count() == 0
