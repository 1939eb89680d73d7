"""Text primitives against plain Python."""
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from nearfill.llm import features, textbytes

TEXTS = ["", None, "a", " A  b\tc\n", "é ñ 日本 x", "x" * 5000 + " y", "one two three four five six", "\n\n", "a a a a a a a"]


def test_words_match_the_pattern():
    found = []
    for t in textbytes.slices(pa.array(TEXTS), max_bytes=40):
        w = textbytes.words(t)
        for i in range(t.count):
            raw = t.buf.tobytes()
            found.append([raw[a:b].decode() for a, b in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])])
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbB é\n", max_size=40), max_size=6))
def test_shingle_sets_are_sets_of_word_windows(texts):
    low = str.maketrans("AB", "ab")
    names: dict = {}
    for t in textbytes.slices(pa.array(texts, pa.string())):
        for i, s in enumerate(textbytes.shingle_sets(t, 5), t.first):
            w = re.findall(r"[^\x20\x09-\x0D]+", texts[i].translate(low))
            want = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
            assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()
            assert names.setdefault(frozenset(want), s.tobytes()) == s.tobytes()


def test_gram_sums_and_counts_agree_with_one_text():
    weight = np.random.default_rng(0).normal(size=features.BUCKETS)
    total = np.zeros(features.BUCKETS)
    for t in textbytes.slices(pa.array(TEXTS)):
        word, n_word, char, n_char = features.sums(t, weight)
        total += features.counts(t)
        for i, text in enumerate(TEXTS):
            at, n, a, b = features.one_text(text or "")
            assert (a, b) == (n_word[i], n_char[i])
            assert np.isclose(word[i] + char[i], (weight[at] * n).sum())
    want = np.zeros(features.BUCKETS)
    for text in TEXTS:
        at, n, _, _ = features.one_text(text or "")
        np.add.at(want, at, n)
    assert (total == want).all()
