"""Hashed n-grams of texts: word 1-grams and 2-grams, and character 4-grams over UTF-8 bytes.

Word grams fall into the buckets ``0 .. WORD_BUCKETS - 1`` and character grams
into the ``CHAR_BUCKETS`` after them.  A word that repeats the one before it
has one bucket of its own as a 2-gram, whichever word it is.
"""
from __future__ import annotations

import numpy as np

from . import textbytes

WORD_BUCKETS = 1 << 15
CHAR_BUCKETS = 1 << 15
BUCKETS = WORD_BUCKETS + CHAR_BUCKETS
_REPEAT = 0


def _word_grams(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(WORD_BUCKETS - 1)
    one = (h & mask).astype(np.int32)
    two = (textbytes.grams(h, 2) & mask).astype(np.int32)
    two[h[1:] == h[:-1]] = _REPEAT
    return one, two


def _char_grams(buf: np.ndarray) -> np.ndarray:
    b = buf.astype(np.uint32)
    if len(b) < 4:
        return np.zeros(0, np.int32)
    code = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    code = (code ^ code >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    return ((code >> np.uint32(17)) + np.uint32(WORD_BUCKETS)).astype(np.int32)


def _between(running: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    b = np.maximum(a, b)
    return running[b] - running[a]


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])


def sums(t: textbytes.Texts, weight: np.ndarray, w: textbytes.Words | None = None,
         h: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For each text: (word gram weights summed, word grams, char gram weights summed, char grams)."""
    w = textbytes.words(t) if w is None else w
    h = textbytes.Spans(t.buf).hash(w.start, w.end) if h is None else h
    one, two = _word_grams(h)
    first, last = w.first[:-1], w.first[1:]
    # a running sum may end one gram before the last word's: texts of one word have no 2-gram
    run_one, run_two = _running(weight[one]), _running(np.concatenate([weight[two], [0.0]]))
    word = _between(run_one, first, last) + _between(run_two, first, last - 1)
    n_word = (last - first) + np.maximum(last - first - 1, 0)
    run = _running(np.concatenate([weight[_char_grams(t.buf)], np.zeros(min(3, len(t.buf)))]))
    a, b = t.bounds[:-1], t.bounds[1:]
    return word, n_word, _between(run, a, b - 3), np.maximum(b - a - 3, 0)


def counts(t: textbytes.Texts) -> np.ndarray:
    """Occurrences of every bucket in a slice of texts."""
    w = textbytes.words(t)
    one, two = _word_grams(textbytes.Spans(t.buf).hash(w.start, w.end))
    inner = np.ones(len(w.start), dtype=bool)  # a 2-gram begins at every word but a text's last
    inner[w.first[1:][w.first[1:] > w.first[:-1]] - 1] = False
    chars = np.ones(len(t.buf), dtype=bool)
    for back in (1, 2, 3):
        at = t.bounds[1:] - back
        chars[at[at >= t.bounds[:-1]]] = False
    grams = _char_grams(t.buf)
    out = np.bincount(one, minlength=BUCKETS)
    out += np.bincount(two[inner[:len(two)]], minlength=BUCKETS)
    out += np.bincount(grams[chars[:len(grams)]], minlength=BUCKETS)
    return out


def one_text(text: str) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(distinct buckets, their counts, word grams, char grams) of one text, for training."""
    import pyarrow as pa

    t = next(iter(textbytes.slices(pa.array([text], pa.large_string()))))
    w = textbytes.words(t)
    one, two = _word_grams(textbytes.Spans(t.buf).hash(w.start, w.end))
    chars = _char_grams(t.buf)
    at, n = np.unique(np.concatenate([one, two, chars]), return_counts=True)
    return at, n, len(one) + len(two), len(chars)
