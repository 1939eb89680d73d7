"""Quality rules: fixed counts per text, and a calibrated logistic regression over hashed n-grams.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  The model is a logistic
regression whose features are the relative frequencies of hashed word 1- and
2-grams and of hashed character 4-grams.  It is trained on labelled rows, at
most ``max_rows`` of each label by a seeded hash order of the key (that bound is
the only sample here), its margin is calibrated by Platt scaling on a held-out
fifth of them, and all documents are scored in Arrow batches, whole texts.

Defined results: a null or empty text has no words, zero counts and fails the
base rule; a text's counts depend on that text alone, so repeated rows get equal
results; without labels of both kinds the model gives every text probability 0.5,
which keeps it; an empty table of documents gives an empty table.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features, textbytes

MAX_ROWS = 2000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_RESULT = ", ".join(f"{c} long" for c in _COUNTS) + ", p_good double"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = np.arange(256) != 0x0A
_CODE_POINT = textbytes.WORD_BYTES & ((np.arange(256) & 0xC0) != 0x80)


@dataclass(frozen=True)
class Model:
    """Weights per bucket and the calibrated margin ``slope * (bias + word + char) + shift``."""

    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, word: np.ndarray, n_word: np.ndarray, char: np.ndarray, n_char: np.ndarray) -> np.ndarray:
        margin = self.bias + word / np.maximum(n_word, 1) + char / np.maximum(n_char, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def labelled_docs(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
                  key: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """(key, label, text) of at most ``max_rows`` keys of each label 0 and 1, first by a seeded hash of the key."""
    chosen = None
    for value in (0, 1):
        rows = (labels.where(F.col(label) == value).select(F.col(key).alias("__key"), F.lit(value).alias("__label"))
                .distinct().orderBy(F.xxhash64("__key", F.lit(seed)), "__key").limit(max_rows))
        chosen = rows if chosen is None else chosen.unionByName(rows)
    found = docs.join(F.broadcast(chosen), docs[key] == chosen["__key"])  # 2 * max_rows rows of two numbers
    return found.select(F.col("__key").alias("key"), F.col("__label").alias("label"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).dropDuplicates(["key"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets, shares = [], []
        for text in batch.column(2).to_pylist():
            at, n, n_word, n_char = features.one_text(text)
            buckets.append(at.astype(np.int32))
            shares.append((n / np.where(at < features.WORD_BUCKETS, max(n_word, 1), max(n_char, 1))).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int32())),
                                          pa.array(shares, pa.list_(pa.float32()))], names=["key", "label", "bucket", "share"])


def labelled_grams(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
                   key: str = "doc_id", text: str = "text", seed: int = 7) -> pa.Table:
    """Label and n-gram shares of the chosen rows, in order of their keys; a row has as many numbers as buckets at most."""
    found = labelled_docs(docs, labels, label, max_rows, key, text, seed)
    kind = found.schema["key"].dataType.simpleString()
    return found.mapInArrow(_grams, f"key {kind}, label int, bucket array<int>, share array<float>").orderBy("key").toArrow()


def fit(rows: pa.Table, steps: int = 200, rate: float = 0.5, decay: float = 1e-5, seed: int = 7) -> Model:
    """Train on ``labelled_grams``: full-batch Adagrad, classes weighted equally; a fifth of the rows calibrates."""
    y = rows["label"].to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(features.BUCKETS), 0.0)
    lists = rows["bucket"].combine_chunks()
    at = lists.flatten().to_numpy()
    value = rows["share"].combine_chunks().flatten().to_numpy().astype(np.float64)
    owner = np.repeat(np.arange(len(y)), np.diff(np.asarray(lists.offsets)))
    held = np.random.default_rng(seed).random(len(y)) < 0.2
    if len(set(y[~held].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held[:] = False
    share = np.where(y == 1, 0.5 / max((y[~held] == 1).sum(), 1), 0.5 / max((y[~held] == 0).sum(), 1)) * ~held
    weight, grad2 = np.zeros(features.BUCKETS), np.full(features.BUCKETS, 1e-8)
    bias, bias2 = 0.0, 1e-8
    scale = 50.0  # relative frequencies are small; the weights are kept in these units
    for _ in range(steps):
        margin = bias + scale * np.bincount(owner, weight[at] * value, minlength=len(y))
        error = share * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y)
        g = scale * np.bincount(at, error[owner] * value, minlength=features.BUCKETS) + decay * weight
        grad2 += g * g
        weight -= rate * g / np.sqrt(grad2)
        bias2 += error.sum() ** 2
        bias -= rate * error.sum() / np.sqrt(bias2)
    margin = bias + scale * np.bincount(owner, weight[at] * value, minlength=len(y))
    slope, shift = platt(margin[held], y[held]) if held.any() else (1.0, 0.0)
    return Model((weight * scale).astype(np.float64), float(bias), slope, shift)


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets (Platt's)."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ab = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ab @ x, -500, 500)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hessian, x @ (p - target)), -2, 2)
    return float(max(ab[0], 1e-3)), float(ab[1])


def _repeat_words(h: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    g = textbytes.grams(h, 3)
    if len(g) < 2:
        return 0
    order = np.argsort(g)
    same = g[order][1:] == g[order][:-1]
    twice = np.zeros(len(g), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(h), dtype=bool)
    for j in range(3):
        inside[j:j + len(g)] |= twice
    return int(inside.sum())


def measure(t: textbytes.Texts, model: Model) -> dict[str, np.ndarray]:
    """All counts and the model's probability for a slice of texts."""
    w, spans = textbytes.words(t), textbytes.Spans(t.buf)
    h = spans.hash(w.start, w.end)
    per_text = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[t.buf])])[t.bounds])
    line = textbytes.words(t, _LINE)
    worded = np.searchsorted(w.start, line.end) > np.searchsorted(w.start, line.start)
    owner = line.owner[worded]
    tag = spans.hash(line.start[worded], line.end[worded]) + textbytes.mix64(owner.astype(np.uint64))
    _, first = np.unique(tag, return_index=True)
    n_line, n_distinct = (np.bincount(o, minlength=t.count) for o in (owner, owner[first]))
    repeat = [_repeat_words(h[w.first[i]:w.first[i + 1]]) for i in range(t.count)]
    return {
        "n_words": np.diff(w.first), "word_chars": per_text(_CODE_POINT), "n_symbols": per_text(_SYMBOL),
        "n_dup_lines": n_line - n_distinct, "n_repeat_words": np.array(repeat, dtype=np.int64),
        "p_good": model.probability(*features.sums(t, model.weight, w, h)),
    }


def _measured(model: Model, text: str) -> Column:
    @F.arrow_udf(_RESULT)
    def run(column: pa.Array) -> pa.Array:
        parts = [measure(t, model) for t in textbytes.slices(column)]
        names = [*_COUNTS, "p_good"]
        types = [*[pa.int64()] * len(_COUNTS), pa.float64()]
        cols = [pa.array(np.concatenate([p[n] for p in parts] or [np.zeros(0)]), k) for n, k in zip(names, types)]
        return pa.StructArray.from_arrays(cols, names=names)
    return run(F.col(text).cast("string"))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` and a struct column ``out``: the counts, p_good, base_failed and kept."""
    m = docs.withColumn(out, _measured(model, text))
    c = lambda name: F.col(f"{out}.{name}")
    failed = (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"))
    return (m.withColumn(out, F.struct(f"{out}.*", failed.alias("base_failed")))
            .withColumn(out, F.struct(f"{out}.*", (~c("base_failed") & (c("p_good") >= KEEP_FROM)).alias("kept"))))


def keep(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that neither the base rule nor the model rejects, all columns as they were."""
    out = "__quality"
    return scored(docs, model, text, out).where(F.col(f"{out}.kept")).select(*docs.columns)
