"""Quality classifier by importance resampling of hashed n-grams, sampled by Gumbel top-k.

Two generative models give every hashed n-gram (words, word pairs, character
4-grams) a probability: one counted over target texts, one over all raw texts.
A document's mean log ratio target / raw over its n-grams, tempered by a slope
and shift fitted on labelled rows (n-grams of a text are far from independent,
so their plain sum would be overconfident), is its log importance weight.  Its
key is that weight plus Gumbel noise from a seeded hash of its id, and the k
documents with the largest keys are the sample: a draw of k without replacement
in proportion to the weights.  By default k is the number of documents more
likely good than not: log weight plus the log odds of good labels at least 0.

The target model is fitted on at most ``target_rows`` good labelled rows and the
tempering on at most ``calibration_rows`` of each label, by seeded hash orders
(the only samples); the raw counts cover all documents, as do the weights, k and
the cut.  The models have a fixed number of buckets.

Defined results: a null or empty text has mean log ratio 0 and competes with it;
a null id draws the noise of the null value; rows with equal keys at the cut all
stay, so repeated rows are kept or rejected together; without labels of both
kinds every weight is 1 and every document is kept; an empty table of documents
gives an empty table.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import features, quality_rules, stages, textbytes

TARGET_ROWS = 4000
CALIBRATION_ROWS = 1000
#: Counts that a model's prior is worth: the raw shares, times this part of the target's own counts.
PRIOR = 0.1
_PARTS = 1 << 16
_SCALE = 1e6


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(features.BUCKETS, dtype=np.int64)
    for batch in batches:
        for t in textbytes.slices(batch.column(0)):
            total += features.counts(t)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])


def gram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of each bucket over all documents: counted per task, then summed."""
    found = docs.select(F.col(text).cast("string")).mapInArrow(_count, "bucket int, n long")
    rows = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    out = np.zeros(features.BUCKETS)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def target_docs(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = TARGET_ROWS,
                key: str = "doc_id", seed: int = 11) -> DataFrame:
    """The documents of at most ``max_rows`` keys with label 1, first by a seeded hash."""
    rows = (labels.where(F.col(label) == 1).select(F.col(key).alias("__key")).distinct()
            .orderBy(F.xxhash64("__key", F.lit(seed)), "__key").limit(max_rows))
    return docs.join(F.broadcast(rows), docs[key] == rows["__key"], "left_semi")  # max_rows numbers


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log of target / raw probability of each bucket; word and character grams are one distribution each."""
    out = np.zeros(features.BUCKETS)
    for part in (slice(0, features.WORD_BUCKETS), slice(features.WORD_BUCKETS, features.BUCKETS)):
        q = (raw[part] + 1) / (raw[part] + 1).sum()
        total = target[part].sum()
        p = (target[part] + (prior * total + 1) * q) / ((1 + prior) * total + 1)
        out[part] = np.log(p) - np.log(q)
    return out


def _mean_ratio(t: textbytes.Texts, ratio: np.ndarray) -> np.ndarray:
    word, n_word, char, n_char = features.sums(t, ratio)
    return (word + char) / np.maximum(n_word + n_char, 1)


@dataclass(frozen=True)
class Model:
    """Log ratio per bucket, the tempering, and the log odds of good labels."""

    ratio: np.ndarray
    slope: float
    shift: float
    log_odds: float


def log_weight(model: Model, text: Column) -> Column:
    """Log importance weight of whole texts."""
    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = [_mean_ratio(t, model.ratio) for t in textbytes.slices(column)]
        return pa.array(model.slope * np.concatenate(parts or [np.zeros(0)]) + model.shift, pa.float64())
    return run(text.cast("string"))


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise from a hash of the key."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, by repeated histograms of at most 65,536 bins."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None or k < 1:
        return None
    while lo < hi:
        width = (hi - lo) // _PARTS + 1
        rows = (df.where(F.col(column).between(lo, hi))
                .groupBy(F.expr(f"({column} - {lo}L) div {width}L").alias("bin")).count().toArrow())
        bins, n = rows["bin"].to_numpy(), rows["count"].to_numpy()
        order = np.argsort(-bins)
        above = np.cumsum(n[order])
        at = int(np.searchsorted(above, k))
        if at >= len(bins):
            return lo
        k -= int(above[at] - n[order[at]])
        lo, hi = lo + int(bins[order[at]]) * width, min(hi, lo + (int(bins[order[at]]) + 1) * width - 1)
    return lo


def _weighed(docs: DataFrame, model: Model, seed: int, key: str, text: str) -> DataFrame:
    noisy = F.col("__log_weight") + gumbel(F.col(key), seed)
    return (docs.withColumn("__log_weight", log_weight(model, F.col(text)))
            .withColumn("__rank", F.round(noisy * _SCALE).cast("long")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
        target_rows: int = TARGET_ROWS, calibration_rows: int = CALIBRATION_ROWS,
        labelled: DataFrame | None = None) -> Model:
    """Count both models and temper their ratio on labelled rows, which are ``labelled``'s (by default ``docs``')."""
    labelled = docs if labelled is None else labelled
    sample = quality_rules.labelled_docs(labelled, labels, label, calibration_rows, key, text, seed=12)
    kinds = {r[0] for r in labels.where(F.col(label).isin(0, 1)).select(label).distinct().collect()}
    if len(kinds) < 2:
        return Model(np.zeros(features.BUCKETS), 0.0, 0.0, 0.0)
    share = labels.where(F.col(label).isin(0, 1)).agg(F.avg(label)).first()[0]
    target = gram_counts(target_docs(labelled, labels, label, target_rows, key), text)
    ratio = log_ratio(target, gram_counts(docs, text))
    judged = sample.select("label", log_weight(Model(ratio, 1.0, 0.0, 0.0), F.col("text")).alias("mean")).toArrow()
    y, mean = judged["label"].to_numpy().astype(np.float64), judged["mean"].to_numpy()
    if len(set(y.tolist())) < 2:  # labels of rows that are not there
        return Model(np.zeros(features.BUCKETS), 0.0, 0.0, 0.0)
    spread = float(mean.std()) or 1.0
    slope, shift = quality_rules.platt(mean / spread, y)
    slope /= spread
    shift -= float(np.log(y.sum() / (len(y) - y.sum())))  # back to equal classes: the labels' odds come in later
    return Model(ratio, slope, shift, float(np.log(share / (1 - share))))


def _cut(rows: DataFrame, model: Model, k: int | None) -> int:
    if k is None:
        k = rows.where(F.col("__log_weight") + model.log_odds >= 0).count()
    cut = kth_largest(rows, "__rank", k)
    return (1 << 63) - 1 if cut is None else cut


def resample(docs: DataFrame, model: Model, k: int | None = None, seed: int = 13,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (key, log_weight, sample_key, kept)."""
    rows = stages.table(_weighed(docs.select(key, text), model, seed, key, text)
                        .select(F.col(key), "__log_weight", "__rank"), "weights")
    cut = _cut(rows, model, k)
    return rows.select(key, F.col("__log_weight").alias("log_weight"),
                       (F.col("__rank") / _SCALE).alias("sample_key"), (F.col("__rank") >= F.lit(cut)).alias("kept"))


def keep(docs: DataFrame, model: Model, k: int | None = None, seed: int = 13,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """The sampled documents, all columns as they were (weights are computed again rather than joined)."""
    rows = stages.table(_weighed(docs.select(key, text), model, seed, key, text).select("__log_weight", "__rank"), "weights")
    cut = _cut(rows, model, k)
    return _weighed(docs, model, seed, key, text).where(F.col("__rank") >= F.lit(cut)).select(*docs.columns)
