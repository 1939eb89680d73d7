"""Confusion matrix and classification metrics (AG-11, AG-12).

One aggregate over (label, prediction); positive class 1; an undefined
ratio is 0 (``zero_division=0``).  A one-class set gives zeros in the absent
cells instead of failing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_div


def confusion(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """AG-11 → one row ``tn, fp, fn, tp`` (bigint)."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    return df.agg(F.count(F.when(~y & ~p, 1)).alias("tn"), F.count(F.when(~y & p, 1)).alias("fp"),
                  F.count(F.when(y & ~p, 1)).alias("fn"), F.count(F.when(y & p, 1)).alias("tp"))


def with_scores(cm: DataFrame) -> DataFrame:
    """AG-12 from a confusion row (any leading grouping columns are kept)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cm.withColumns({
        "accuracy": safe_div(tn + tp, tn + fp + fn + tp),
        "precision": safe_div(tp, tp + fp),
        "recall": safe_div(tp, tp + fn),
        "f1": safe_div(2 * tp, 2 * tp + fp + fn),
    })


def classification_metrics(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """AG-12 → one row ``accuracy, precision, recall, f1, tn, fp, fn, tp``."""
    return with_scores(confusion(df, label, prediction, positive)).select(
        "accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp")


def grouped_f1(df: DataFrame, keys: list[str], label: str, prediction: str, positive=1) -> DataFrame:
    """F1 of the positive class per group (e.g. per (k, fold)), and its rows ``n``."""
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    cm = df.groupBy(*keys).agg(F.count(F.when(~y & p, 1)).alias("fp"), F.count(F.when(y & ~p, 1)).alias("fn"),
                               F.count(F.when(y & p, 1)).alias("tp"), F.count(F.lit(1)).alias("n"))
    return cm.select(*keys, "n", safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))
