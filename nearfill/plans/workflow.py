"""End-to-end run (PL-01..PL-03): split → impute → classify → report.

Every stage is a table in the shared checkpoint folder, written once and read by those after it: a lost
executor repeats its part of one stage, and nothing stays cached.

Returns a dict of DataFrames — train, test, train_imputed, test_imputed,
predictions, split_profile, imputation_profile, metrics, k_scores, plus the
imputer's reports — and optionally writes them (IO-02).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import classify, sampling, stats, steps
from ..sources import write_table


def run(df: DataFrame, target: str, key: str, *, imputer: str | None = "kmeans",
        impute_cols: Sequence[str] = (), test_size: float = 0.2, seed: int = 42,
        test_imputation: str = "train_fitted", sentinel=0, output: str | None = None,
        fmt: str = "csv", classifier_args: dict | None = None, **imputer_args) -> dict[str, DataFrame]:
    """PL-01 (``imputer`` = "kmeans" or "knn") and PL-02 (``imputer=None``).

    ``classifier_args`` are settings of ``classify.fit`` (n_neighbors, metric, cv_folds,
    k_range, n_features, ...); ``seed`` serves split, imputer and folds alike.
    """
    split = steps.table(sampling.stratified_split(df, target, [key], test_size, seed), "split")
    train = split.where("split = 'train'").drop("split")
    test = split.where("split = 'test'").drop("split")
    out: dict[str, DataFrame] = {"train": train, "test": test,
                                 "split_profile": stats.split_profile(split, "split", target)}
    cols = [c for c in impute_cols if c in df.columns]
    if imputer is None or not cols:
        train_i, test_i = train, test
    elif imputer == "kmeans":
        from ..operators import impute_kmeans as km
        model = km.fit(train, target, key, cols, seed=seed, sentinel=sentinel, **imputer_args)
        train_i = steps.table(km.transform(model, train), "train")
        if test_imputation == "refit":
            test_i = km.fit_transform(test, target, key, cols, seed=seed, sentinel=sentinel, **imputer_args)
        else:
            test_i = km.transform(model, test)
        out.update({"cluster_summary": km.summary(model), "cluster_sizes": model.sizes,
                    "cluster_medians": model.medians})
        if model.class_aware:
            out["clusters_per_class"] = km.clusters_per_class(model, train)
    elif imputer == "knn":
        from ..operators import impute_knn as kn
        model = kn.fit(train, target, key, cols, sentinel=sentinel, **imputer_args)
        train_i = steps.table(kn.transform(model, train), "train")
        if test_imputation == "refit":
            test_i = kn.transform(kn.fit(test, target, key, cols, sentinel=sentinel, **imputer_args), test)
        else:
            test_i = kn.transform(model, test)
        out["imputer_summary"] = kn.summary(model)
    else:
        raise ValueError(f"unknown imputer {imputer!r}")
    if imputer is not None and cols:
        out["imputation_profile"] = stats.imputation_profile(train, train_i, cols, sentinel)
    test_i = test_i if test_i is test else steps.table(test_i, "test")
    model, preds, scores = classify.fit_evaluate_write(train_i, test_i, target, key, **{"seed": seed, **(classifier_args or {})})
    out.update({"train_imputed": train_i, "test_imputed": test_i, "predictions": preds, "metrics": scores,
                "classifier_summary": classify.summary(model)})
    if model.k_scores is not None:
        out["k_scores"] = model.k_scores
    if output:
        for name in ("train", "test", "train_imputed", "test_imputed", "predictions"):
            write_table(out[name], f"{output.rstrip('/')}/{name}", fmt)
    return out
