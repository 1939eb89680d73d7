"""Distance-weighted nearest-neighbour classifier (KC-01, KC-02, KC-06..08, AG-13).

Fit scales the training rows with population statistics (once, on the whole
training set, as the reference does), optionally keeps the top features by
mutual information, and — when ``n_neighbors`` is None — chooses k by
stratified cross-validated F1 with a *uniform* vote.  The whole k search is a
single neighbour join: each training row looks for its ``max(k_range)``
nearest rows of a different fold, then running label counts give the vote for
every k at once.  A k that some row cannot be given (too few rows in the other
folds) is left out of the scores.

Prediction is one neighbour join of the scaled rows against the scaled
training rows, with an inverse-distance vote; predictions, probabilities and
metrics all come from that one result.  Every input row comes back: one with a
NULL or NaN feature has no prediction, and ``evaluate`` refuses such a set.
Training rows must have all their features.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as M
from . import steps
from .joins import small_table
from .neighbors import knn_join, top_share, uniform_votes, vote_shares, weighted_vote
from .sampling import stratified_folds
from .scaling import apply_scaler, fit_scaler
from .validate import WIDE_CLASSES, class_values, feature_columns, require_target

DEFAULT_K_RANGE = tuple(range(3, 31, 2))


@dataclass
class KNNClassifierModel:
    target: str
    key: str
    features: list
    selected: list
    classes: list | None  # ascending; None if there are more than WIDE_CLASSES
    k: int
    auto_k: bool
    metric: str
    p: float
    scaler: DataFrame
    train: DataFrame  # key, target, scaled features
    k_scores: DataFrame | None = None
    feature_scores: DataFrame | None = None
    k_score_map: dict = field(default_factory=dict)


def cv_k_scores(scaled: DataFrame, target: str, key: str, features: Sequence[str],
                k_range: Sequence[int] = DEFAULT_K_RANGE, folds: int = 5, seed: int = 42,
                metric: str = "euclidean", p: float = 2.0, positive=1) -> DataFrame:
    """KC-02: mean over folds of the F1 of a uniform k-vote → (k, f1)."""
    ks = sorted(int(k) for k in k_range)
    n_rows = scaled.count()
    folded = stratified_folds(scaled, target, [key], folds, seed).repartition(steps.parts(scaled.sparkSession, n_rows))
    folded = steps.numbered(folded, "folds")
    nb = knn_join(folded, folded, max(ks), features, query_id=key, ref_id=key, metric=metric, p=p,
                  exclude_same="fold", query_carry=[target, "fold"], ref_carry=[target], query_row=steps.ROW)
    votes = uniform_votes(nb, "query_row", f"nb_{target}", ks, carry=["fold", target])
    per_fold = M.grouped_f1(votes, ["k", "fold"], target, "prediction", positive)
    per_k = per_fold.groupBy("k").agg(F.avg("f1").alias("f1"), F.sum("n").alias("n")).where(F.col("n") == n_rows)
    return per_k.select(F.col("k").cast("int").alias("k"), "f1")


def choose_k(k_scores: DataFrame, default: int = 5) -> tuple[int, dict]:
    """Highest mean F1, the smallest k among equals; ``default`` if none is above 0.

    Scores are compared at 12 decimals so that equal means summed in a
    different order still tie.
    """
    scores = {int(r["k"]): float(r["f1"]) for r in k_scores.collect()}
    best_k, best = default, 0.0
    for k in sorted(scores):
        if round(scores[k], 12) > best:
            best_k, best = k, round(scores[k], 12)
    return best_k, scores


def fit(train: DataFrame, target: str, key: str, *, features: Sequence[str] | None = None,
        n_neighbors: int | None = None, metric: str = "euclidean", p: float = 2.0, cv_folds: int = 5,
        seed: int = 42, k_range: Sequence[int] = DEFAULT_K_RANGE, n_features: int | None = None,
        positive=1) -> KNNClassifierModel:
    """KC-01: scale → (select) → choose k → keep the scaled training rows."""
    require_target(train, target)
    feats = list(features) if features is not None else feature_columns(train, target, exclude=[key])
    classes = class_values(train, target, WIDE_CLASSES)
    lacking = train.where(_unusable(feats)).count()
    if lacking:
        raise ValueError(f"{lacking} training rows have a NULL or NaN feature")
    scaler = fit_scaler(train, feats)
    scaled = steps.table(apply_scaler(train, feats, scaler).select(key, target, *feats), "scaled")
    selected, fscores = feats, None
    if n_features is not None and n_features < len(feats):
        from .select import mutual_information, top_features
        fscores = mutual_information(scaled, target, key, feats, seed=seed)
        selected = top_features(fscores, n_features, feats)
    k_scores, score_map = None, {}
    k = n_neighbors
    if k is None:
        k_scores = small_table(cv_k_scores(scaled, target, key, selected, k_range, cv_folds, seed,
                                           metric, p, positive))
        k, score_map = choose_k(k_scores)
    return KNNClassifierModel(target, key, feats, list(selected), classes, int(k), n_neighbors is None, metric, p,
                              scaler, scaled, k_scores, fscores, score_map)


def _unusable(feats: Sequence[str]):
    """Whether a row lacks a feature (NULL or NaN)."""
    return F.greatest(*[F.coalesce(F.isnan(F.col(f).cast("double")), F.lit(False)) | F.col(f).isNull()
                        for f in [*feats, feats[0]]])


def _neighbors(model: KNNClassifierModel, df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The k nearest training rows of every row of ``df`` that has all features, told apart by ``query_row``."""
    scaled = apply_scaler(df, model.features, model.scaler, suffix="__z")
    return knn_join(scaled, model.train, model.k, [f + "__z" for f in model.selected], query_id=model.key,
                    ref_id=model.key, ref_features=model.selected, metric=model.metric, p=model.p,
                    query_carry=list(carry), ref_carry=[model.target])


def predict(model: KNNClassifierModel, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """KC-06/07: ``key, *carry, prediction, proba_<i>`` for every row of ``df``; NULLs where a feature is missing.

    Keys may repeat or be NULL: each row has its own vote.  With more than
    ``WIDE_CLASSES`` classes the columns are ``prediction, probability`` (of the
    predicted class); ``predict_proba`` gives the others.
    """
    carry, nb = list(carry), _neighbors(model, df, carry)
    if model.classes is None:
        rows = nb.where("rank = 1").select("query_row", model.key, *carry)
        votes = rows.join(top_share(vote_shares(nb, "query_row", f"nb_{model.target}"), "query_row"), "query_row").drop("query_row")
    else:
        votes = weighted_vote(nb, "query_row", f"nb_{model.target}", model.classes, carry=[model.key, *carry]).drop("query_row")
    nothing = [F.lit(None).cast(votes.schema[c].dataType).alias(c) for c in votes.columns[1 + len(carry):]]
    return votes.unionByName(df.where(_unusable(model.selected)).select(model.key, *carry, *nothing))


def predict_proba(model: KNNClassifierModel, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """KC-07 in long form, for any number of classes: ``query_row, key, *carry, class, probability``, a row per class
    among a row's neighbours (others have probability 0); rows that lack a feature have none."""
    nb = _neighbors(model, df, carry)
    rows = nb.where("rank = 1").select("query_row", model.key, *carry)
    return rows.join(vote_shares(nb, "query_row", f"nb_{model.target}"), "query_row").select(
        "query_row", model.key, *carry, "class", F.col("share").alias("probability"))


def positive_index(model: KNNClassifierModel, positive=1) -> int:
    return model.classes.index(positive) if positive in model.classes else len(model.classes) - 1


def prediction_table(model: KNNClassifierModel, df: DataFrame, positive=1) -> DataFrame:
    """KC-08: the input rows plus ``Prediction`` and ``Probability`` (of the positive class; with more than
    ``WIDE_CLASSES`` classes, of the predicted one)."""
    cols = [c for c in df.columns if c != model.key]
    votes = predict(model, df, carry=cols)
    share = "probability" if model.classes is None else f"proba_{positive_index(model, positive)}"
    return votes.select(model.key, *cols, F.col("prediction").alias("Prediction"), F.col(share).alias("Probability"))


def evaluate(model: KNNClassifierModel, df: DataFrame, positive=1, predictions: DataFrame | None = None) -> DataFrame:
    """AG-11/12 on ``df`` → one row with the metrics, ``n_neighbors`` and ``auto_k``.

    A set with rows that could not be scored, or have no label, is refused, as
    are predictions that are not one for each row.
    """
    preds = predictions if predictions is not None else steps.table(predict(model, df, carry=[model.target]), "predictions")
    pred_col = "Prediction" if "Prediction" in preds.columns else "prediction"
    lost = F.col(pred_col).isNull() | F.col(model.target).isNull()
    found = preds.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(lost, 1)).alias("lost")).first()
    if found.lost:
        raise ValueError(f"{found.lost} rows have no prediction or no label")
    rows = df.count()
    if found.n != rows:
        raise ValueError(f"{found.n} predictions for {rows} rows")
    m = M.classification_metrics(preds, model.target, pred_col, positive)
    return m.withColumns({"n_neighbors": F.lit(model.k).cast("int"), "auto_k": F.lit(model.auto_k)})


def fit_evaluate_write(train: DataFrame, test: DataFrame, target: str, key: str, output: str | None = None,
                       fmt: str = "csv", positive=1, **settings) -> tuple[KNNClassifierModel, DataFrame, DataFrame]:
    """KC-08 as one job: fit with the given settings, score ``test``, write the prediction table.

    Returns (model, predictions, metrics).
    """
    from ..sources import write_table
    model = fit(train, target, key, positive=positive, **settings)
    predictions = steps.table(prediction_table(model, test, positive), "predictions")
    scores = evaluate(model, test, positive, predictions)
    if output:
        write_table(predictions, output, fmt)
    return model, predictions, scores


def summary(model: KNNClassifierModel) -> DataFrame:
    """AG-13: one row -- k, auto flag, metric, features, k → F1 map, F1 of the chosen k, feature importances
    (mutual information; empty if no features were selected)."""
    spark = model.train.sparkSession
    best = model.k_score_map.get(model.k, 0.0) if model.k_score_map else 0.0
    scores = {} if model.feature_scores is None else {r["feature"]: float(r["score"]) for r in model.feature_scores.collect()}
    row = [(model.k, model.auto_k, model.metric, list(model.features), list(model.selected), len(model.selected),
            {int(k): float(v) for k, v in model.k_score_map.items()}, float(best), scores)]
    schema = ("n_neighbors int, auto_k boolean, metric string, feature_columns array<string>, "
              "selected_features array<string>, n_features_selected int, k_scores map<int,double>, "
              "best_k_score double, feature_importances map<string,double>")
    return spark.createDataFrame(row, schema)
