"""Nearest-neighbour imputation of sentinel values (IM-08..IM-14, AG-10).

Fit keeps the global evidence medians and one population scaler per class
(fitted on rows whose sentinels were temporarily replaced by the class
median).  Transform fills the listed columns **in order**; each step sees
the values filled by the previous ones:

* donors: rows of the class whose value in the column is real; their scaled
  features come from the rows as they are (sentinels in other columns kept,
  ``reference_fill="raw"``, as the reference does) or median-filled
  (``"median"``);
* queries: rows whose value is the sentinel; sentinels in their other
  features take the global median before scaling;
* the k nearest donors within the class (exact pivot-pruned join on the
  features other than the column) give an inverse-distance weighted mean
  (weights ``1/(d + 1e-10)``) or, for any other ``weights``, their median;
* a class with fewer than k rows, a column with fewer than k donors in the
  class, a column without another feature, and an unseen or NULL class fall back
  to the global median.

Rows are numbered and written once; keys may repeat or be NULL.  A step writes
its fills (row number, column, value) into one folder of the shared checkpoint
folder; later steps join the table with what the folder holds, as does the result, so no plan
grows with the number of columns.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_sentinel, not_sentinel
from . import steps
from .joins import lookup_join, small_table
from .neighbors import knn_join
from .scaling import apply_scaler, fit_scaler
from .stats import class_medians, global_medians, median_fill, scalar_params
from .validate import class_table, feature_columns, present_columns, widen


@dataclass
class KNNImputerModel:
    target: str
    key: str
    impute_cols: list
    features: list
    class_aware: bool
    classes: DataFrame | None
    n_neighbors: int
    weights: str
    sentinel: object
    reference_fill: str
    global_medians: DataFrame
    scaler: DataFrame
    random_state: int = 42


def fit(df: DataFrame, target: str, key: str, impute_cols: Sequence[str], *, n_neighbors: int = 5,
        class_aware: bool = True, weights: str = "distance", sentinel=0, reference_fill: str = "raw",
        features: Sequence[str] | None = None, random_state: int = 42) -> KNNImputerModel:
    """IM-08: global medians + per-class scaler on median-filled rows."""
    cols = present_columns(df, impute_cols)
    ca = class_aware and target in df.columns
    feats = list(features) if features is not None else feature_columns(df, target, exclude=[key])
    keys = [target] if ca else []
    gm = global_medians(df, cols, sentinel)
    med = class_medians(df, target, cols, sentinel, fallback=gm) if ca else gm
    filled = median_fill(widen(df, cols), cols, med, keys, sentinel, global_fallback=gm)
    scaler = fit_scaler(filled, feats, keys)
    classes = class_table(df, target) if ca else None
    return KNNImputerModel(target, key, cols, feats, ca, classes, int(n_neighbors), weights, sentinel,
                           reference_fill, gm, scaler, random_state)


def transform(model: KNNImputerModel, df: DataFrame) -> DataFrame:
    """IM-09/10/11/12/13: fill sentinel cells column by column."""
    spark = df.sparkSession
    cols = present_columns(df, model.impute_cols)
    ca = model.class_aware and model.target in df.columns
    k, key, s = model.n_neighbors, model.key, model.sentinel
    glob = scalar_params(model.global_medians)
    gl = {c: F.lit(glob.get(c)).cast("double") for c in cols}

    wide = widen(df, cols).withColumn("_grp", F.col(model.target) if ca else F.lit(0))
    sizes = wide.groupBy("_grp").agg(F.count(F.lit(1)).alias("_class_n")).where(F.col("_class_n") >= k)
    if ca:
        sizes = sizes.join(model.classes.select(F.col(model.target).alias("_grp")), "_grp", "left_semi")
    known = small_table(sizes.select("_grp", F.lit(True).alias("_known")))
    # IM-03 / IM-13: unseen or NULL class, or a class smaller than k → global medians everywhere
    wide = lookup_join(wide, known, ["_grp"], "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    base = wide.withColumns({c: F.when(~F.col("_known") & is_sentinel(F.col(c), s), gl[c]).otherwise(F.col(c)) for c in cols})
    base = steps.numbered(base.repartition(steps.parts(spark, df.count())), "imputed")
    keys = ["_grp"] if ca else []
    scaler = model.scaler.withColumnRenamed(model.target, "_grp") if ca else model.scaler
    folder, kinds = steps.folder(spark, "fills"), f"`{steps.ROW}` long, _col int, _fill double"

    def filled(done: int) -> DataFrame:
        """The table with the fills of the first ``done`` columns."""
        if not done:
            return base
        delta = spark.read.schema(kinds).parquet(f"{folder}/*")
        wide = delta.groupBy(steps.ROW).agg(*[F.max(F.when(F.col("_col") == i, F.col("_fill"))).alias(f"_fill{i}") for i in range(done)])
        both = base.join(wide, steps.ROW, "left")
        return both.withColumns({c: F.coalesce(f"_fill{i}", c) for i, c in enumerate(cols[:done])}).drop(
            *[f"_fill{i}" for i in range(done)])

    for at, col in enumerate(cols):
        others = [f for f in model.features if f != col]
        data = filled(at).where("_known")
        queries = data.where(is_sentinel(F.col(col), s))
        rows = queries.select(steps.ROW)
        if others:
            donors = data.where(not_sentinel(F.col(col), s) & F.col(col).isNotNull())
            filling = {f: F.when(is_sentinel(F.col(f), s), gl[f]).otherwise(F.col(f)) for f in others if f in cols}
            if model.reference_fill == "median":
                donors = donors.withColumns(filling)
            elif model.reference_fill != "raw":
                raise ValueError("reference_fill must be 'raw' or 'median'")
            dz = apply_scaler(donors, model.features, scaler, keys, suffix="__z")
            qz = apply_scaler(queries.withColumns(filling), model.features, scaler, keys, suffix="__z")
            nb = knn_join(qz, dz, k, [f + "__z" for f in others], query_id=key, ref_id=key, group=["_grp"], ref_carry=[col],
                          query_row=steps.ROW)
            v = F.col(f"nb_{col}")
            if model.weights == "distance":
                w = F.lit(1.0) / (F.col("distance") + F.lit(1e-10))
                value = F.sum(w * v) / F.sum(w)
            else:
                value = F.median(v)
            # fewer than k donors give fewer than k neighbours, hence no value
            found = nb.groupBy(F.col("query_row").alias(steps.ROW)).agg(value.alias("_fill"), F.count(F.lit(1)).alias("_nn")).where(
                F.col("_nn") >= k).select(steps.ROW, "_fill")
            rows = rows.join(found, steps.ROW, "left")
        else:
            rows = rows.withColumn("_fill", F.lit(None).cast("double"))
        rows.select(steps.ROW, F.lit(at).alias("_col"), F.coalesce("_fill", gl[col]).alias("_fill")).write.parquet(f"{folder}/step{at}")
    return filled(len(cols)).select(*df.columns)


def fit_transform(df: DataFrame, target: str, key: str, impute_cols: Sequence[str], **kw) -> DataFrame:
    return transform(fit(df, target, key, impute_cols, **kw), df)


def summary(model: KNNImputerModel) -> DataFrame:
    """AG-10: parameters, global medians, number of class scalers."""
    spark = model.global_medians.sparkSession
    gm = {r["column"]: (float(r["median"]) if r["median"] is not None else None)
          for r in model.global_medians.collect()}
    row = [(model.n_neighbors, model.class_aware, model.weights, model.random_state, gm,
            model.classes.count() if model.class_aware else 1)]
    return spark.createDataFrame(row, "n_neighbors int, class_aware boolean, weights string, random_state int, "
                                      "global_medians map<string,double>, n_classes int")


def impute_dataset_knn(spark, input_path: str, output_path: str, target: str, key: str,
                       impute_cols: Sequence[str], **kw):
    """IM-14: read → fit → transform → write; returns (path, model)."""
    from ..sources import read_table, write_table
    df = read_table(spark, input_path)
    model = fit(df, target, key, impute_cols, **kw)
    write_table(transform(model, df), output_path)
    return output_path, model
