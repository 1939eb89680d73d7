"""Class-aware k-means imputation of sentinel values (IM-01..IM-07, AG-06..AG-09).

Fit: global evidence medians → sentinel to NULL → temporary fill of every
feature with the class median → per-class population scaling → cluster search per
class (silhouette over k = 2..8, best of ``n_init`` restarts by inertia) → cluster
sizes and per (class, cluster, column) medians of the real values, falling
back to the class median and then the global median.

Transform: temporary fill (medians of the batch being transformed, as the
reference does, or the training medians with ``fill_stats="train"``) →
scale with the class's scaler → nearest centre → every sentinel cell takes
its (class, cluster) median; an unseen or NULL class takes the global medians.  The
model tables are small and reach the rows through checked broadcast joins or
inlined literals, so a transform with ``fill_stats="train"`` needs no shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions import is_sentinel
from . import steps
from .clustering import ClusterSearch, assign_nearest, kmeans_search
from .joins import lookup_join, small_table
from .quantiles import grouped_median
from .scaling import apply_scaler, fit_scaler
from .stats import class_medians, evidence, global_medians, median_fill, scalar_params, wide_params
from .validate import class_values, feature_columns, present_columns, widen

DEFAULT_K_RANGE = tuple(range(2, 9))


@dataclass
class KMeansImputerModel:
    target: str
    key: str
    impute_cols: list
    features: list
    class_aware: bool
    classes: list
    class_type: object
    sentinel: object
    global_medians: DataFrame
    fit_medians: DataFrame
    scaler: DataFrame
    centres: dict
    medians: DataFrame
    sizes: DataFrame
    search: ClusterSearch
    seed: int = 42
    auto_k: bool = True
    fill_stats: str = "batch"
    k: dict = field(default_factory=dict)


def fit(df: DataFrame, target: str, key: str, impute_cols: Sequence[str], *, n_clusters: int | None = None,
        class_aware: bool = True, seed: int = 42, sentinel=0, n_init: int = 10, max_iter: int = 300,
        tol: float = 1e-4, k_range: Sequence[int] = DEFAULT_K_RANGE, fill_stats: str = "batch",
        features: Sequence[str] | None = None) -> KMeansImputerModel:
    """IM-01 (class-aware) / CL-03 (global model when ``class_aware`` is False or no target)."""
    cols = present_columns(df, impute_cols)
    ca = class_aware and target in df.columns
    feats = list(features) if features is not None else feature_columns(df, target, exclude=[key])
    keys = [target] if ca else []
    gm = global_medians(df, cols, sentinel)
    cm = class_medians(df, target, cols, sentinel, fallback=gm) if ca else gm
    # temporary fills stand in columns of their own: the cluster medians below are those of real values
    filled = widen(df, cols).withColumns({f + "__t": F.col(f).cast("double") for f in feats if f not in cols})
    filled = median_fill(filled, cols, cm, keys, sentinel, global_fallback=gm, out_suffix="__t")
    filled = fill_missing(filled, df, feats, cols, keys, sentinel, gm, "__t")
    scaler = fit_scaler(filled.select(*keys, *[F.col(f + "__t").alias(f) for f in feats]), feats, keys)
    scaled = steps.table(apply_scaler(filled, feats, scaler, keys, suffix="__z", src_suffix="__t"), "scaled")

    classes = class_values(df, target) if ca else [None]
    ctype = df.schema[target].dataType if ca else IntegerType()
    idx = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])[F.col(target)] \
        if ca else F.lit(0)
    data = scaled.select(idx.alias("_cls"), F.col(key).alias("_key"),
                         *[F.col(f + "__z").alias(f"_x{j}") for j, f in enumerate(feats)])
    data = data.where(F.col("_cls").isNotNull())
    counts = {r["_cls"]: r["count"] for r in data.groupBy("_cls").count().collect()}  # one row per class
    k_choices = {}
    for i in range(len(classes)):
        n = counts.get(i, 0)
        if n == 0:
            continue
        if n_clusters is not None:
            ks = [n_clusters]
        else:
            hi = min(max(k_range), n - 1)
            ks = list(range(max(2, min(k_range)), hi + 1)) or [2]
        k_choices[i] = [min(k, n) for k in ks]
    search = kmeans_search(data, classes, len(feats), k_choices, n_init=n_init, max_iter=max_iter, tol=tol,
                           seed=seed, sizes=counts)

    # AG-06 / AG-07 on the fitted rows
    spark = df.sparkSession
    grid_schema = StructType([StructField(target if ca else "_class", ctype), StructField("cluster", IntegerType()),
                              StructField("count", LongType())])
    sizes = spark.createDataFrame([(c, j, int(n)) for c, ns in search.counts.items() for j, n in enumerate(ns)],
                                  grid_schema)
    gcol = target if ca else "_class"
    assigned = assign_nearest(scaled, [f + "__z" for f in feats], search.centres, target if ca else None)
    if not ca:
        assigned = assigned.withColumn("_class", F.lit(None).cast(ctype))
    fallback = cm if ca else gm.withColumn(gcol, F.lit(None).cast(ctype))
    medians = cluster_medians(assigned, gcol, "cluster", cols, fallback, sentinel,
                              grid=sizes.select(gcol, "cluster"), class_key=ca)
    steps.discard(scaled)
    return KMeansImputerModel(target, key, cols, feats, ca, classes, ctype, sentinel, gm, cm, scaler,
                              search.centres, medians, sizes, search, seed, n_clusters is None, fill_stats,
                              dict(search.k))


def fill_missing(filled: DataFrame, df: DataFrame, feats: Sequence[str], cols: Sequence[str], keys: Sequence[str],
                 sentinel, global_medians: DataFrame, suffix: str = "") -> DataFrame:
    """AG-03 for clustering: NULL and NaN features take the median of the row's key in ``df`` (sentinels left out
    in ``cols``), else the global median, else 0."""
    missing = lambda c: F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    counts = df.agg(*[F.count(F.when(missing(f), 1)).alias(f) for f in feats]).first()
    lacking = [f for f in feats if counts[f]]
    if not lacking:
        return filled
    med = grouped_median(evidence(df, [c for c in cols if c in lacking], sentinel), list(keys), lacking)
    glob = scalar_params(global_medians)
    if keys:
        filled = lookup_join(filled, small_table(wide_params(med, keys, lacking, "_fm_")), list(keys), "left")
        own = {f: F.col(f"_fm_{f}") for f in lacking}
    else:
        own = {f: F.lit(v).cast("double") for f, v in {**dict.fromkeys(lacking), **scalar_params(med)}.items()}
    values = {f + suffix: F.when(missing(f + suffix), F.coalesce(own[f], F.lit(glob.get(f)).cast("double"), F.lit(0.0)))
              .otherwise(F.col(f + suffix).cast("double")) for f in lacking}
    filled = filled.withColumns(values)
    return filled.drop(*[f"_fm_{f}" for f in lacking]) if keys else filled


def transform(model: KMeansImputerModel, df: DataFrame, fill_stats: str | None = None) -> DataFrame:
    """IM-02 / IM-03 / IM-04: fill sentinel cells; other cells are never changed."""
    fill_stats = fill_stats or model.fill_stats
    cols = present_columns(df, model.impute_cols)
    ca = model.class_aware
    if ca and model.target not in df.columns:
        raise ValueError(f"class-aware imputer needs the target column {model.target!r} at transform")
    keys = [model.target] if ca else []
    out = widen(df, cols)
    glob = scalar_params(model.global_medians)
    if fill_stats == "batch":
        med = class_medians(df, model.target, cols, model.sentinel, fallback=model.global_medians) if ca \
            else global_medians(df, cols, model.sentinel)
    elif fill_stats == "train":
        med = model.fit_medians
    else:
        raise ValueError("fill_stats must be 'batch' or 'train'")
    tmp = out.withColumns({f + "__t": F.col(f).cast("double") for f in model.features if f not in cols})
    tmp = median_fill(tmp, cols, med, keys, model.sentinel, global_fallback=model.global_medians, out_suffix="__t")
    if fill_stats == "batch":
        tmp = fill_missing(tmp, df, model.features, cols, keys, model.sentinel, model.global_medians, "__t")
    tmp = apply_scaler(tmp, model.features, model.scaler, keys, suffix="__z", src_suffix="__t")
    tmp = assign_nearest(tmp, [f + "__z" for f in model.features], model.centres,
                         model.target if ca else None, out="_cluster")
    tmp = fill_from_clusters(tmp, cols, model.medians, model.target if ca else None, "_cluster",
                             model.global_medians, model.sentinel)
    return tmp.select(*df.columns)


def cluster_medians(assigned: DataFrame, group: str, cluster: str, cols: Sequence[str], fallback: DataFrame,
                    sentinel=0, grid: DataFrame | None = None, class_key: bool = True) -> DataFrame:
    """AG-07: median of the real values per (group, cluster, column) → long table
    ``group, cluster, column, median``; a cluster without real values takes
    ``fallback`` (long, keyed by group and column when ``class_key``, else by
    column).  ``grid`` lists every (group, cluster) to report, empty ones too;
    by default the clusters seen in ``assigned``.
    """
    cols = list(cols)
    ev = evidence(assigned.select(group, cluster, *cols), cols, sentinel).where(F.col(cluster).isNotNull())
    per = grouped_median(ev, [group, cluster], cols)
    grid = grid if grid is not None else assigned.where(F.col(cluster).isNotNull()).select(group, cluster).distinct()
    grid = grid.withColumnRenamed(cluster, "cluster") if cluster != "cluster" else grid
    per = per.withColumnRenamed(cluster, "cluster") if cluster != "cluster" else per
    full = grid.select(group, "cluster", F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    on = [group, "column"] if class_key else ["column"]
    fb = fallback.select(*on, F.col("median").alias("_fb"))
    return small_table(full.join(per, [group, "cluster", "column"], "left").join(fb, on, "left")
                       .select(group, "cluster", "column", F.coalesce("median", "_fb").alias("median")))


def fill_from_clusters(df: DataFrame, cols: Sequence[str], medians: DataFrame, group: str | None, cluster: str,
                       global_fallback: DataFrame, sentinel=0) -> DataFrame:
    """IM-02/03/04: sentinel cells take the (group, cluster) median, else the
    global median (unseen class, no cluster).  One checked broadcast join."""
    cols = list(cols)
    glob = scalar_params(global_fallback)
    keys = ([group] if group else []) + [cluster]
    med = medians if cluster == "cluster" else medians.withColumnRenamed("cluster", cluster)
    params = small_table(wide_params(med, keys, cols, "_cm_"))
    out = lookup_join(df, params, keys, "left")
    fills = {c: F.when(is_sentinel(F.col(c), sentinel),
                       F.coalesce(F.col("_cm_" + c), F.lit(glob.get(c)).cast("double"))).otherwise(F.col(c))
             for c in cols}
    return out.withColumns(fills).drop(*["_cm_" + c for c in cols])


def fit_transform(df: DataFrame, target: str, key: str, impute_cols: Sequence[str], **kw) -> DataFrame:
    """IM-05."""
    return transform(fit(df, target, key, impute_cols, **kw), df)


def class_summary(model: KMeansImputerModel) -> DataFrame:
    """AG-08 per class: ``class, n_clusters, inertia, silhouette, n_iterations``."""
    s = model.search
    schema = StructType([StructField("class", model.class_type), StructField("n_clusters", IntegerType()),
                         StructField("inertia", DoubleType()), StructField("silhouette", DoubleType()),
                         StructField("n_iterations", IntegerType())])
    rows = [(c, int(s.k[c]), float(s.inertia[c]), float(s.silhouette[c]), int(s.n_iter[c])) for c in s.k]
    return model.medians.sparkSession.createDataFrame(rows, schema)


def summary(model: KMeansImputerModel) -> DataFrame:
    """AG-08: one row — clusters, inertia (class-aware: summed inertia ÷ summed
    rows), silhouette (mean over classes with ≥ 2 clusters, else 0), max
    iterations, seed, auto flag."""
    s = model.search
    tot_n = sum(sum(v) for v in s.counts.values())
    tot_i = sum(s.inertia.values())
    if model.class_aware:
        inertia = tot_i / tot_n if tot_n else 0.0
        sils = [s.silhouette[c] for c in s.k if s.k[c] > 1]
        sil = sum(sils) / len(sils) if sils else 0.0
        label = f"{len(s.k)} classes"
    else:
        inertia = tot_i
        sil = next(iter(s.silhouette.values()), 0.0)
        label = str(next(iter(s.k.values()), 0))
    row = [(label, model.class_aware, float(inertia), float(sil), int(max(s.n_iter.values(), default=0)),
            int(model.seed), bool(model.auto_k))]
    schema = ("n_clusters string, class_aware boolean, inertia double, silhouette double, n_iterations int, "
              "random_state int, auto_k boolean")
    return model.medians.sparkSession.createDataFrame(row, schema)


def clusters_per_class(model: KMeansImputerModel, df: DataFrame) -> DataFrame:
    """AG-09: class, clusters, class rows, rows per cluster."""
    if not model.class_aware:
        raise ValueError("clusters per class needs a class-aware model")
    ks = model.medians.sparkSession.createDataFrame(
        [(c, int(k)) for c, k in model.k.items()],
        StructType([StructField(model.target, model.class_type), StructField("clusters", IntegerType())]))
    counts = df.groupBy(model.target).agg(F.count(F.lit(1)).alias("rows"))
    return ks.join(counts, model.target, "left").select(
        F.col(model.target).alias("class"), "clusters", F.coalesce("rows", F.lit(0)).alias("rows"),
        (F.coalesce("rows", F.lit(0)) / F.col("clusters")).alias("rows_per_cluster"))


def impute_dataset(spark, input_path: str, output_path: str, target: str, key: str, impute_cols: Sequence[str],
                   **kw):
    """IM-07: read → fit → transform → write; returns (path, model)."""
    from ..sources import read_table, write_table
    df = read_table(spark, input_path)
    model = fit(df, target, key, impute_cols, **kw)
    write_table(transform(model, df), output_path)
    return output_path, model
