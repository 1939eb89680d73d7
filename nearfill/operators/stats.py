"""Medians, median fill and profiles (AG-01..AG-05).

Medians come back in long form ``(keys..., column, median)`` — a parameter
table with one row per class and column — and are applied with a checked
broadcast lookup join plus one projection.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import is_sentinel, sentinel_to_null
from .joins import lookup_join, small_table
from .quantiles import grouped_median


def evidence(df: DataFrame, cols: Sequence[str], sentinel=0) -> DataFrame:
    """PF-04 on a set of columns: sentinel → NULL, as double."""
    return df.withColumns({c: sentinel_to_null(F.col(c), sentinel).cast("double") for c in cols})


def global_medians(df: DataFrame, cols: Sequence[str], sentinel=0, method: str = "ranked") -> DataFrame:
    """AG-01: median of the non-sentinel values of each column → (column, median).

    A column without evidence falls back to the median of the raw column,
    which is the sentinel itself (NULL when the column has no values at all).
    """
    cols = list(cols)
    med = grouped_median(evidence(df, cols, sentinel), [], cols, method=method)
    has_any = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    anyrows = has_any.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(c) > 0).alias("_has")) for c in cols])))
    out = anyrows.join(med, "column", "left").select(
        "column",
        F.coalesce(F.col("median"), F.when(F.col("_has"), F.lit(float(sentinel)))).alias("median"))
    return small_table(out)


def class_medians(df: DataFrame, target: str, cols: Sequence[str], sentinel=0,
                  fallback: DataFrame | None = None, method: str = "ranked") -> DataFrame:
    """AG-02: per-class median of the evidence → (class, column, median).

    A (class, column) without evidence falls back to ``fallback`` (global
    medians, AG-01), then to 0.  Every class × column pair is present.
    """
    cols = list(cols)
    med = grouped_median(evidence(df, cols, sentinel), [target], cols, method=method)
    fallback = fallback if fallback is not None else global_medians(df, cols, sentinel, method)
    classes = df.select(target).where(F.col(target).isNotNull()).distinct()
    grid = classes.select(target, F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    out = (grid.join(med, [target, "column"], "left")
           .join(fallback.withColumnRenamed("median", "_g"), "column", "left")
           .select(target, "column", F.coalesce("median", "_g", F.lit(0.0)).alias("median")))
    return small_table(out)


def wide_params(long: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str,
                value: str = "median") -> DataFrame:
    """Long parameter table → one row per key with ``prefix+column`` columns."""
    keys = list(keys)
    if not keys:
        return long.agg(*[F.first(F.when(F.col("column") == c, F.col(value)), ignorenulls=True).alias(prefix + c)
                          for c in cols])
    return long.groupBy(*keys).agg(*[F.first(F.when(F.col("column") == c, F.col(value)), ignorenulls=True)
                                     .alias(prefix + c) for c in cols])


def scalar_params(long: DataFrame, value: str = "median") -> dict:
    """A per-column parameter table (one row per column) as a dict of scalars."""
    return {r["column"]: r[value] for r in long.select("column", value).collect()}


def median_fill(df: DataFrame, cols: Sequence[str], medians: DataFrame, keys: Sequence[str] = (),
                sentinel=0, global_fallback: DataFrame | None = None, out_suffix: str = "") -> DataFrame:
    """AG-03: replace sentinels in ``cols`` by the medians of the row's key.

    ``medians`` is long form (keys..., column, median); with no keys it is
    one row per column and is inlined as literals.  Rows whose key has no
    entry take ``global_fallback`` ((column, median), inlined), then 0.
    With ``out_suffix`` the filled values go to ``column+out_suffix`` and the
    original columns are kept.
    """
    cols = list(cols)
    keys = list(keys)
    glob = scalar_params(global_fallback) if global_fallback is not None else {}
    if keys:
        params = small_table(wide_params(medians, keys, cols, "_m_"))
        out = lookup_join(df, params, keys, "left")
        key_med = {c: F.col("_m_" + c) for c in cols}
    else:
        out = df
        scal = scalar_params(medians)
        key_med = {c: F.lit(scal.get(c)).cast("double") for c in cols}
    fills = {}
    for c in cols:
        fb = [key_med[c]] + ([F.lit(glob[c]).cast("double")] if glob.get(c) is not None else []) + [F.lit(0.0)]
        fills[c + out_suffix] = F.when(is_sentinel(F.col(c), sentinel), F.coalesce(*fb)).otherwise(
            F.col(c).cast("double"))
    out = out.withColumns(fills)
    return out.drop(*["_m_" + c for c in cols]) if keys else out


def split_profile(df: DataFrame, split_col: str, target: str) -> DataFrame:
    """AG-04: per split — total, positive, negative, positive_ratio (0/1 target)."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(target)).cast("long").alias("positive"),
        (F.count(F.lit(1)) - F.sum(F.col(target))).cast("long").alias("negative"),
        F.avg(F.col(target).cast("double")).alias("positive_ratio"),
    ).withColumnRenamed(split_col, "split")


def imputation_profile(original: DataFrame, imputed: DataFrame, cols: Sequence[str], sentinel=0,
                       method: str = "ranked") -> DataFrame:
    """AG-05: per column — zeros_replaced, mean/median before (sentinels
    excluded) and after imputation.

    Both frames are one union, told apart by a flag: the medians of both take its two
    scans together, and the first of them carries the counts and means as observed metrics.
    """
    cols, spark = list(cols), original.sparkSession
    before, after = F.col("_after") == 0, F.col("_after") == 1
    side = lambda df, n: df.select(F.lit(n).alias("_after"), *[F.col(c).cast("double").alias(c) for c in cols])
    both, seen = side(original, 0).unionByName(side(imputed, 1)), Observation()
    metrics = []
    for i, c in enumerate(cols):
        real = before & ~F.coalesce(is_sentinel(F.col(c), sentinel), F.lit(True))
        metrics += [F.count(F.when(before & is_sentinel(F.col(c), sentinel), 1)).alias(f"z{i}"),
                    F.avg(F.when(real, F.col(c))).alias(f"o{i}"), F.avg(F.when(after, F.col(c))).alias(f"i{i}")]
    values = both.observe(seen, *metrics).withColumns(
        {c: F.when(after | ~is_sentinel(F.col(c), sentinel), F.col(c)) for c in cols})
    med = {(r["_after"], r["column"]): r["median"] for r in grouped_median(values, ["_after"], cols, method=method).collect()}
    found = seen.get  # of the first scan
    rows = [(c, found[f"z{i}"], found[f"o{i}"], found[f"i{i}"], med.get((0, c)), med.get((1, c))) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "column string, zeros_replaced long, original_mean double, imputed_mean double, "
                                       "original_median double, imputed_median double")
