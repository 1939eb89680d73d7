"""Standard scaling with the population standard deviation (SC-01, SC-02).

``pyspark.ml.feature.StandardScaler`` divides by the sample deviation, so the
fit is a plain aggregate: ``avg`` and ``stddev_pop`` per column (per class
when keyed).  A constant column scales by 1.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join, small_table


def fit_scaler(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """SC-01 → long table (keys..., column, mean, scale)."""
    cols, keys = list(cols), list(keys)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    long = wide.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m_{c}").alias("mean"),
                 F.when(F.col(f"s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"s_{c}")).alias("scale"))
        for c in cols])))
    return small_table(long)


def apply_scaler(df: DataFrame, cols: Sequence[str], scaler: DataFrame, keys: Sequence[str] = (),
                 suffix: str = "", src_suffix: str = "") -> DataFrame:
    """SC-02: ``(x - mean) / scale`` with stored parameters.

    Unkeyed parameters are a handful of scalars and are inlined as literals;
    keyed ones (one row per class) are a small local table joined on the key.
    Rows whose key has no parameters get NULL features.
    """
    cols, keys = list(cols), list(keys)
    if not keys:
        p = {r["column"]: (r["mean"], r["scale"]) for r in scaler.collect()}
        return df.withColumns({c + suffix: (F.col(c + src_suffix).cast("double") - F.lit(p[c][0])) / F.lit(p[c][1])
                               for c in cols})
    wide = scaler.groupBy(*keys).agg(*[
        F.first(F.when(F.col("column") == c, F.struct("mean", "scale")), ignorenulls=True).alias(f"_sp_{c}")
        for c in cols])
    out = lookup_join(df, small_table(wide), keys, "left")
    out = out.withColumns({c + suffix: (F.col(c + src_suffix).cast("double") - F.col(f"_sp_{c}.mean"))
                           / F.col(f"_sp_{c}.scale") for c in cols})
    return out.drop(*[f"_sp_{c}" for c in cols])
