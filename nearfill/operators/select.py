"""Mutual-information feature scores and selection (KC-03, KC-04, KC-05).

The estimator is the nearest-neighbour one for a continuous feature against
a discrete label (Ross, 2014), as used by the reference's library:

    MI = psi(N) + mean(psi(k_i)) - mean(psi(n_y(i))) - mean(psi(m_i)),  floored at 0

with ``k_i = min(3, n_y - 1)``, ``r_i`` the distance to the k-th nearest
point of the same label (1-D), and ``m_i`` the number of points of any label
strictly within ``r_i`` (self included); labels with a single row are left
out.  Each feature is first divided by its population deviation and given a
tiny deterministic jitter (``1e-10 * max(1, mean|x|)`` times a value in
[-0.5, 0.5) from ``md5(seed|feature|key)``) because tied values break the
estimator; the reference's library adds random normal noise of that scale.

One sweep over value ranges, distributed:

* approximate quantiles cut every feature into ranges of about ``RANGE_ROWS`` rows;
* the ``k`` smallest and largest values of every (feature, range, label) are found
  without a shuffle; a window over that thin table gives each range the ``k``
  values of a label below and above it, its halo;
* rows meet their halo in their range (one shuffle): sorted arrays give ``r_i``
  and, by binary search, the points of the range within it;
* rows whose radius leaves their range, few unless a label is rare, ask the range that holds the end
  of their interval; ranges in between count whole.

``r_i`` is shrunk by 1e-9 (relative), the strict-radius rule made robust to rounding.  Only sums per feature
reach the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import steps
from .joins import small_table
from .ranking import range_of

EULER = 0.5772156649015329
#: Rows of a feature in one range, about, and ranges of a feature at most.
RANGE_ROWS = 250_000
MAX_RANGES = 4096


def digamma_sql(n: str) -> str:
    """SQL text of psi(n) for n >= 1 (same text runs in Spark SQL and DuckDB):
    recurrence up to n + 6, then the asymptotic series (error below 1e-13)."""
    x = f"CAST({n} AS DOUBLE)"
    z = f"({x} + 6.0)"
    series = (f"ln({z}) - 1.0 / (2.0 * {z}) - 1.0 / (12.0 * pow({z}, 2)) + 1.0 / (120.0 * pow({z}, 4))"
              f" - 1.0 / (252.0 * pow({z}, 6)) + 1.0 / (240.0 * pow({z}, 8)) - 1.0 / (132.0 * pow({z}, 10))")
    rec = " + ".join(f"1.0 / ({x} + {i}.0)" for i in range(6))
    return f"({series} - ({rec}))"


def digamma(n: np.ndarray) -> np.ndarray:
    """psi(n) for n >= 1, by the same rule as ``digamma_sql``."""
    x = np.asarray(n, dtype=float)
    z = x + 6.0
    series = (np.log(z) - 1 / (2 * z) - 1 / (12 * z ** 2) + 1 / (120 * z ** 4) - 1 / (252 * z ** 6) + 1 / (240 * z ** 8)
              - 1 / (132 * z ** 10))
    return series - sum(1.0 / (x + i) for i in range(6))


def _edges(k: int):
    """The k smallest and largest values of each (feature, range, label) of a partition."""
    def run(it):
        held: dict = {}
        for pdf in it:
            for at, x in pdf.groupby(["feature", "_range", "_y"], sort=False)["x"]:
                x = np.sort(np.concatenate([x.to_numpy(), *held.get(at, ())]))
                held[at] = (x[:k], x[max(k, len(x) - k):])  # short lists are kept once
        if held:
            import pandas as pd
            yield pd.DataFrame([(*at, np.concatenate(v)) for at, v in held.items()], columns=["feature", "_range", "_y", "xs"])
    return run


def _nearest(x: np.ndarray, left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    """Distance of each value of a sorted array to the k-th nearest other one, the halo on both sides included."""
    whole = np.concatenate([left, x, right])
    at = np.arange(len(left), len(left) + len(x))
    away = np.full((2 * k, len(x)), np.inf)
    for j in range(1, k + 1):
        below, above = at - j >= 0, at + j < len(whole)
        away[2 * j - 2, below] = x[below] - whole[at[below] - j]
        away[2 * j - 1, above] = whole[at[above] + j] - x[above]
    return np.partition(away, k - 1, axis=0)[k - 1]


_SWEPT = "feature string, n long, pk double, py double, pm double, m long, up double, down double, _range int"


def _sweep(k: int, bounds: dict):
    """Sums of a range's rows whose interval stays inside it; the others, one by one, with the ends that leave it."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, halo: pa.Table) -> pa.Table:
        feature, number = key[0].as_py(), key[1].as_py()
        out = {n: [] for n in ("feature", "n", "pk", "py", "pm", "m", "up", "down", "_range")}
        if rows.num_rows:
            x = np.asarray(rows["x"])
            every = np.sort(x)
            label = rows["_y"].combine_chunks().dictionary_encode()
            label = label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label
            code, names = np.asarray(label.indices), label.dictionary.to_pylist()
            sides = {y: (n, np.sort(np.array(a or [], float)), np.sort(np.array(b or [], float))) for y, n, a, b in zip(
                *(halo[c].to_pylist() for c in ("_y", "_ny", "left", "right")))}
            cut = bounds[feature]
            low = cut[number - 1] if number else -np.inf
            high = cut[number] if number < len(cut) else np.inf
            for i, y in enumerate(names):
                own = np.sort(x[code == i])
                n, left, right = sides[y]
                kk = min(k, n - 1)
                r = _nearest(own, left, right, kk) * (1.0 - 1e-9)
                up, down = own + r, own - r
                m = np.searchsorted(every, up, "left") - np.searchsorted(every, down, "right")
                leaves = (up > high) | (down <= low)
                inside = ~leaves
                rest = np.flatnonzero(leaves)
                count = len(rest) + 1
                out["feature"] += [feature] * count
                out["n"] += [int(inside.sum())] + [1] * len(rest)
                psi_k, psi_n = float(digamma(kk)), float(digamma(n))
                out["pk"] += [psi_k * int(inside.sum())] + [psi_k] * len(rest)
                out["py"] += [psi_n * int(inside.sum())] + [psi_n] * len(rest)
                out["pm"] += [float(digamma(np.maximum(m[inside], 1)).sum())] + [0.0] * len(rest)
                out["m"] += [None] + m[rest].tolist()
                out["up"] += [None] + [v if v > high else None for v in up[rest].tolist()]
                out["down"] += [None] + [v if v <= low else None for v in down[rest].tolist()]
                out["_range"] += [number] * count
        kinds = (pa.string(), pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.float64(), pa.float64(), pa.int32())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)})
    return run


def _found(key: tuple[pa.Scalar, ...], rows: pa.Table, asked: pa.Table) -> pa.Table:
    """For every end asked for: the range's points before it (``side`` 1: below; -1: from it on, equal ones left out)."""
    every, v, side = np.sort(np.asarray(rows["x"])), np.asarray(asked["v"]), np.asarray(asked["side"])
    up, down = np.searchsorted(every, v, "left"), len(every) - np.searchsorted(every, v, "right")
    return pa.table({"_row": asked["_row"], "c": pa.array(np.where(side > 0, up, down).astype(np.int64))})


def mutual_information(df: DataFrame, target: str, key: str, features: Sequence[str], *, n_neighbors: int = 3,
                       seed: int = 42) -> DataFrame:
    """KC-03 → (feature, score) for every feature."""
    feats, k, spark = list(features), int(n_neighbors), df.sparkSession
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in feats])
    long = df.select(F.col(key).alias("_key"), F.col(target).alias("_y"), F.inline(arr)).where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    # scale and jitter use every row; labels with one row then take no part.  A row per feature, or per feature and class: small tables
    ny = small_table(long.groupBy("feature", "_y").agg(F.count(F.lit(1)).alias("_ny")))
    most = ny.groupBy("feature").agg(F.sum("_ny").alias("n")).agg(F.max("n")).first()[0] or 0
    ranges = int(min(MAX_RANGES, max(1, -(-most // RANGE_ROWS))))
    grid = [i / ranges for i in range(1, ranges)] or [0.5]
    found = long.groupBy("feature").agg(F.stddev_pop("v").alias("sd"), F.avg(F.abs("v")).alias("ma"),
                                        F.percentile_approx("v", grid, max(10_000, 4 * ranges)).alias("q")).collect()
    params = [(r.feature, r.sd or 1.0, r.ma / (r.sd or 1.0), [v / (r.sd or 1.0) for v in r.q][:ranges - 1]) for r in found]
    bounds = {p[0]: np.array(p[3]) for p in params}
    names = spark.createDataFrame([(f,) for f in feats], "feature string")
    if not params:
        return small_table(names.select("feature", F.lit(0.0).alias("score")))
    scale = F.broadcast(spark.createDataFrame(params, "feature string, _sd double, _ma double, _cut array<double>"))  # a row per feature
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("feature"), F.col("_key").cast("string"))),
                            1, 8), 16, 10).cast("double") / F.lit(4294967296.0)) - F.lit(0.5)
    pts = (long.join(scale, "feature").join(ny, ["feature", "_y"]).where(F.col("_ny") > 1)
           .withColumn("x", F.col("v") / F.col("_sd") + F.lit(1e-10) * F.greatest(F.lit(1.0), F.col("_ma")) * u)
           .withColumn("_range", range_of(F.col("_cut"), F.col("x"), ranges)).select("feature", "_range", "_y", "x"))
    pts = steps.table(pts, "points")

    kinds = pts.select("feature", "_range", "_y", F.array("x").alias("xs")).schema
    edges = (pts.mapInPandas(_edges(k), kinds).groupBy("feature", "_range", "_y")
             .agg(F.array_sort(F.flatten(F.collect_list("xs"))).alias("xs"))
             .withColumn("xs", F.when(F.size("xs") > 2 * k, F.concat(F.slice("xs", 1, k), F.slice("xs", -k, k))).otherwise(F.col("xs"))))
    order = Window.partitionBy("feature", "_y").orderBy("_range")
    near = lambda first, last: F.array_sort(F.flatten(F.collect_list("xs").over(order.rowsBetween(first, last))))
    halo = (edges.withColumns({"below": near(-k, -1), "above": near(1, k)}).join(ny, ["feature", "_y"])
            .select("feature", "_range", "_y", "_ny", F.slice("above", 1, k).alias("right"),
                    F.when(F.size("below") > k, F.slice("below", -k, k)).otherwise(F.col("below")).alias("left")))
    at = ["feature", "_range"]
    swept = steps.table(pts.groupBy(*at).cogroup(halo.groupBy(*at)).applyInArrow(_sweep(k, bounds), _SWEPT)
                        .withColumn("_row", F.monotonically_increasing_id()), "swept")
    done = swept.where("m is null").select("feature", "n", "pk", "py", "pm")
    if ranges > 1:
        done = done.unionByName(_outside(pts, swept.where("m is not null"), scale, ranges))
    agg = done.groupBy("feature").agg(F.sum("n").alias("_n"), *[(F.sum(c) / F.sum("n")).alias(f"_{c}") for c in ("pk", "py", "pm")])
    score = F.expr(digamma_sql("_n")) + F.col("_pk") - F.col("_py") - F.col("_pm")
    out = agg.where("_n > 0").select("feature", F.greatest(score, F.lit(0.0)).alias("score"))
    scores = small_table(names.join(out, "feature", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score")))
    steps.discard(pts, swept)
    return scores


def _outside(pts: DataFrame, rows: DataFrame, scale: DataFrame, ranges: int) -> DataFrame:
    """Rows whose interval leaves their range: (feature, n, pk, py, pm) with the points of other ranges counted."""
    grid = scale.select("feature", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("_range"))
    size = grid.join(pts.groupBy("feature", "_range").agg(F.count(F.lit(1)).alias("size")), ["feature", "_range"], "left").fillna(0)
    upto = F.sum("size").over(Window.partitionBy("feature").orderBy("_range"))
    size = small_table(size.select("feature", "_range", (upto - F.col("size")).alias("before"), upto.alias("upto")))  # a row for each range
    ends = rows.select("_row", "feature", "_range", F.inline(F.array(
        F.struct(F.lit(1).alias("side"), F.col("up").alias("v")), F.struct(F.lit(-1).alias("side"), F.col("down").alias("v"))))).where("v is not null")
    ends = ends.join(scale.select("feature", "_cut"), "feature").withColumn("_to", range_of(F.col("_cut"), F.col("v"), ranges)).drop("_cut")
    # ranges strictly between count whole
    here, there = size.toDF("feature", "_range", "b0", "u0"), size.toDF("feature", "_to", "b1", "u1")
    between = (ends.join(here, ["feature", "_range"]).join(there, ["feature", "_to"])
               .select("_row", F.when(F.col("side") > 0, F.col("b1") - F.col("u0")).otherwise(F.col("b0") - F.col("u1")).alias("c")))
    asked = ends.select("feature", F.col("_to").alias("_range"), "_row", "v", "side")
    at = ["feature", "_range"]
    reached = pts.groupBy(*at).cogroup(asked.groupBy(*at)).applyInArrow(_found, "_row long, c long")
    more = between.unionByName(reached).groupBy("_row").agg(F.sum("c").alias("c"))
    m = F.greatest(F.col("m") + F.coalesce("c", F.lit(0)), F.lit(1))
    return rows.join(more, "_row", "left").withColumn("_m", m).select("feature", "n", "pk", "py", F.expr(digamma_sql("_m")).alias("pm"))


def top_features(scores: DataFrame, n: int, order: Sequence[str]) -> list[str]:
    """KC-04: the ``n`` best features by score (ties by name), in ``order``."""
    best = {r["feature"] for r in scores.orderBy(F.desc("score"), "feature").limit(int(n)).collect()}
    return [f for f in order if f in best]


def importance_report(scores: DataFrame, n: int = 5) -> DataFrame:
    """KC-05: top ``n`` features by score, descending."""
    return scores.orderBy(F.desc("score"), "feature").limit(int(n))
