"""Distributed prefix counts in a value order (no single-task window).

``prefix_count`` gives every row the total weight of the rows that come
strictly before it, within a partition key, in ``order`` order.  Rows are
cut into value buckets at approximate quantiles (``percentile_approx``,
bounded sketch), bucket totals become exact running offsets in a small
table, and a window runs only inside (partition, bucket) — about 1/B of a
partition (B grows with the largest partition, ~2M rows per bucket up to
4,096 buckets), so a partition holding a third of all rows is still spread
over many tasks.  The bucket of a row depends only on its value, so equal values
share a bucket and ties are ordered by the remaining ``order`` columns.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import small_table

DEFAULT_BUCKETS = 64


ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 4096


def prefix_count(df: DataFrame, parts: Sequence[str], value: str, ties: Sequence[str] = (),
                 weight: str | None = None, out: str = "_before", buckets: int | None = None,
                 accuracy: int = 10_000) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 if None) over rows ordered before the row
    by ``(value, *ties)`` within ``parts``.

    With ``buckets`` None the bucket count follows the largest partition:
    about ``ROWS_PER_BUCKET`` rows per bucket, between 64 and 4,096 (one
    small aggregate), and the sketch accuracy is raised to match.
    """
    parts = list(parts)
    if buckets is None:
        sizes = df.groupBy(*parts).count() if parts else df.groupBy().count()
        biggest = sizes.agg(F.max("count")).collect()[0][0] or 0
        buckets = int(min(MAX_BUCKETS, max(DEFAULT_BUCKETS, -(-biggest // ROWS_PER_BUCKET))))
    accuracy = max(accuracy, 4 * buckets)
    grid = [i / buckets for i in range(1, buckets)]
    wcol = F.col(weight) if weight else F.lit(1)
    bounds = small_table(df.groupBy(*parts).agg(
        F.percentile_approx(value, grid, accuracy).alias("_bounds")) if parts else
        df.agg(F.percentile_approx(value, grid, accuracy).alias("_bounds")), max_rows=4_000_000 // buckets)
    b = df.join(bounds, parts) if parts else df.join(bounds)  # without parts: one row
    b = b.withColumn("_bk", range_of(F.col("_bounds"), F.col(value), buckets)).drop("_bounds")
    tot = b.groupBy(*parts, "_bk").agg(F.sum(wcol).alias("_bw"))
    wo = Window.partitionBy(*parts).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offs = small_table(tot.withColumn("_off", F.coalesce(F.sum("_bw").over(wo), F.lit(0))).drop("_bw"))
    b = b.join(offs, parts + ["_bk"])
    wi = Window.partitionBy(*parts, "_bk").orderBy(value, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return b.withColumn(out, F.col("_off") + F.coalesce(F.sum(wcol).over(wi), F.lit(0))).drop("_bk", "_off")


def range_of(bounds: Column, value: Column, buckets: int) -> Column:
    """How many of the ascending ``bounds`` lie below ``value``, by binary search (as many steps as the buckets have bits)."""
    steps = F.sequence(F.lit(1), F.lit(max(1, buckets.bit_length())))

    def half(state: Column, _: Column) -> Column:
        mid = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        more = state["lo"] < state["hi"]
        right = more & (F.get(bounds, mid) < value)
        return F.struct(F.when(right, mid + 1).otherwise(state["lo"]).alias("lo"),
                        F.when(more & ~right, mid).otherwise(state["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi")), half, lambda s: s["lo"])
