"""Exact stratified split and folds by a seeded hash order (S-01, S-02).

Rows of a class are ordered by ``md5(seed|key)`` (ties by key).  A histogram
of the first 12 hash bits per class (4,096 buckets, pre-aggregated, a small
table) and its running sums place every bucket in that order.

The split keeps the first ``quota`` rows of each class for training; the
quotas follow the largest-remainder allocation with ties broken by class
order, over a table of classes of any size.  Rows in buckets before or after the one that holds the quota need a
comparison only; that one bucket, about 1/4,096 of its class, is ranked.

Folds are ``(rank - 1) mod folds``, so per-class fold sizes differ by at most
one; the rank of a row is its bucket's running sum plus a ``row_number`` inside
(class, bucket), so that a class with a third of all rows is spread over many
tasks.  Rows without a class are refused.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hash_order
from .joins import small_table
from .ranking import prefix_count
from .validate import class_counts, require_target

BUCKET_HEX = 3  # 12 bits of the hash select the bucket
#: Remainders of up to this many classes are ranked in one task; those of more by distributed prefix counts.
RANKED_AT_ONCE = 100_000


def _bucketed(df: DataFrame, target: str, keys: Sequence[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with hash ``_h`` and bucket ``_b``, and the small table (class, bucket, rows, rows before it)."""
    h = df.withColumn("_h", hash_order(seed, list(keys))).withColumn(
        "_b", F.conv(F.substring("_h", 1, BUCKET_HEX), 16, 10).cast("int"))
    hist = h.groupBy(target, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(target).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return h, small_table(hist.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))))


def hash_rank(df: DataFrame, target: str, keys: Sequence[str], seed: int = 42, rank_col: str = "_rank") -> DataFrame:
    """1-based rank of each row within its class in ``(md5(seed|key), key)`` order."""
    h, offsets = _bucketed(df, target, keys, seed)
    wb = Window.partitionBy(target, "_b").orderBy("_h", *keys)
    return (h.join(offsets.drop("_cnt"), [target, "_b"])
            .withColumn(rank_col, F.col("_off") + F.row_number().over(wb)).select(*df.columns, rank_col))


def allocate(counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` over classes (ties: class order)."""
    n = sum(counts.values())
    classes = sorted(counts)
    cont = {c: counts[c] / n * n_draws for c in classes}
    out = {c: math.floor(cont[c]) for c in classes}
    need = n_draws - sum(out.values())
    for c in sorted(classes, key=lambda c: (-(cont[c] - out[c]), classes.index(c))):
        if need <= 0:
            break
        out[c] += 1
        need -= 1
    return out


def split_quotas(df: DataFrame, target: str, test_size: float = 0.2) -> DataFrame | None:
    """Training quota of every class (target, ``_quota``), by largest remainder over a class table; None for an empty table."""
    counts = class_counts(df, target)
    whole = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("classes"), F.min("count").alias("least")).first()
    if not whole.classes:
        return None
    if whole.least < 2:
        small = [r[0] for r in counts.where("count < 2").orderBy(target).limit(10).collect()]
        raise ValueError(f"classes with a single row cannot be split: {small}")
    n_test = math.ceil(test_size * whole.n)
    n_train = whole.n - n_test
    if n_train < whole.classes or n_test < whole.classes:
        raise ValueError("train and test sizes must each be at least the number of classes")
    share = F.col("count") / F.lit(float(whole.n)) * F.lit(float(n_train))
    parts = counts.select(target, F.floor(share).alias("_floor"), (F.floor(share) - share).alias("_owed"))
    need = n_train - parts.agg(F.sum("_floor")).first()[0]
    # the classes that are owed most get one row more
    if whole.classes <= RANKED_AT_ONCE:
        ranked = parts.withColumn("_place", F.row_number().over(Window.partitionBy().orderBy("_owed", target)) - 1)
    else:
        ranked = prefix_count(parts, [], "_owed", [target], out="_place")
    return small_table(ranked.select(target, (F.col("_floor") + (F.col("_place") < need).cast("int")).cast("long").alias("_quota")))


def stratified_split(df: DataFrame, target: str, keys: Sequence[str], test_size: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """S-01: adds ``split`` ∈ {train, test}; exact per-class quotas, seed-stable."""
    require_target(df, target)
    quotas = split_quotas(df, target, test_size)
    if quotas is None:
        return df.withColumn(split_col, F.lit(None).cast("string"))
    h, offsets = _bucketed(df, target, keys, seed)
    last = offsets.join(quotas, target)
    last = small_table(last.where((F.col("_off") < F.col("_quota")) & (F.col("_quota") <= F.col("_off") + F.col("_cnt")))
                       .select(target, F.col("_b").alias("_last"), (F.col("_quota") - F.col("_off")).alias("_left")))
    placed = h.join(last, target, "left")
    train, test = F.lit("train"), F.lit("test")
    outside = placed.where(F.col("_last").isNull() | (F.col("_b") != F.col("_last"))).withColumn(
        split_col, F.when(F.col("_b") < F.col("_last"), train).otherwise(test))
    order = Window.partitionBy(target).orderBy("_h", *keys)  # the rows of one bucket of each class
    inside = placed.where(F.col("_b") == F.col("_last")).withColumn(
        split_col, F.when(F.row_number().over(order) <= F.col("_left"), train).otherwise(test))
    return outside.unionByName(inside).select(*df.columns, split_col)


def stratified_folds(df: DataFrame, target: str, keys: Sequence[str], folds: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """S-02: adds ``fold`` in 0..folds-1, per-class sizes differing by at most one."""
    require_target(df, target)
    class_counts(df, target)
    ranked = hash_rank(df, target, keys, seed)
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")
