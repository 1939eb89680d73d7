"""Schema-level checks and projections (PF-01, PF-02, PF-03, PF-07, PF-08).

These run on the driver against ``df.schema`` only, except those that list
classes: ``class_table`` and ``class_counts`` stay tables, of any number of classes.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .joins import small_table


def require_target(df: DataFrame, target: str) -> None:
    """PF-01: the target column must exist."""
    if target not in df.columns:
        raise ValueError(f"no column {target!r} to use as target; the table has {', '.join(df.columns)}")


def feature_columns(df: DataFrame, target: str | None, exclude: Sequence[str] = ()) -> list[str]:
    """PF-02: all columns except the target (and keys), in table order; numeric only."""
    feats = [c for c in df.columns if c != target and c not in set(exclude)]
    types = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in feats if not isinstance(types[c], NumericType)]
    if bad:
        raise ValueError(f"non-numeric feature columns: {bad}")
    return feats


def present_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """PF-03: keep the listed columns that exist, in list order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


#: Up to this many classes a vote has a column for each; beyond it votes are rows.
WIDE_CLASSES = 100


def class_table(df: DataFrame, target: str) -> DataFrame:
    """PF-07: distinct target values, one row each, however many."""
    return small_table(df.select(target).where(F.col(target).isNotNull()).distinct())


def class_values(df: DataFrame, target: str, most: int | None = None) -> list | None:
    """PF-07 as a list, ascending; None if there are more than ``most`` values."""
    found = df.select(target).where(F.col(target).isNotNull()).distinct().orderBy(target)
    rows = (found if most is None else found.limit(most + 1)).collect()
    return None if most is not None and len(rows) > most else [r[0] for r in rows]


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """Rows per class (target, ``count``), one row each; rows without a class are refused."""
    counts = small_table(df.groupBy(target).count())
    lost = counts.where(F.col(target).isNull()).collect()
    if lost:
        raise ValueError(f"{lost[0]['count']} rows have no class in {target!r}")
    return counts


def widen(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF-08: impute columns become double (values may turn fractional)."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols}) if cols else df
