"""Lookup joins against small parameter tables.

Parameter tables (per class, per cluster, per group) go through
``small_table``: a bounded fetch checks both rows and bytes, after which the
table is a local leaf with a broadcast hint, so that lookups never shuffle the
large side.  A table beyond either bound is checkpointed instead and joined
without a hint: adaptive execution then measures it at run time.  Either way
the join gives the same rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def lookup_join(df: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Join ``df`` with a small parameter table (see module notes)."""
    return df.join(small, on=on, how=how)


# A parameter table becomes a local relation up to these bounds.
SMALL_TABLE_MAX_ROWS = 100_000
SMALL_TABLE_MAX_BYTES = 32 << 20


def small_table(df: DataFrame, max_rows: int = SMALL_TABLE_MAX_ROWS) -> DataFrame:
    """Materialise a small parameter table as a leaf of later plans.

    Medians, scalers and cell summaries are joined back onto the data they
    were computed from; as lazy sub-plans they would copy the whole input plan
    into every consumer.  ``max_rows`` bounds what is fetched to look at: give
    a lower one for rows that hold long arrays.
    """
    spark = df.sparkSession
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows and rows.nbytes <= SMALL_TABLE_MAX_BYTES:
        return F.broadcast(spark.createDataFrame(rows, df.schema))
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
