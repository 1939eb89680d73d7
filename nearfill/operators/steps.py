"""Tables between the steps of a job, in the shared checkpoint folder.

A step that later ones read more than once, or whose rows must keep the numbers
they were given, is written as Parquet and read back.  That cuts the lineage: a lost
executor costs its own tasks, never a renumbering of rows.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The column of row numbers, 64-bit, unique within a table.
ROW = "_row"
#: Rows of a partition at most, about, and rows that are worth a task of their own.
TASK_ROWS = (200_000, 10_000)


def folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession, rows: int) -> int:
    """Partitions for work in Python on ``rows`` rows: all cores where the rows are worth it, however few bytes they are."""
    most, least = TASK_ROWS
    return max(1, -(-rows // most), min(2 * spark.sparkContext.defaultParallelism, rows // least))


def spread(df: DataFrame, rows: int) -> DataFrame:
    """A table read back, in partitions enough for its rows (few bytes are read in few tasks otherwise)."""
    n = parts(df.sparkSession, rows)
    return df if 2 * df.rdd.getNumPartitions() >= n else df.repartition(n)


def numbered(df: DataFrame, name: str = "rows", column: str = ROW) -> DataFrame:
    """``df`` with a number for every row, as a table: partition and place, fixed once written."""
    return table(df.withColumn(column, F.monotonically_increasing_id()), name)


def discard_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that no later step reads."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            discard_path(df.sparkSession, path)
