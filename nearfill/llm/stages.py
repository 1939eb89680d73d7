"""Intermediate tables in the shared checkpoint folder.

Jobs of several steps write each step's rows there: the lineage is cut, a lost
executor costs only its own tasks, and a step's shuffle files can go as soon as
its table is written.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

#: A step's shuffle files go when it ends; Arrow batches are small enough for two tasks in a small executor.
_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
             "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextmanager
def step_settings(spark: SparkSession) -> Iterator[None]:
    """The session with ``_SETTINGS`` for as long as the block runs."""
    old = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with step_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``table`` that no later step reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
