"""Sources and sinks (IO-01..03)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir


def _guess_format(spark: SparkSession, path: str) -> str:
    """csv for ``*.csv`` paths and for folders whose part files are CSV, else parquet (asked of the path's own file system)."""
    bare = path.rstrip("/")
    if bare.endswith(".csv"):
        return "csv"
    where = spark._jvm.org.apache.hadoop.fs.Path(bare)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(where) and store.getFileStatus(where).isDirectory():
        names = [f.getPath().getName() for f in store.listStatus(where)]
        if any(n.endswith(".csv") for n in names) and not any(n.endswith(".parquet") for n in names):
            return "csv"
    return "parquet"


#: What a malformed CSV row becomes: its readable fields and NULLs, an error, or a row with its text in a column of its own.
MALFORMED = ("null", "refuse", "apart")


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str | None = None,
               malformed: str = "null", rescue: str = "_malformed") -> DataFrame:
    """IO-01: delimited file with a header row, or Parquet.

    ``fmt`` defaults from the extension, or a folder's part files.  Give ``schema`` for CSV on large
    data; without it the types are inferred (one extra pass).  Rows that do not fit a given schema
    (a field of another type, too few or too many fields) keep their readable fields
    (``malformed="null"``), end the job (``"refuse"``), or come with their whole text in the column
    ``rescue``, which is NULL for all others (``"apart"``; see ``read_checked``).
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}")
    fmt = fmt or _guess_format(spark, path)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            if malformed == "apart":
                raise ValueError("rows are told apart by a given schema")
            return reader.option("inferSchema", True).option("mode", "FAILFAST" if malformed == "refuse" else "PERMISSIVE").csv(path)
        # every field is parsed, or a row would be malformed only for queries that read its bad field
        reader = reader.option("columnPruning", malformed == "null")
        if malformed == "refuse":
            reader = reader.option("mode", "FAILFAST")
        if malformed == "apart":
            kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue)
            found = reader.schema(StructType([*kinds.fields, StructField(rescue, StringType())])).csv(path)
            # always true, but it keeps a field in the scan: Spark reads no texts of malformed rows alone
            parsed = F.length(F.concat_ws("", F.col(kinds.fieldNames()[0]).cast("string"))) >= 0
            return found.withColumn(rescue, F.when(parsed, F.col(rescue)))
        return reader.schema(schema).csv(path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(path)


def read_checked(spark: SparkSession, path: str, schema: StructType | str, rescue: str = "_malformed"
                 ) -> tuple[DataFrame, DataFrame, Observation]:
    """IO-01 with malformed CSV rows kept apart: (good rows, texts of the others, counts).

    The counts ``rows`` and ``malformed`` are observed by the first action on the good rows, without a scan of their own.
    """
    found = read_table(spark, path, schema, "csv", "apart", rescue)
    counts = Observation()
    seen = found.observe(counts, F.count(F.lit(1)).alias("rows"), F.count(rescue).alias("malformed"))
    return seen.where(F.col(rescue).isNull()).drop(rescue), found.where(F.col(rescue).isNotNull()), counts


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """IO-02: replace a result folder (one folder of part files per result).

    The new files are written beside the folder and take its place when they are complete, so ``df`` may
    read the very folder that it replaces, and a failed job leaves the old result.
    """
    spark, target = df.sparkSession, path.rstrip("/")
    staged = f"{target}-staged-{uuid.uuid4().hex}"
    writer = df.write.option("header", True) if fmt == "csv" else df.write
    writer.format(fmt).save(staged)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target))
    store = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(old):
        store.delete(old, True)
    if not store.rename(new, old):
        raise OSError(f"{staged} could not take the place of {target}")
    spark.catalog.refreshByPath(target)
    return path


def load_splits(spark: SparkSession, train_path: str, test_path: str,
                schema: StructType | str | None = None) -> tuple[DataFrame, DataFrame]:
    """IO-03: load a train and a test split."""
    return read_table(spark, train_path, schema), read_table(spark, test_path, schema)


def with_row_key(df: DataFrame, key: str = "_row_key") -> DataFrame:
    """Explicit row identity for tables without a key column.

    The key is ``md5`` of all values plus a counter 1..m among the m identical
    copies of a row, so the set of keys does not depend on file splits or
    partitioning.  A group of copies may be a large share of the table, so the
    counter is never computed in one task: copies are counted per input
    partition, partition offsets come from a window over at most
    #partitions rows per content, and the numbering inside a partition runs in
    a window over (content, partition), which is bounded by one partition.
    """
    content = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]))
    ensure_checkpoint_dir(df.sparkSession)
    # both branches below must see the same partitions: evaluated once
    base = (df.withColumn("_content", content).withColumn("_pid", F.spark_partition_id())
            .withColumn("_mono", F.monotonically_increasing_id()).checkpoint())
    per = base.groupBy("_content", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy("_content").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.withColumn("_off", F.coalesce(F.sum("_n").over(wo), F.lit(0))).drop("_n")
    wl = Window.partitionBy("_content", "_pid").orderBy("_mono")
    out = base.join(offs, ["_content", "_pid"]).withColumn("_dup", F.col("_off") + F.row_number().over(wl))
    return (out.withColumn(key, F.concat_ws("-", "_content", F.col("_dup").cast("string")))
            .drop("_content", "_pid", "_mono", "_off", "_dup"))
