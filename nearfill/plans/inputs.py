"""Stand-in inputs built from the driver's test tables.

Each function only reads a table and projects it into the schema a job
expects (key, class, numeric features, sentinel zeros); none does any of the
jobs' work.  The same projections are written out in ``catalog.SQL_INPUTS``
for the DuckDB oracle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMBED_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: class o_orderstatus; price with sentinel zeros on every 7th key."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").cast("double").alias("custkey"),
        F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).cast("double").alias("days"),
    )


def lineitem_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem: class l_returnflag; discount and tax carry natural zeros."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax")


def customer_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer: class c_mktsegment; balance with sentinel zeros on every 7th key;
    nation 0 is treated as a sentinel too."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_custkey") % 7 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.col("c_custkey").cast("double").alias("custno"),
    )


def groups_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in three groups far apart within every segment; a fifth of the middle group's prices are sentinel
    zeros.  The best clusters are the groups, whichever way they are found."""
    c, g = table(spark, sf_dir, "customer"), F.col("c_custkey") % 3
    real = g * 1000 + 1 + (F.col("c_acctbal") + 1000) / 1000
    return c.select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_custkey") % 15 == 1, F.lit(0.0)).otherwise(real).alias("price"),
        (g * 100 + F.col("c_nationkey") / 100).cast("double").alias("a"),
        ((2 - g) * 50 + F.sqrt("c_custkey") / 1000).cast("double").alias("b"))


def docs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: target quality (0/1), toxic (0/1) and counts over the whole text."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents")
    t = F.col("text")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic"),
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, " ", "")) + 1).cast("double").alias("n_words"),
        (F.length(t) - F.length(F.regexp_replace(t, "\n", "")) + 1).cast("double").alias("n_lines"),
        (F.length(t) - F.length(F.regexp_replace(t, "[0-9]", ""))).cast("double").alias("n_digits"),
    )


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "n_digits"]


def embedding_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as wide double columns e0..e63 (codegen-friendly arithmetic)."""
    e = table(spark, sf_dir, "embeddings")
    return e.selectExpr("vec_id", "label",
                        *[f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(EMBED_DIM)])


EMBED_FEATURES = [f"e{i}" for i in range(EMBED_DIM)]
