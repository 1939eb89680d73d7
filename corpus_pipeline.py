"""A corpus pipeline over ``documents``: two quality stages, near duplicates, mixing, packing.

Every stage takes the documents that its predecessor kept (written as Parquet
and read again) and all but the last return the columns of ``documents``.

  1. quality_classifier: documents outside the importance sample go.
  2. quality_rules: documents that the base rule or the calibrated model rejects go.
  3. jaccard_join: of each group of near duplicates the smallest doc_id stays.
  4. mixing: the sources are mixed to flattened target weights; every document
     stays, and sources below their weight begin again (a document is then a row
     for each epoch).
  5. packing: all rows are packed into sequences of 2048 tokens, one row per piece.

Both quality models learn from the labelled rows of the whole ``documents`` table,
since the documents labelled bad are those that the first stage takes away.
Without labels of both kinds stage 1 keeps everything and stage 2 applies its
base rule alone.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfill.llm import importance, jaccard_join, mixing, packing, quality_rules, stages


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = importance.fit(docs, _read(spark, sf_dir, "labels"), labelled=_read(spark, sf_dir, "documents"))
    return importance.keep(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = quality_rules.labelled_grams(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return quality_rules.keep(docs, quality_rules.fit(rows))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, k=5, percent=75)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("jaccard_join", near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: The models, hashes and token ids of the stages are not expressible in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, from the table ``documents``."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
