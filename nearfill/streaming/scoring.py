"""Scoring new rows as they arrive with models fitted in batch.

No new operator: the k-means imputer's transform with ``fill_stats="train"``
is a projection plus joins against small static model tables, so it runs on
a streaming DataFrame as is.  The neighbour vote ranks candidates with a
window, which streaming queries do not allow, so ``score_stream`` applies
imputation + prediction to each micro-batch with ``foreachBatch`` and writes a
folder per epoch (``epoch=<id>``).  A batch that is replayed after a failure
overwrites its own folder, so the sink holds every row once.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import classify, impute_kmeans


def impute_stream(stream: DataFrame, model: impute_kmeans.KMeansImputerModel) -> DataFrame:
    """Streaming imputation with the training medians (D5: batch medians are
    undefined for a stream)."""
    return impute_kmeans.transform(model, stream, fill_stats="train")


def score_stream(stream: DataFrame, classifier: classify.KNNClassifierModel, output: str, checkpoint: str,
                 imputer: impute_kmeans.KMeansImputerModel | None = None, fmt: str = "parquet",
                 trigger: dict | None = None) -> StreamingQuery:
    """Impute (optional) and classify every micro-batch; write predictions to ``output``/epoch=<id>."""

    def batch(df: DataFrame, epoch_id: int) -> None:
        if imputer is not None:
            df = impute_kmeans.transform(imputer, df, fill_stats="train")
        classify.prediction_table(classifier, df).write.mode("overwrite").format(fmt).save(
            f"{output.rstrip('/')}/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
