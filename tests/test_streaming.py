import os
import tempfile

import numpy as np
import pandas as pd

from nearfill.operators import classify, impute_kmeans
from nearfill.streaming import impute_stream, score_stream


def test_stream_scoring_matches_batch(spark):
    rng = np.random.default_rng(8)
    n = 200
    pdf = pd.DataFrame({"id": np.arange(n), "y": rng.integers(0, 2, n), "a": rng.normal(5, 1, n).round(2),
                        "z": rng.integers(1, 30, n).astype(float)})
    pdf.loc[rng.random(n) < 0.2, "z"] = 0.0
    df = spark.createDataFrame(pdf)
    imp = impute_kmeans.fit(df, "y", "id", ["z"], n_clusters=2, n_init=1)
    clf = classify.fit(impute_kmeans.transform(imp, df, fill_stats="train"), "y", "id", n_neighbors=3)
    base = tempfile.mkdtemp(prefix="nearfill-stream-")
    src = os.path.join(base, "in")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = impute_stream(stream, imp).writeStream.format("memory").queryName("imputed").trigger(
        availableNow=True).start()
    q.awaitTermination()
    streamed = spark.table("imputed").toPandas().sort_values("id")
    batch = impute_kmeans.transform(imp, df, fill_stats="train").toPandas().sort_values("id")
    assert np.allclose(streamed.z.to_numpy(), batch.z.to_numpy())
    out = os.path.join(base, "out")
    q2 = score_stream(spark.readStream.schema(df.schema).parquet(src), clf, out, os.path.join(base, "ck"),
                      imputer=imp)
    q2.awaitTermination()
    got = spark.read.parquet(out).toPandas()
    assert len(got) == n and set(got.columns) >= {"Prediction", "Probability"}
