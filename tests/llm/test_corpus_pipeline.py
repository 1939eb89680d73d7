"""The pipeline's stages on small tables."""
import random
import shutil

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from nearfill.llm import encoding  # noqa: E402

from .test_quality import corpus  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rnd = random.Random(2)
    rows = [(i, t, "en", "src0" if i % 3 else f"src{i % 7}", len(t)) for i, t, _, _ in corpus(240)]
    for i in range(240, 300):  # near copies of good documents
        words = rows[rnd.choice([1, 2, 3, 5])][1].split()
        rows.append((i, " ".join(words[:-1] + [f"new{i}"]), "en", None, 0))
    rows += [(400, None, None, None, None), (401, "", "en", "src0", 0), (402, "short", "en", "src0", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, q, 0) for i, _, _, q in corpus(240) if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    yield str(folder), rows
    shutil.rmtree(folder, ignore_errors=True)


def test_stages_one_after_the_other(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stages.table(stage(spark, docs, folder), name)
        assert docs.columns == columns
        seen.append({r.doc_id for r in docs.collect()})
    good = {i for i, _, _, q in corpus(240) if q == 1}
    assert good <= seen[1] and not seen[1] & ({i for i in range(240)} - good) and not seen[1] & {400, 401, 402}
    # every near copy of a kept document is gone, and nothing else
    from .test_jaccard_join import brute
    texts = [(r[0], r[1]) for r in rows if r[0] in seen[1]]
    assert seen[2] == {i for i, _, top in brute(texts) if i == top}
    assert seen[3] == seen[2]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    tok = encoding.tokenizer(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    text = {r[0]: r[1] for r in rows}
    assert sum(p.length for p in pieces) == sum(len(tok.encode(text[r.doc_id], add_special_tokens=False).ids) + 1 for r in docs.collect())


def test_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
