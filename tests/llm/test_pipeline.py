"""The pipeline over awkward documents: every stage keeps what it should."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.cases import SCHEMA, documents


def test_stages(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append({r.doc_id for r in docs.select("doc_id").distinct().collect()})
        if k < 4:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    assert not kept[0] & {100, 101, 102, 107} and set(range(24)) <= kept[0]
    assert 105 not in kept[1] | kept[2] and set(range(24)) <= kept[2]
    assert kept[4] == kept[3] and corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
