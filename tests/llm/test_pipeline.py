from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline
from test_operators import copies_are_gone, judged, reference_encoding, spans

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_part(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = (before.toPandas(), docs.toPandas())
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == names
    before, after = seen["quality rules"]
    assert set(after.doc_id) == {i for i, t in zip(before.doc_id, before.text) if judged(t)[-1]}
    before, after = seen["SimHash near-dedup"]
    copies_are_gone(dict(zip(before.doc_id, before.text)), set(after.doc_id))
    assert after.doc_id.is_unique and len(after) < len(before)
    before, after = seen["secret scans"]
    assert len(before) == len(after) and not any(spans(t) for t in after.text)
    clean = {i: t for i, t in zip(before.doc_id, before.text) if not spans(t)}
    assert all(t == clean[i] for i, t in zip(after.doc_id, after.text) if i in clean)
    before, after = seen["mixing"]
    assert set(after.doc_id) <= set(before.doc_id) and after.groupby("doc_id").size().max() <= 3
    before, after = seen["byte-level BPE"]
    own, texts = reference_encoding(), dict(zip(before.doc_id, before.text))
    assert len(before) == len(after) and after.exact.all()
    assert all(list(r.ids) == own.encode_ordinary(texts[r.doc_id]) for r in after.itertuples())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("NOT exact OR n_tokens <> size(ids)").isEmpty()


def test_awkward_rows_pass_through(spark, tmp_path):
    found = [(1, None, "en", "a"), (2, "", "en", None), (None, "text " * 60, "en", "a")]
    spark.createDataFrame(found, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text")).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("k", range(5))
def test_empty_input(spark, tmp_path, k):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    assert corpus_pipeline.STAGES[k][1](spark, docs, SF).count() == 0
