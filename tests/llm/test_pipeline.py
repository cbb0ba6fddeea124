"""The pipeline's stages on the smallest tables."""

import corpus_pipeline
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.01"


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_stages(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen.append(docs.count())
        if name != "packing":
            assert docs.columns == corpus_pipeline.DOCUMENTS
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    assert seen[0] < 1000 and seen == sorted(seen[:4], reverse=True) + seen[4:]
    kept = {r.doc_id for r in spark.read.parquet(str(tmp_path / "toxicity")).collect()}
    assert len(kept & toxic) < len(toxic)
    last = spark.read.parquet(str(tmp_path / "pii"))
    assert last.filter("n_chars <> char_length(text)").count() == 0
    assert docs.select("doc_id").distinct().count() == last.count()
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 1024").count() == 0


@pytest.mark.parametrize("name", ["without_toxic", "with_language", "without_duplicates", "without_personal_data", "packed"])
def test_stages_of_nothing(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert getattr(corpus_pipeline, name)(spark, docs, SF).count() == 0
