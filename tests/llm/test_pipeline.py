"""The pipeline's stages on the smallest tables: what each keeps, and that decisions take effect."""

import corpus_pipeline
from eventlode.llm.jaccard import jaccard_components
from eventlode.llm.leaks import find_leaks
from eventlode.llm.secrets import find_secrets


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, benchmark = docs.columns, spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        if name != "token_ids":
            assert sorted(now.columns) == sorted(columns)
        if name == "quality_rules":
            assert 0.5 * docs.count() < now.count() < docs.count()
        if name == "near_copies":
            assert now.count() == jaccard_components(docs, 5, 80).select("component_id").distinct().count()
        if name == "decontamination":
            assert find_leaks(now, benchmark).count() == 0
        if name == "secrets":
            assert now.count() == docs.count() and find_secrets(now).where("size(spans) > 0").count() == 0
        if name == "token_ids":
            assert now.count() == docs.count() and now.where("not round_trip").count() == 0
        docs = now
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()
