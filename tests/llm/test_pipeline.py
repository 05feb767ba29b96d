"""The pipeline's stages take effect, keep clean documents and survive odd rows."""

import corpus_pipeline
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    n = docs.count()
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", None, 0)], docs.schema)
    docs = docs.union(odd).withColumn("fp", F.lit(1)).withColumn("chunk", F.lit("x")).withColumn("kept", F.array(F.lit("y"))).withColumn("score", F.lit(2))
    sizes = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, small)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == [*COLUMNS, "fp", "chunk", "kept", "score"], name
            assert docs.filter("fp <> 1 or chunk <> 'x' or kept[0] <> 'y' or score <> 2").count() == 0, name
            assert docs.filter("n_chars <> length(text)").count() == 0, name
        sizes.append(docs.count())
    assert n > sizes[0] == sizes[1] > sizes[2] >= sizes[3] > 0
    assert [s[0] for s in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "mixing sources to target weights"]


def test_registered_queries_cover_the_operators():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


def test_run_does_each_stage_once(spark, small, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, lambda s, d, f, k=k, g=stage: calls.append(k) or g(s, d, f)) for k, (name, stage) in enumerate(corpus_pipeline.STAGES)])
    out = corpus_pipeline.run(spark, small)
    assert calls == [0, 1, 2, 3, 4] and out.columns == [*COLUMNS, "copy_no"]
    # what remains to do reads one checkpoint
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" not in plan and "MapInArrow" not in plan
    assert out.count() > 0
