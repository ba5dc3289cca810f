"""The pipeline's stages by themselves and in sequence."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from relayplan.llm import decontaminate, ordinal_quality, rtree_join
from tests.llm.test_rtree_join import brute


def test_run_is_the_stages_in_order(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, now = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, sf_small)
        path = str(tmp_path / f"s{k}")
        out.write.parquet(path)
        before, now = now, spark.read.parquet(path)
        if k < 4:
            assert now.columns == columns and now.dtypes == docs.dtypes
        if k == 0:
            lab = spark.read.parquet(f"{sf_small}/labels.parquet")
            good = ordinal_quality.rate(before, lab).filter("accepted").select("doc_id")
            assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in now.select("doc_id").collect())
        if k == 1:
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted(r.doc_id for r in now.collect()) == [a for a, _, c in brute(rows) if a == c]
        if k == 2:
            bad = decontaminate.search(before, spark.read.parquet(f"{sf_small}/benchmark.parquet"))
            assert before.join(bad, "doc_id", "left_anti").count() == now.count()
        if k == 3:
            assert now.count() == before.count()
            assert now.filter(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]")).count() == 0
        if k == 4:
            assert now.count() == before.count() and now.filter("not exact").count() == 0
    run = corpus_pipeline.run(spark, sf_small)
    assert run.columns == now.columns
    assert run.exceptAll(now).isEmpty() and now.exceptAll(run).isEmpty()


def test_stages_on_empty_and_odd_rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = docs.limit(3).unionByName(spark.createDataFrame([(None, None, None, None, None), (7, "", "en", "s", 0),
                                                           (7, "", "en", "s", 0)], docs.schema))
    for now in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, sf_small)
            assert out.count() <= now.count()
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert rtree_join.T_NUM / rtree_join.T_DEN == 0.8
    assert pq.read_schema(f"{sf_small}/documents.parquet").names == docs.columns
