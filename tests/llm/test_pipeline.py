"""The pipeline against its stages called one by one, and the key filter that its stages drop rows by."""
import corpus_pipeline
from pyspark.sql import functions as F

from docflow.llm import common
from docflow.operators import bloom


def test_drop_rows_is_exact(spark, monkeypatch):
    rows = [(i, f"text {i % 40}", "z") for i in range(400)] + [(None, "text 1", "z"), (None, None, "z"), (7, None, "z"), (7, "text 7", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    keys = docs.select(F.col("doc_id").alias("gone_id"), common.text_hash("text").alias("gone_hash"))
    gone = common.stored(keys.where("gone_id is null or gone_id % 3 = 0").distinct(), "gone")
    want = sorted((r for r in rows if r[0] is not None and r[0] % 3), key=str)
    assert sorted((tuple(r) for r in common.drop_rows(docs, gone).collect()), key=str) == want
    monkeypatch.setattr(bloom, "BITS_PER_KEY", 0.01)  # a filter that takes nearly every row for a listed one
    assert sorted((tuple(r) for r in common.drop_rows(docs, gone).collect()), key=str) == want
    assert common.drop_rows(docs, gone.limit(0)).count() == len(rows)
    assert common.drop_rows(docs.limit(0), gone).count() == 0


def test_run_equals_its_stages(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    rows = [(10**6, None, None, None, None), (10**6 + 1, "", "en", "src1", 0), (None, "a few plain words of text", "en", None, 3)]
    docs = common.table(spark, sf, "documents")
    docs.union(spark.createDataFrame(rows, docs.schema)).write.parquet(tmp_dir + "/documents.parquet")
    for name in ("labels", "benchmark"):
        common.table(spark, sf, name).write.parquet(f"{tmp_dir}/{name}.parquet")
    whole = corpus_pipeline.run(spark, tmp_dir)
    step = common.table(spark, tmp_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        columns = step.columns
        step = common.stored(stage(spark, step, tmp_dir), name)
        assert name == "encode" or step.columns == columns
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, step.collect())) and step.count() > 50


def test_empty_tables(spark, tmp_dir):
    for name in ("documents", "labels", "benchmark"):
        common.table(spark, "/root/testdata/sf0.001", name).limit(0).write.parquet(f"{tmp_dir}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp_dir).count() == 0
