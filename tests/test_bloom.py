"""The Bloom filter never loses a key, keeps its stated error, merges, and finishes with an exact join."""
from pyspark.sql import functions as F

from docflow.operators import bloom


def test_no_key_is_lost_and_few_others_pass(spark, tmp_dir):
    keys = spark.range(50_000).select((F.col("id") * 3).cast("string").alias("k"), (F.col("id") % 26).alias("year"))
    bloom.build(keys, "k", "year").save(tmp_dir + "/f")
    filt = bloom.load(spark, tmp_dir + "/f")
    rows = spark.range(150_000).select(F.col("id").cast("string").alias("k"), F.expr("id div 3 % 26").alias("year"))
    got = {(r.known, r._maybe): r["count"] for r in filt.split(rows, "k", "year").groupBy((F.col("k") % 3 == 0).alias("known"), "_maybe").count().collect()}
    assert got[(True, True)] == 50_000 and (True, False) not in got
    assert got[(False, True)] < 0.01 * 100_000


def test_merge_equals_one_build(spark):
    a, b = spark.range(0, 500).toDF("k"), spark.range(300, 1000).toDF("k")
    both = bloom.build(a, "k", n_blocks=64).merge(bloom.build(b, "k", n_blocks=64))
    whole = bloom.build(a.union(b), "k", n_blocks=64)
    assert sorted(both.bits.collect()) == sorted(whole.bits.collect())


def test_anti_join_is_exact_even_when_the_filter_is_full(spark):
    rows = spark.createDataFrame([(None, "x"), (1, "a"), (1, "a"), (2, "b"), (3, "c")], "k long, v string")
    gone = spark.createDataFrame([(None,), (2,), (2,), (9,)], "k long")
    for filt in (None, bloom.build(gone, "k", n_blocks=1)):
        got = bloom.anti_join(rows, gone, ["k"], filt)
        assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (1, "a"), (3, "c")]
    many = spark.range(20_000).toDF("k")
    full = bloom.build(many, "k", n_blocks=1)  # every bit set: all rows are joined
    assert bloom.anti_join(rows, many, ["k"], full).collect() == [rows.where("k is null").first()]
    assert bloom.anti_join(rows, gone.limit(0), ["k"]).count() == rows.count()
    assert bloom.anti_join(rows.limit(0), gone, ["k"]).count() == 0


def test_rows_that_surely_stay_are_not_shuffled(spark):
    filt = bloom.build(spark.range(100).toDF("k"), "k")
    rows = spark.range(1000).toDF("k")
    plan = filt.split(rows, "k").where("not _maybe")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
