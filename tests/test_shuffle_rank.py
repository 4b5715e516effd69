from pyspark.sql import functions as F

from docflow.operators import outputs as out


def test_ranks_follow_the_sorted_order(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("ack_id")).union(spark.createDataFrame([(None,), ("7",)], "ack_id string"))
    ranked = {r.shuffle_rank: r.ack_id for r in out.shuffle_rank(df.repartition(5)).collect()}
    assert [ranked[i + 1] for i in range(3002)] == [r.ack_id for r in out.stable_shuffle(df).collect()]
    assert out.shuffle_rank(df.limit(0)).count() == 0
