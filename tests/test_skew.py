"""One key holding most rows: results stay right and the plans keep their map-side steps."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow.operators import ledger as lg

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_document_attempts(spark):
    hot = spark.range(30000).select(F.lit(1).alias("doc"), (F.col("id") + 10).alias("event_id"),
                                    F.lit(503).alias("status_code"))
    cold = spark.createDataFrame([(1, 5, 503), (2, 1, 200), (3, 1, 404)], "doc long, event_id long, status_code int")
    a = hot.unionByName(cold.select("doc", "event_id", "status_code"))
    got = {r.doc: (r.outcome, r.attempts) for r in lg.fetch_outcome(a).collect()}
    assert got == {1: ("exhausted", 5), 2: ("ok", 1), 3: ("permanent", 1)}
    assert "partial_min" in plan(lg.fetch_outcome(a))


def test_hot_year_batch_and_waterfall(spark):
    rows = spark.range(40000).select(
        F.col("id").cast("string").alias("ack_id"),
        F.when(F.col("id") % 10 < 9, 2001).otherwise(2002 + F.col("id") % 3).cast("int").alias("year"),
        F.lit("to_download").alias("status"),
        F.lit(T0).cast("timestamp").alias("ts"),
        F.col("id").alias("seq"),
    )
    cur = lg.latest_status(rows)
    nb = lg.next_batch(cur, 20)
    counts = {r.year: r.n for r in nb.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {2001: 20, 2002: 20, 2003: 20, 2004: 20}
    assert "WindowGroupLimit" in plan(nb) and "Partial" in plan(nb)
    wf = {r.year: r.to_download for r in lg.status_waterfall(cur).collect()}
    assert wf[2001] == 36000
    assert "partial_count" in plan(lg.status_waterfall(cur))


def test_hot_document_message_fold(spark):
    msgs = spark.range(20000).select(
        F.lit("1").alias("ack_id"), F.lit(2001).alias("year"), F.lit("processed").alias("status"),
        F.lit(T0).cast("timestamp").alias("ts"), F.col("id").alias("seq"),
        F.col("id").cast("string").alias("message"), (F.col("id") == 19998).alias("overwrite_"))
    body = lg.message_fold(msgs).first().body
    assert body == "19998\n19999\n"
    # the overwrite point is a partial aggregate joined back, not a window over the hot document
    p = plan(lg.message_fold(msgs))
    assert "Window" not in p and "partial_max" in p


def test_hot_year_written_by_many_tasks(spark, tmp_dir):
    # a year with 60% of the rows is cut over several range partitions (files), none lost
    from docflow.sources import tables as tb

    hot = spark.range(6000).select(F.col("id").cast("string").alias("ack_id"), F.lit(2001).alias("filing_year"))
    cold = spark.range(6000, 10000).select(F.col("id").cast("string").alias("ack_id"),
                                           (2002 + F.col("id") % 4).cast("int").alias("filing_year"))
    df = hot.unionByName(cold).repartition(8)
    path = tb.write_by_year(df, os.path.join(tmp_dir, "by_year"), partitions=8)
    files = [f for f in os.listdir(os.path.join(path, "filing_year=2001")) if f.endswith(".parquet")]
    assert len(files) >= 4
    assert tb.scan_universe(spark, path, 2001).count() == 6000
    assert spark.read.parquet(path).count() == 10000
    # default: REBALANCE - adaptive execution splits the hot year by measured size
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "4k")
    try:
        path = tb.write_by_year(df, os.path.join(tmp_dir, "by_year_rebalance"))
    finally:
        spark.conf.set(key, old)
    files = [f for f in os.listdir(os.path.join(path, "filing_year=2001")) if f.endswith(".parquet")]
    assert len(files) >= 4
    assert spark.read.parquet(path).count() == 10000
