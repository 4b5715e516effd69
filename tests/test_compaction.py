"""Ledger snapshots: equal to the whole log after compaction, replay, failure and vacuum."""
import datetime as dt
import os

from pyspark.sql import functions as F

from docflow.streaming import compaction as cp


def write_batch(spark, log, number, rows):
    made = [(i, y, s, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=t), t) for i, y, s, t in rows]
    df = spark.createDataFrame(made, cp.ROWS).withColumn("batch_id", F.lit(number))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log)


def current(spark, log, snaps):
    return sorted(((r.ack_id, r.year, r.status, r.seq) for r in cp.read_current(spark, log, snaps).collect()), key=str)


def test_snapshot_replay_failure_and_vacuum(spark, tmp_dir):
    log, snaps = tmp_dir + "/log", tmp_dir + "/snaps"
    assert cp.compact(spark, log, snaps) is None
    write_batch(spark, log, 0, [("a", 1, "to_download", 1), ("b", 1, "to_download", 2), (None, 1, "claimed", 3)])
    write_batch(spark, log, 1, [("a", 1, "claimed", 4)])
    assert cp.compact(spark, log, snaps) == 1 and cp.compact(spark, log, snaps) is None
    first = [("a", 1, "claimed", 4), ("b", 1, "to_download", 2), (None, 1, "claimed", 3)]
    assert current(spark, log, snaps) == sorted(first, key=str)
    write_batch(spark, log, 1, [("a", 1, "claimed", 4)])  # replayed: already in the snapshot
    write_batch(spark, log, 2, [("b", 1, "processed", 9), ("c", 2, "to_process", 8), ("a", 1, "late", 0), (None, 1, "done", 7)])
    want = sorted([("a", 1, "claimed", 4), ("b", 1, "processed", 9), ("c", 2, "to_process", 8), (None, 1, "done", 7)], key=str)
    assert current(spark, log, snaps) == want
    # a compaction that died before its marker: its folder is not read, and the next one replaces it
    spark.createDataFrame([("x", 9, "wrong", None, 0)], cp.ROWS).write.parquet(snaps + "/snapshot=2/rows")
    assert current(spark, log, snaps) == want
    assert cp.compact(spark, log, snaps) == 2 and current(spark, log, snaps) == want
    assert cp.vacuum(spark, log, snaps) == 2 and sorted(os.listdir(snaps)) == ["snapshot=1", "snapshot=2"]
    assert current(spark, log, snaps) == want


def test_new_ids_and_plan(spark, tmp_dir):
    log, snaps = tmp_dir + "/log", tmp_dir + "/snaps"
    ids = spark.createDataFrame([("a", 1), ("n", 1), ("b", 2), ("c", 2), (None, 1)], "ack_id string, year int")
    assert cp.new_ids(spark, ids, log, snaps).count() == 5
    write_batch(spark, log, 0, [("a", 1, "claimed", 1), ("b", 1, "claimed", 2)])
    cp.compact(spark, log, snaps)
    write_batch(spark, log, 1, [("c", 2, "claimed", 3)])
    got = cp.new_ids(spark, ids, log, snaps)
    assert sorted(((r.ack_id, r.year) for r in got.collect()), key=str) == sorted([("n", 1), ("b", 2), (None, 1)], key=str)
    base = cp.latest_snapshot(spark, snaps)
    kept = base.keys.split(ids, *cp.KEY).where("not _maybe")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ack_id" not in kept  # surely new ids are not shuffled
