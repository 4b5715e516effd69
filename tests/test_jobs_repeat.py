"""Jobs that find nothing to do, run twice, or are repeated under their run id."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions import text as tx
from docflow.operators import ledger as lg
from docflow.plans import jobs


def _ready(spark, ledger, ids, ts):
    rows = [(i, 2001, C.TO_PROCESS, ts, 0, None, False) for i in ids]
    jobs.append_transitions(spark.createDataFrame(rows, "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"), ledger)


def test_empty_seed_drained_queue_and_second_run(spark, tmp_dir):
    ledger, docs, out = (os.path.join(tmp_dir, x) for x in ("ledger", "docs", "out"))
    universe = os.path.join(tmp_dir, "u")
    spark.createDataFrame([("d0", 2001)], "ack_id string, filing_year int").write.parquet(universe)
    assert jobs.seed_job(spark, universe, ledger, year=1990) == 0
    assert jobs.seed_job(spark, universe, ledger, run="s") == 1
    os.makedirs(os.path.join(docs, "2001"))
    for i in ("d0", "d1"):
        with open(os.path.join(docs, "2001", f"{i}.pdf"), "w") as fh:
            fh.write("nothing here")
    _ready(spark, ledger, ["d0"], dt.datetime(2030, 1, 1))
    jobs.process_job(spark, docs, ledger, out, ts=dt.datetime(2030, 1, 2))
    _ready(spark, ledger, ["d1"], dt.datetime(2030, 1, 3))
    jobs.process_job(spark, docs, ledger, out, ts=dt.datetime(2030, 1, 4))
    jobs.process_job(spark, docs, ledger, out)  # drained
    got = spark.read.parquet(out)
    assert sorted(r.ack_id for r in got.collect()) == ["d0", "d1"]
    assert lg.latest_status(jobs.read_ledger(spark, ledger)).where(F.col("status") == C.TO_PROCESS).count() == 0
    none = spark.createDataFrame([], "ack_id string")
    assert jobs.outputs_job(spark, ledger, os.path.join(tmp_dir, "o"), none)["full"] is None


def test_message_text_is_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = spark.createDataFrame([("a", 1, "x", 1, 1, True)], "ack_id string, year int, message string, ts int, seq int, overwrite_ boolean")
        p = lg.message_fold(m)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning") == 2  # messages once, last overwrites once


def test_fetch_outcome_limits_before_its_one_exchange(spark):
    a = spark.createDataFrame([(1, 1, 503)], "doc int, event_id int, status_code int")
    p = lg.fetch_outcome(a)._jdf.queryExecution().executedPlan().toString()
    assert p.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in p


def test_repaired_replacement_character_stays(spark):
    text = "a\u00ef\u00bf\u00bdb\u00e2\u0082\u00ef\u00bf\u00bd\u00ff\u00c3\u00a9"
    got = spark.createDataFrame([(text,), (None,), ("",)], "s string").select(tx.repair_mojibake("s")).collect()
    assert [r[0] for r in got] == [text.encode("latin-1", "ignore").decode("utf-8", "ignore"), None, ""]
