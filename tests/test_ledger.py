"""Ledger operators (K6, W1, W2, A5, A11, A12, J4, J6, J9) and path parsing."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow.functions import paths as ph
from docflow.operators import ledger as lg
from docflow.plans import bindings as B
from docflow.sources import tokens as tk

SCHEMA = "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"
T0 = dt.datetime(2024, 1, 1)


def ledger(spark, rows):
    return spark.createDataFrame(
        [(a, y, s, T0 + dt.timedelta(seconds=i), i, m, o) for i, (a, y, s, m, o) in enumerate(rows)], SCHEMA)


def test_message_fold(spark):
    led = ledger(spark, [("1", 2001, "claimed", "a", False), ("1", 2001, "claimed", "b", False),
                         ("1", 2001, "processed", "T", True), ("1", 2001, "processed", "z", False),
                         ("2", 2001, "claimed", "", True)])
    got = {r.ack_id: r.body for r in lg.message_fold(led).collect()}
    assert got == {"1": "T\nz\n"}  # an empty message writes nothing and does not truncate


def test_latest_status_and_waterfall(spark):
    led = ledger(spark, [("1", 2001, "to_download", None, False), ("1", 2001, "processed", None, False),
                         ("2", 2001, "to_download", None, False), ("3", 2002, "plan_not_found", None, False)])
    cur = {r.ack_id: r.status for r in lg.latest_status(led).collect()}
    assert cur == {"1": "processed", "2": "to_download", "3": "plan_not_found"}
    wf = {r.year: r.asDict() for r in lg.status_waterfall(lg.latest_status(led)).collect()}
    assert wf[2001]["processed"] == 1 and wf[2001]["to_download"] == 1 and wf[2001]["claimed"] == 0
    assert wf[2002]["plan_not_found"] == 1


def test_fetch_outcome_golden(spark):
    rows = [(1, 1, 503), (1, 2, 503), (1, 3, 200), (2, 1, 404), (3, 1, 503), (3, 2, 503), (3, 3, 503),
            (3, 4, 503), (3, 5, 503), (3, 6, 200), (4, 1, 503), (4, 2, 503)]
    a = spark.createDataFrame(rows, "doc int, event_id int, status_code int")
    got = {r.doc: (r.outcome, r.attempts, r.next_wait_s) for r in lg.fetch_outcome(a).collect()}
    assert got == {1: ("ok", 3, None), 2: ("permanent", 1, None), 3: ("exhausted", 5, None),
                   4: ("pending", 2, 4.0)}


def test_fetch_outcome_fixture_counts(spark):
    got = {r.outcome: r.n for r in lg.fetch_outcome(B.attempts(spark, "/root/testdata/sf0.01"))
           .groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"ok": 91, "permanent": 37, "exhausted": 22}


def test_lookup_ambiguous(spark):
    u = spark.createDataFrame([("1", 2001, "a", "f", "s"), ("1", 2001, "b", "f", "s"), ("2", 2001, "c", None, "t")],
                              "ack_id string, filing_year int, link string, facsimile_link string, sponsor_name string")
    docs = spark.createDataFrame([("1", 2001), ("2", 2001), ("3", 2001)], "ack_id string, year int")
    got = {r.ack_id: (r.link, r.ambiguous) for r in lg.lookup_attributes(docs, u).collect()}
    assert got == {"1": (None, True), "2": ("c", False), "3": (None, None)}


def test_seed_ledger_idempotent(spark):
    u = spark.createDataFrame([("1", 2001), ("2", 2001)], "ack_id string, filing_year int")
    led = ledger(spark, [("1", 2001, "to_download", None, False), ("1", 2001, "processed", None, False)])
    assert [r.ack_id for r in lg.seed_ledger(u, led).collect()] == ["2"]
    both = led.unionByName(lg.seed_ledger(u, led, ts=T0).select(
        "ack_id", "year", "status", "ts", F.lit(99).cast("long").alias("seq"), F.lit(None).cast("string").alias("message"),
        F.lit(False).alias("overwrite_")))
    assert lg.seed_ledger(u, both).count() == 0


def test_next_batch_and_recover(spark):
    rows = [(str(i), 2001, "to_download", None, False) for i in range(10)]
    rows += [("x", 2001, "to_process", None, False), ("x", 2001, "claimed", None, False)]
    led = ledger(spark, rows)
    nb = lg.next_batch(lg.latest_status(led), 3)
    assert [r.ack_id for r in nb.orderBy("batch_rank").collect()] == ["0", "1", "2"]
    assert "WindowGroupLimit" in nb._jdf.queryExecution().executedPlan().toString()
    rec = lg.recover_claims(led).collect()
    assert [(r.ack_id, r.status) for r in rec] == [("x", "to_process")]


def test_pending_work(spark):
    u = spark.createDataFrame([("1", 2001), ("2", 2001), ("3", 2001)], "ack_id string, filing_year int")
    led = ledger(spark, [("1", 2001, "processed", None, False), ("2", 2001, "claimed", None, False)])
    assert sorted(r.ack_id for r in lg.pending_work(u, led).collect()) == ["2", "3"]


def test_parse_paths(spark):
    df = spark.createDataFrame([("/a/t/q/2012/x.y.txt",), ("/a/t/q/abcd/x.txt",), ("C:\\t\\q\\2013\\z.txt",)],
                               "path string")
    got = [(r.ack_id, r.year, r.status) for r in ph.parse_status_path(df).collect()]
    assert got == [("x.y", 2012, "q"), ("z", 2013, "q")]
    tp = ph.parse_token_path(df).first()
    assert (tp.ack_id, tp.year) == ("x.y", "2012")


def test_clean_token_names(spark):
    df = spark.createDataFrame([("f", "12.txt.claiming.3.4"), ("g", "12.txt.claiming.3.4"), ("g", "12.txt"),
                                ("h", "5.txt.a"), ("h", "5.txt.b"), ("h", "notes")], "folder string, name string")
    got = {(r.folder, r.name): r.new_name for r in ph.clean_token_names(df).collect()}
    assert got[("f", "12.txt.claiming.3.4")] == "12.txt"
    assert got[("g", "12.txt.claiming.3.4")] == "12.txt.claiming.3.4"
    assert got[("h", "5.txt.a")] == "5.txt" and got[("h", "5.txt.b")] == "5.txt.b"
    assert got[("h", "notes")] == "notes"
    assert ph.skip_in_progress(df).count() == 4


def test_token_tree_listing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tracker")
    for rel, body in [("queue/to_download/2001/1.txt", ""), ("claimed/2001/2.txt", ""),
                      ("error/plan_not_found/2002/3.txt", ""), ("processed/2001/4.txt", "text one\n"),
                      ("processed/2002/5.txt", "two"), ("queue/to_download/2001/6.txt.claiming.1.2", ""),
                      ("notes/readme.txt", "x")]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write(body)
    listing = tk.scan_status_tree(spark, root)
    recs = tk.status_records(listing)
    got = sorted((r.ack_id, r.year, r.status, r.size) for r in recs.collect())
    assert got == [("1", 2001, "to_download", 0), ("2", 2001, "claimed", 0), ("3", 2002, "plan_not_found", 0),
                   ("4", 2001, "processed", 9), ("5", 2002, "processed", 3)]
    pay = {r.ack_id: r.ocr_text for r in tk.read_payload(spark, recs, root).collect()}
    assert pay["4"] == "text one\n" and pay["5"] == "two" and pay["1"] is None


def test_write_token_tree(spark, tmp_dir):
    cur = spark.createDataFrame([("1", 2001, "to_download", None), ("2", 2001, "processed", "body")],
                                "ack_id string, year int, status string, body string")
    root = os.path.join(tmp_dir, "tree")
    assert tk.write_token_tree(cur, root) == 2
    assert os.path.getsize(os.path.join(root, "queue/to_download/2001/1.txt")) == 0
    assert open(os.path.join(root, "processed/2001/2.txt")).read() == "body"


def test_claim_conflicts(spark):
    paths = spark.createDataFrame([("/t/claimed/2001/1.txt",), ("/t/queue/to_download/2001/1.txt",),
                                   ("/t/claimed/2001/2.txt",), ("/t/queue/to_download/2002/2.txt",)], "path string")
    got = [(r.ack_id, r.year) for r in lg.claim_conflicts(ph.parse_status_path(paths)).collect()]
    assert got == [("1", 2001)]
