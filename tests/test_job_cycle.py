"""Seed, claim, fetch, process and recover as jobs: no hand-written ledger rows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators import ledger as lg
from docflow.plans import jobs
from docflow.sources import documents as dc
from docflow.sources import fs
from docflow.sources import index_files as ix

T0 = dt.datetime(2025, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def _universe(spark, root, n=6, fmt="parquet"):
    rows = [(f"d{i}", 2001 + i % 2, f"Sponsor {i}", f"https://a/{i}" if i else " ", f"https://f/{i}") for i in range(n)]
    path = os.path.join(root, "universe")
    df = spark.createDataFrame(rows, "ack_id string, filing_year int, sponsor_name string, link string, facsimile_link string")
    df.write.format(fmt).option("header", "true").save(path)
    return path


def _attempts(spark, root, rows, name="attempts"):
    path = os.path.join(root, name)
    spark.createDataFrame(rows, jobs.ATTEMPT_SCHEMA).write.parquet(path)
    return path


def _status(spark, ledger):
    return {r.ack_id: r.status for r in lg.latest_status(jobs.read_ledger(spark, ledger)).collect()}


def test_whole_cycle(spark, tmp_dir):
    ledger, out = os.path.join(tmp_dir, "ledger"), os.path.join(tmp_dir, "out")
    universe = _universe(spark, tmp_dir)
    assert jobs.seed_job(spark, universe, ledger, ts=T0) == 6

    batch = os.path.join(tmp_dir, "batch")
    got = jobs.claim_job(spark, universe, ledger, batch, 2, ts=at(1), run="c1")
    assert got == {"run": "c1", "claimed": 4}
    assert jobs.claim_job(spark, universe, ledger, batch, 2, ts=at(1), run="c1") == got  # repeated: the same rows
    rows = {r.ack_id: r.url for r in spark.read.parquet(batch).collect()}
    assert rows == {"d0": "https://f/0", "d1": "https://a/1", "d2": "https://a/2", "d3": "https://a/3"}
    assert _status(spark, ledger) == {**{k: C.CLAIMED for k in rows}, "d4": C.TO_DOWNLOAD, "d5": C.TO_DOWNLOAD}

    log = [("d0", 2001, 1, at(2), 503, None, "busy"), ("d0", 2001, 2, at(2), 200, None, None),
           ("d1", 2002, 1, at(2), 404, None, "no such file"), ("d1", 2002, 2, at(2), 200, None, "later"),
           ("d2", 2001, 1, at(2), None, "network", "reset"),
           ("d3", 2002, 1, at(-5), 404, None, "an earlier try"),
           ("d4", 2001, 1, at(2), None, "other", "bad url"),
           ("d9", 2001, 1, at(2), 200, None, None)]  # not in the ledger
    log += [("d5", 2002, i, at(2), 500, None, f"error {i}") for i in range(1, 8)]
    attempts, fetched = _attempts(spark, tmp_dir, log), os.path.join(tmp_dir, "fetched")
    res = jobs.fetch_job(spark, attempts, ledger, fetched, ts=at(3), run="f1")
    assert res == {"run": "f1", "ok": 1, "permanent": 2, "exhausted": 1, "pending": 1}
    assert _status(spark, ledger) == {"d0": C.TO_PROCESS, "d1": C.DOWNLOAD_FAILED, "d2": C.CLAIMED, "d3": C.CLAIMED,
                                      "d4": C.DOWNLOAD_FAILED, "d5": C.DOWNLOAD_FAILED}
    said = {r.ack_id: r.body for r in lg.message_fold(jobs.read_ledger(spark, ledger)).collect()}
    assert said == {"d1": "no such file\n", "d4": "bad url\n", "d5": "error 5\n"}
    assert jobs.fetch_job(spark, attempts, ledger, fetched, ts=at(4), run="f2") == {"run": "f2", "pending": 1}  # read again

    assert jobs.recover_job(spark, ledger, before=at(1)) == 0
    assert jobs.recover_job(spark, ledger, before=at(2), ts=at(5)) == 2
    assert {k for k, v in _status(spark, ledger).items() if v == C.TO_DOWNLOAD} == {"d2", "d3"}
    assert jobs.recover_job(spark, ledger, ts=at(6)) == 0

    # a batch claimed from to_process is processed under its claim; unclaimed work is left alone
    more = [("d2", 2001, 1, at(7), 200, None, None), ("d3", 2002, 1, at(7), 200, None, None)]
    jobs.fetch_job(spark, _attempts(spark, tmp_dir, more, "more"), ledger, fetched, ts=at(8))
    docs = dc.write_document_files(spark.createDataFrame(
        [("d0", 2001, ["cover", "Plan Description: the plan"]), ("d2", 2001, ["nothing"])],
        "ack_id string, year int, pages array<string>"), os.path.join(tmp_dir, "docs"))
    jobs.claim_job(spark, universe, ledger, batch, 1, C.TO_PROCESS, ts=at(9), run="p1")
    terms = ["plan description"]
    jobs.process_job(spark, docs, ledger, out, terms, ts=at(10), claimed_by="p1", run="r1")
    now = _status(spark, ledger)
    assert (now["d0"], now["d2"], now["d3"]) == (C.PROCESSED, C.TO_PROCESS, C.CLAIMED)
    # d3 has no file: reported, not moved, and given back by recovery to the queue it came from
    rows = spark.read.parquet(out).where("status IS NULL").collect()
    assert [(r.ack_id, r.message, r.text) for r in rows] == [("d3", "no file", None)]
    assert jobs.recover_job(spark, ledger, ts=at(11)) == 1
    jobs.process_job(spark, docs, ledger, out, terms, ts=at(12))
    now = _status(spark, ledger)
    assert (now["d2"], now["d3"]) == (C.PLAN_NOT_FOUND, C.TO_PROCESS)


def test_empty_inputs(spark, tmp_dir):
    ledger = os.path.join(tmp_dir, "ledger")
    universe = _universe(spark, tmp_dir, 1)
    attempts = _attempts(spark, tmp_dir, [])
    assert jobs.claim_job(spark, universe, ledger, os.path.join(tmp_dir, "b"), 5)["claimed"] == 0
    assert set(jobs.fetch_job(spark, attempts, ledger, os.path.join(tmp_dir, "f"))) == {"run"}
    assert jobs.recover_job(spark, ledger) == 0


def _ready(spark, ledger, ids):
    rows = [(i, 2001, C.TO_PROCESS, T0, 0, None, False) for i in ids]
    jobs.append_transitions(spark.createDataFrame(
        rows, "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"), ledger)


def test_reader_errors_and_unread_files(spark, tmp_dir):
    def text_layer(b):
        return ["" for _ in dc.form_feed_pages(b)]

    def ocr(b):
        if b.startswith(b"bad"):
            raise ValueError("cannot render")
        return dc.form_feed_pages(b)

    ledger, out = os.path.join(tmp_dir, "ledger"), os.path.join(tmp_dir, "out")
    _ready(spark, ledger, ["a", "b", "c"])
    root = dc.write_document_files(spark.createDataFrame(
        [("a", 2001, ["plan description the"]), ("b", 2001, ["bad"]), ("c", 2001, ["x"])],
        "ack_id string, year int, pages array<string>"), os.path.join(tmp_dir, "docs"))
    real = jobs.dc.scan_documents
    try:  # the listing names a file that is gone when the task opens it
        jobs.dc.scan_documents = lambda *a, **k: real(*a, **k).withColumn(
            "path", F.when(F.col("ack_id") == "c", F.concat("path", F.lit(".gone"))).otherwise(F.col("path")))
        jobs.process_job(spark, root, ledger, out, ["plan description"], [(1, text_layer, False), (3, ocr, False)],
                         ts=at(1))
        _ready(spark, os.path.join(tmp_dir, "l2"), ["a", "c"])
        jobs.process_job(spark, root, os.path.join(tmp_dir, "l2"), os.path.join(tmp_dir, "o2"), ["plan description"], ts=at(1))
    finally:
        jobs.dc.scan_documents = real
    assert _status(spark, ledger) == {"a": C.PROCESSED, "b": C.PDF_READER_FAILED, "c": C.TO_PROCESS}
    body = {r.ack_id: r.body for r in lg.message_fold(jobs.read_ledger(spark, ledger)).collect()}
    assert "cannot render" in body["b"] and set(body) == {"a", "b"}
    held = spark.read.parquet(out).where("status IS NULL").collect()
    assert [r.ack_id for r in held] == ["c"] and held[0].message.startswith(dc.UNREAD)
    assert _status(spark, os.path.join(tmp_dir, "l2")) == {"a": C.PROCESSED, "c": C.TO_PROCESS}


def test_unknown_scheme_raises(spark, tmp_dir):
    with pytest.raises(ValueError, match="no file system"):
        jobs.process_job(spark, "nosuch://host/docs", os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "o"))
    assert fs.uri_prefix("/a/b") == fs.uri_prefix("file:///a/b") == ""


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_universe_reports(spark, tmp_dir, fmt):
    idx = spark.createDataFrame([(str(i), 2001 + i % 2, f'S "{i}"', "u", None, 0) for i in range(6)],
                                "ack_id string, filing_year int, sponsor_name string, link string, "
                                "facsimile_link string, bucket int")
    index_root = ix.write_index_files(idx, os.path.join(tmp_dir, "index"))
    os.makedirs(os.path.join(index_root, "y=2009", "b=0"))
    with open(os.path.join(index_root, "y=2009", "b=0", "part-0.txt"), "w") as fh:
        fh.write("only\n")
    lists = []
    for name, rows, cols in (("a", [("1", "2J"), ("2", "1A"), ("2", None), ("9", "2L")], "ack_id string, pension_benefit_code string"),
                             ("b", [("3",), ("1",)], "ack_id string"),
                             ("none", [], "ack_id string, pension_benefit_code string")):
        lists.append({"path": os.path.join(tmp_dir, name)})
        spark.createDataFrame(rows, cols).write.parquet(lists[-1]["path"])
    res = jobs.build_universe_job(spark, index_root, lists, os.path.join(tmp_dir, "u"), fmt=fmt)
    assert [(x["n_rows"], x["n_kept"], x["n_unique_ids"]) for x in res["id_lists"]] == [(4, 2, 2), (2, 2, 2), (0, 0, 0)]
    assert res["rows"] == 2 and res["all_valid"] is True
    assert res["bad_lines"]["rows"] == 2 and res["files_without_header"]["rows"] == 1
    ledger = os.path.join(tmp_dir, "ledger")
    assert jobs.seed_job(spark, res["universe_all"], ledger, fmt=fmt) == 2
    batch = os.path.join(tmp_dir, "batch")
    assert jobs.claim_job(spark, res["universe_all"], ledger, batch, 9, fmt=fmt)["claimed"] == 2
    assert {(r.ack_id, r.url, r.sponsor_name) for r in spark.read.parquet(batch).collect()} == {
        ("1", "u", 'S "1'), ("3", "u", 'S "3')}


def test_csv_outputs_keep_texts(spark, tmp_dir):
    ledger = os.path.join(tmp_dir, "ledger")
    text = ' the "first", line\nand\tanother '
    spark_rows = [("a", 2001, C.PROCESSED, T0, 1, text, True), ("b", 2001, C.TO_PROCESS, T0, 1, None, False)]
    jobs.append_transitions(spark.createDataFrame(
        spark_rows, "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"), ledger)
    train = spark.createDataFrame([("a",)], "ack_id string")
    res = jobs.outputs_job(spark, ledger, os.path.join(tmp_dir, "o"), train, fmt="csv")
    from docflow.sources import tables as tb

    for name in ("train", "full"):
        rows = tb.read_table(spark, res[name], "ack_id string, year int, ocr_text string", "csv").collect()
        assert [(r.ack_id, r.year, r.ocr_text) for r in rows] == [("a", 2001, text + "\n")]


def test_commands(spark, tmp_dir, capsys):
    from docflow.__main__ import main

    universe, ledger = _universe(spark, tmp_dir), os.path.join(tmp_dir, "ledger")

    def run(*args):
        main(list(args))
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert run("seed", "--universe", universe, "--ledger", ledger) == {"seeded": 6}
    claimed = run("claim", "--universe", universe, "--ledger", ledger, "--out", os.path.join(tmp_dir, "b"), "--n", "1")
    assert claimed["claimed"] == 2
    assert run("recover", "--ledger", ledger, "--before", "2020-01-01T00:00:00") == {"recovered": 0}
    attempts = _attempts(spark, tmp_dir, [("d0", 2001, 1, None, 200, None, None)])
    assert run("fetch", "--attempts", attempts, "--ledger", ledger, "--out", os.path.join(tmp_dir, "f"))["ok"] == 1
    docs = dc.write_document_files(spark.createDataFrame(
        [("d0", 2001, ["the Plan Description"])], "ack_id string, year int, pages array<string>"), os.path.join(tmp_dir, "docs"))
    run("process", "--docs", docs, "--ledger", ledger, "--out", os.path.join(tmp_dir, "o"),
        "--extractor", "1=native", "--extractor", "3=docflow.sources.documents:form_feed_pages", "--tolerant", "3")
    assert _status(spark, ledger)["d0"] == C.PROCESSED
