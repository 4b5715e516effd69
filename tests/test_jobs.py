"""The three entry points end to end on a small fixture."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow.plans import jobs
from docflow.sources import documents as dc
from docflow.sources import index_files as ix


def test_jobs_end_to_end(spark, tmp_dir):
    idx = spark.createDataFrame(
        [(str(i), 2001 + i % 2, f"Sponsor {i}", f"https://a/{i}", None, i % 2) for i in range(8)],
        "ack_id string, filing_year int, sponsor_name string, link string, facsimile_link string, bucket int")
    index_root = ix.write_index_files(idx, os.path.join(tmp_dir, "index"))
    ids_path = os.path.join(tmp_dir, "ids")
    spark.createDataFrame([(str(i), "2J" if i != 5 else "1A") for i in range(6)],
                          "ack_id string, pension_benefit_code string").write.parquet(ids_path)
    res = jobs.build_universe_job(spark, index_root, [{"path": ids_path}], os.path.join(tmp_dir, "u"))
    assert res["all_valid"] is True
    universe = spark.read.parquet(res["universe_all"])
    assert sorted(r.ack_id for r in universe.collect()) == ["0", "1", "2", "3", "4"]

    ledger = os.path.join(tmp_dir, "ledger")
    t0 = dt.datetime(2025, 1, 1)
    assert jobs.seed_job(spark, res["universe_all"], ledger, ts=t0) == 5
    assert jobs.seed_job(spark, res["universe_all"], ledger, ts=t0) == 0  # idempotent

    # documents 0-3 were fetched: move them to to_process
    fetched = jobs.read_ledger(spark, ledger).where(F.col("ack_id") != "4").select(
        "ack_id", "year", F.lit("to_process").alias("status"), F.lit(t0 + dt.timedelta(hours=1)).alias("ts"),
        F.lit(0).cast("long").alias("seq"), F.lit(None).cast("string").alias("message"), F.lit(False).alias("overwrite_"))
    jobs.append_transitions(fetched, ledger)
    pages = {"0": ["cover", "Plan Description: the plan"], "1": ["nothing here"], "2": ["plan description"],
             "3": ["x"] * 5}
    ps = spark.createDataFrame([(k, 2001 + int(k) % 2, v) for k, v in pages.items()],
                               "ack_id string, year int, pages array<string>")
    doc_root = dc.write_document_files(ps, os.path.join(tmp_dir, "docs"))
    jobs.process_job(spark, doc_root, ledger, os.path.join(tmp_dir, "routed"), terms=["plan description"],
                     limit_pages=4, ts=t0 + dt.timedelta(hours=2))
    from docflow.operators import ledger as lg

    cur = {r.ack_id: r.status for r in lg.latest_status(jobs.read_ledger(spark, ledger)).collect()}
    assert cur == {"0": "processed", "1": "plan_not_found", "2": "text_extraction_empty", "3": "file_too_long",
                   "4": "to_download"}

    train = spark.createDataFrame([("0",)], "ack_id string")
    outs = jobs.outputs_job(spark, ledger, os.path.join(tmp_dir, "out"), train)
    texts = spark.read.parquet(outs["year_text"]).collect()
    assert [(r.ack_id, r.ocr_text) for r in texts] == [("0", "Plan Description: the plan\n")]
    assert spark.read.parquet(outs["records"]).count() == 5
    assert outs["train"] and outs["full"]


def test_command_line_universe(spark, tmp_dir, capsys):
    import json

    from docflow.__main__ import main

    idx = spark.createDataFrame([(str(i), 2001, f"S{i}", "u", None, 0) for i in range(4)],
                                "ack_id string, filing_year int, sponsor_name string, link string, "
                                "facsimile_link string, bucket int")
    index_root = ix.write_index_files(idx, os.path.join(tmp_dir, "index"))
    ids_path = os.path.join(tmp_dir, "ids")
    spark.createDataFrame([("1",), ("3",)], "ack_id string").write.parquet(ids_path)
    main(["universe", "--index", index_root, "--ids", ids_path, "--out", os.path.join(tmp_dir, "u")])
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.parquet(res["universe_all"]).count() == 2 and res["all_valid"] is True


def test_process_job_with_codec_cascade(spark, tmp_dir):
    ledger = os.path.join(tmp_dir, "ledger")
    t0 = dt.datetime(2025, 1, 1)
    todo = spark.createDataFrame([(k, 2001, "to_process", t0, 0, None, False) for k in ("a", "b", "c")],
                                 "ack_id string, year int, status string, ts timestamp, seq long, message string, "
                                 "overwrite_ boolean")
    jobs.append_transitions(todo, ledger)
    ps = spark.createDataFrame([("a", 2001, ["x", "plan description here"]), ("b", 2001, ["scan only"]),
                                ("c", 2001, ["bad"])], "ack_id string, year int, pages array<string>")
    root = dc.write_document_files(ps, os.path.join(tmp_dir, "docs"))

    def text_layer(b):
        if b.startswith(b"bad"):
            raise ValueError("cannot open")
        return ["" if "scan" in p else p for p in dc.form_feed_pages(b)]

    def ocr(b):
        return [p.replace("scan only", "plan description of the scan") for p in dc.form_feed_pages(b)]

    jobs.process_job(spark, root, ledger, os.path.join(tmp_dir, "routed"), terms=["plan description"],
                     extractors=[(1, text_layer, False), (3, ocr, False)], ts=t0 + dt.timedelta(hours=1))
    from docflow.operators import ledger as lg

    cur = {r.ack_id: r.status for r in lg.latest_status(jobs.read_ledger(spark, ledger)).collect()}
    # a: text layer hits, its window lacks "the" -> OCR text of the window is used (A10)
    assert cur == {"a": "text_extraction_empty", "b": "processed", "c": "corrupted_file"}


def test_tree_outputs_job(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tracker")
    for rel, body in [("processed/2001/1.txt", "Ã© the text\n"), ("processed/2002/2.txt", ""),
                      ("error/plan_not_found/2001/3.txt", ""), ("queue/to_download/2001/4.txt", ""),
                      ("queue/to_download/2001/1.txt", "")]:  # D4: a stale seed token for id 1
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write(body)
    train = spark.createDataFrame([("1",)], "ack_id string")
    outs = jobs.tree_outputs_job(spark, root, os.path.join(tmp_dir, "out"), train)
    assert spark.read.parquet(outs["records"]).count() == 5
    texts = sorted((r.ack_id, r.ocr_text) for r in spark.read.parquet(outs["year_text"]).collect())
    assert texts == [("1", "é the text\n"), ("2", "")]
    assert [r.ack_id for r in spark.read.parquet(outs["train"]).collect()] == ["1"]


def test_entry_from_another_working_directory(tmp_dir):
    # the driver contract is loaded by path with a plain session; Python workers (NFKC UDF,
    # token-tree listing) must still import the package
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(repo, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
qs = E.queries()
print("RESULT", E.entry(spark).count(), qs["nfkc"](spark, "/root/testdata/sf0.001").count(),
      qs["scan_status_tree"](spark, "/root/testdata/sf0.001").count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_dir, env=env, capture_output=True, text=True,
                         timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    n_entry, n_nfkc, tree = line[0].split()[1:]
    assert int(n_entry) > 0 and int(n_nfkc) > 0 and tree == "True"


def test_spread_documents_by_count_after_join(spark):
    # listing rows are tiny: after a join AQE would coalesce them into one task; the spread
    # keeps about docs_per_task documents per extraction task
    listing = spark.range(400).select(F.col("id").cast("string").alias("ack_id"), F.lit(2001).alias("year"),
                                      F.concat(F.lit("/d/"), F.col("id").cast("string")).alias("path"))
    todo = spark.range(0, 400, 2).select(F.col("id").cast("string").alias("ack_id"), F.lit(2001).alias("year"))
    docs = jobs.spread_documents(listing.join(todo.hint("merge"), ["ack_id", "year"], "left_semi"), docs_per_task=20)
    parts = docs.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in parts) == 200
    assert len(parts) >= 8 and max(r["count"] for r in parts) <= 40


def test_read_payload_without_processed_folder(spark, tmp_dir):
    from docflow.sources import tokens as tk

    root = os.path.join(tmp_dir, "tracker")
    p = os.path.join(root, "queue/to_download/2001/4.txt")
    os.makedirs(os.path.dirname(p), exist_ok=True)
    open(p, "w").close()
    recs = tk.status_records(tk.scan_status_tree(spark, root))
    rows = tk.read_payload(spark, recs, root).collect()
    assert [(r.ack_id, r.status, r.ocr_text) for r in rows] == [("4", "to_download", None)]
