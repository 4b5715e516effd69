"""Outputs (J2, J3, J8, L1-L3, K5), streaming (T1-T3) and the driver contract."""

import os

from pyspark.sql import functions as F

from docflow.operators import outputs as out
from docflow.plans import bindings as B
from docflow.sources import documents as dc
from docflow.sources import tables as tb
from docflow.streaming import jobs as sj

SF = "/root/testdata/sf0.001"


def test_stable_shuffle_is_partition_invariant(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("ack_id"))
    orders = []
    for n in (1, 4, 7):
        orders.append([r.ack_id for r in out.stable_shuffle(df.repartition(n)).collect()])
    assert orders[0] == orders[1] == orders[2]
    assert orders[0] != sorted(orders[0])


def test_sample_and_preview(spark):
    df = spark.range(50).select(F.concat(F.lit("p/"), F.col("id").cast("string")).alias("path"))
    assert out.sample_k(df).count() == 5
    assert out.sample_k(df.limit(3)).count() == 3
    assert [r.path for r in out.preview_first(df, 2).collect()] == ["p/0", "p/1"]


def test_corpora_and_joins(spark, tmp_dir):
    texts = spark.createDataFrame([(" 1", 2001, "processed", "a"), ("2", 2001, "processed", "b")],
                                  "ack_id string, year int, status string, ocr_text string")
    train_ids = spark.createDataFrame([("1 ",), (None,)], "ack_id string")
    train, full = out.build_corpora(texts, train_ids)
    assert [r.ack_id for r in train.collect()] == ["1"]
    assert full.count() == 2  # D1: the full corpus keeps the training rows
    _, oos = out.build_corpora(texts, train_ids, exclude_train=True)
    assert [r.ack_id for r in oos.collect()] == ["2"]
    paths = tb.write_corpora(train.limit(0), full, os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "f"))
    assert paths["train"] is None and paths["full"]


def _docs(spark, root, n):
    ps = spark.createDataFrame(
        [(str(i), 2001, ["intro", "plan description and the text"] if i % 2 else ["nothing"]) for i in range(n)],
        "ack_id string, year int, pages array<string>")
    return dc.write_document_files(ps, root)


def test_stream_documents_batches_and_rerun(spark, tmp_dir):
    root = _docs(spark, os.path.join(tmp_dir, "docs"), 5)
    outp, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = sj.stream_documents(spark, root, outp, ck, terms=["plan description"], batch_files=2)
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [2, 2, 1]
    res = sj.read_routed(spark, outp)
    assert res.count() == 5
    assert {r.status for r in res.collect()} == {"processed", "plan_not_found"}
    q2 = sj.stream_documents(spark, root, outp, ck, terms=["plan description"], batch_files=2)
    assert sum(p["numInputRows"] for p in q2.recentProgress) == 0
    assert sj.read_routed(spark, outp).count() == 5


def test_stream_ledger_equals_batch(spark, tmp_dir):
    from docflow.operators import ledger as lg

    led = B.ledger(spark, SF)
    src = os.path.join(tmp_dir, "led")
    led.repartition(3, "seq").write.parquet(src)
    outp = os.path.join(tmp_dir, "cur")
    sj.stream_ledger(spark, src, outp, os.path.join(tmp_dir, "ck2"), batch_files=1)  # three batches
    got = {(r.ack_id, r.year, r.status) for r in sj.read_current(spark, outp).collect()}
    want = {(r.ack_id, r.year, r.status) for r in lg.latest_status(led).collect()}
    assert got == want


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 20 and "processed" in df.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 80


def test_replayed_batch_does_not_duplicate(spark, tmp_dir):
    root = _docs(spark, os.path.join(tmp_dir, "docs"), 4)
    batch = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    outp = os.path.join(tmp_dir, "out")
    sj.process_batch(batch, 0, outp, ["plan description"], 4, 100)
    sj.process_batch(batch, 1, outp, ["plan description"], 4, 100)
    sj.process_batch(batch, 1, outp, ["plan description"], 4, 100)  # batch 1 retried
    res = sj.read_routed(spark, outp)
    assert res.count() == 8
    assert sorted(r.batch_id for r in res.select("batch_id").distinct().collect()) == [0, 1]


def test_backlog_needs_few_batches(spark, tmp_dir):
    """A backlog of 30 times the old batch (20 documents a core) is one micro-batch, whose files take few tasks."""
    cores = spark.sparkContext.defaultParallelism
    n = min(600, 600 * cores)
    pages = spark.range(n).select(F.col("id").cast("string").alias("ack_id"), F.lit(2001).alias("year"),
                                  F.array(F.lit("the plan description")).alias("pages"))
    root = dc.write_document_files(pages, f"{tmp_dir}/docs")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    q = sj.stream_documents(spark, root, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", terms=["plan description"])
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 1
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    routed = sj.read_routed(spark, f"{tmp_dir}/out")
    assert routed.count() == n and len(routed.inputFiles()) <= 4 * cores


def test_documents_in_batches_leave_few_files_in_the_log(spark, tmp_dir):
    """The source's log, which the driver holds, has an entry for a batch, not one for each document."""
    root = _docs(spark, os.path.join(tmp_dir, "docs"), 30)
    ck = os.path.join(tmp_dir, "ck")
    q = sj.stream_documents(spark, root, os.path.join(tmp_dir, "out"), ck, terms=["plan description"], batch_files=10)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [10, 10, 10]
    log = os.path.join(ck, "sources", "0")
    assert sum(len(open(os.path.join(log, f)).read().splitlines()) - 1 for f in os.listdir(log) if not f.startswith(".")) == 3
    assert sj.read_routed(spark, os.path.join(tmp_dir, "out")).select("ack_id").distinct().count() == 30


def test_an_outcome_of_a_batch_is_one_file(spark, tmp_dir):
    """Readers of the output list its files on the driver: a small batch leaves one for each outcome, however many tasks it had."""
    root = _docs(spark, os.path.join(tmp_dir, "docs"), 60)
    out = os.path.join(tmp_dir, "out")
    sj.stream_documents(spark, root, out, os.path.join(tmp_dir, "ck"), terms=["plan description"], batch_files=30)
    routed = sj.read_routed(spark, out)
    assert routed.count() == 60
    assert len(routed.inputFiles()) == routed.select("status", "batch_id").distinct().count()
