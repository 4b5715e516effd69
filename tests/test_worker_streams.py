"""The worker loop as a stream against the batch job; streamed token bodies against the batch fold."""

import datetime as dt
import os

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators import ledger as lg
from docflow.plans import jobs
from docflow.sources import documents as dc
from docflow.streaming import compaction as cp
from docflow.streaming import jobs as sj
from docflow.streaming import worker as wk

T0 = dt.datetime(2025, 1, 1)
LEDGER = "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"
TERMS = ["plan description"]


def _docs(spark, root, pages):
    return dc.write_document_files(spark.createDataFrame(
        [(k, 2001, v) for k, v in pages.items()], "ack_id string, year int, pages array<string>"), root)


def _rows(spark, out):
    cols = ["ack_id", "year", "status", "page_no", "n_pages", "text"]
    return sorted(map(tuple, spark.read.parquet(out).select(*cols).collect()), key=str)


def test_stream_equals_batch_and_a_replay_adds_nothing(spark, tmp_dir):
    p = {n: os.path.join(tmp_dir, n) for n in ("docs", "l1", "l2", "o1", "o2", "ckpt")}
    first = {"a": ["cover", "the Plan Description"], "b": ["nothing"], "early": ["plan description the"]}
    second = {"c": ["x"] * 5, "d": ["plan description"]}
    todo = spark.createDataFrame([(k, 2001, C.TO_PROCESS, T0, 0, None, False) for k in ("a", "b", "c", "d", "no file")], LEDGER)
    for ledger in (p["l1"], p["l2"]):
        jobs.append_transitions(todo, ledger, "seed")
    opts = {"terms": TERMS, "limit_pages": 4, "ts": T0 + dt.timedelta(hours=1)}
    for part in (first, second):  # "early" has a file, but the ledger does not know it
        _docs(spark, p["docs"], part)
        wk.stream_process(spark, p["docs"], p["l1"], p["o1"], p["ckpt"], "w", batch_files=2, **opts)
    jobs.process_job(spark, p["docs"], p["l2"], p["o2"], run="b", **opts)
    batch = [r for r in _rows(spark, p["o2"]) if r[2] is not None]
    assert _rows(spark, p["o1"]) == batch and len(batch) == 4

    def state(path):
        return sorted(map(tuple, jobs.read_ledger(spark, path).collect()), key=str)

    assert state(p["l1"]) == state(p["l2"])
    runs = {r.run for r in jobs.read_runs(spark, p["l1"]).select("run").distinct().collect()} - {"seed"}
    assert len(runs) > 1
    before = state(p["l1"])
    run = jobs.read_runs(spark, p["l1"]).where("ack_id = 'a' AND run <> 'seed'").first()["run"]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p["docs"]).select("path")
    again = files.where(F.col("path").rlike("/a[.]txt$"))
    others = jobs.read_runs(spark, p["l1"]).where(F.col("run") == run).count()
    if others == 1:  # the batch of document a held no other: repeat exactly it
        wk.process_files(again, run, p["l1"], p["o1"], **opts)
    wk.process_files(files, "w-99", p["l1"], p["o1"], **opts)  # all files again, as another batch
    assert state(p["l1"]) == before and _rows(spark, p["o1"]) == batch


def test_streamed_bodies(spark, tmp_dir):
    src, log, ckpt, snaps = (os.path.join(tmp_dir, n) for n in ("in", "log", "ckpt", "snaps"))

    def arrive(rows):
        df = spark.createDataFrame([(k, 2001, "s", T0 + dt.timedelta(hours=h), s, m, o) for k, h, s, m, o in rows], LEDGER)
        df.coalesce(1).write.mode("append").parquet(src)
        wk.stream_messages(spark, src, log, ckpt, batch_files=1)

    def bodies(s=snaps):
        return {r.ack_id: r.body for r in wk.read_bodies(spark, log, s).collect()}

    def batch():
        return {r.ack_id: r.body for r in lg.message_fold(spark.read.schema(LEDGER).parquet(src)).collect()}

    assert wk.compact_messages(spark, log, snaps) is None and bodies() == {}
    arrive([("a", 3, 0, "third", False), ("b", 1, 0, "old", False), (None, 1, 0, "no id", False), ("c", 1, 0, "", True)])
    assert bodies() == batch() == {"a": "third\n", "b": "old\n"}
    arrive([("a", 1, 0, "first", False), ("a", 2, 0, "second", True), ("b", 2, 0, None, True)])  # out of order
    assert wk.compact_messages(spark, log, snaps) == 1 and wk.compact_messages(spark, log, snaps) is None
    assert wk.read_messages(spark, log, snaps).count() == 3  # "first" is gone
    assert bodies() == batch() == {"a": "second\nthird\n", "b": "old\n"}
    arrive([("a", 1, 5, "late, before the overwrite", False), ("b", 0, 0, "before", False)])
    assert bodies() == batch() == {"a": "second\nthird\n", "b": "before\nold\n"}
    # a compaction that failed before its marker is not read, and is written over
    spark.createDataFrame([], wk.MESSAGE_ROWS).write.parquet(f"{snaps}/snapshot=2/rows")
    assert bodies() == batch()
    assert wk.compact_messages(spark, log, snaps) == 2 and bodies() == batch()
    arrive([("b", 9, 0, "new", True)])
    assert wk.compact_messages(spark, log, snaps) == 3
    assert cp.vacuum(spark, log, snaps) > 0
    assert bodies() == batch() == {"a": "second\nthird\n", "b": "new\n"}


def _log(ckpt):
    """Entries of the log of files that the stream's source keeps in the driver's memory."""
    at = os.path.join(ckpt, "sources", "0")
    return [x for f in os.listdir(at) if not f.startswith(".") for x in open(os.path.join(at, f)).read().splitlines()[1:]]


def test_the_source_holds_few_files(spark, tmp_dir):
    """A backlog of documents is a few files of paths to the source, in one micro-batch or in many; files that come later are
    added, and none is taken twice."""
    n, cores = 400, spark.sparkContext.defaultParallelism
    p = {k: os.path.join(tmp_dir, k) for k in ("docs", "ledger", "out", "ckpt", "o2", "c2")}
    _docs(spark, p["docs"], {str(i): ["the plan description"] for i in range(n)})
    open(os.path.join(p["docs"], "2001", "empty.txt"), "w").close()
    todo = spark.range(n + 1).select(F.col("id").cast("string").alias("ack_id"), F.lit(2001).alias("year"), F.lit(C.TO_PROCESS).alias("status"),
                                     F.lit(T0).cast("timestamp").alias("ts"), F.lit(0).cast("long").alias("seq"),
                                     F.lit(None).cast("string").alias("message"), F.lit(False).alias("overwrite_"))
    jobs.append_transitions(todo, p["ledger"], "seed")
    opts = {"terms": TERMS, "ts": T0 + dt.timedelta(hours=1)}
    q = wk.stream_process(spark, p["docs"], p["ledger"], p["out"], p["ckpt"], "w", **opts)
    assert len({b["batchId"] for b in q.recentProgress if b["numInputRows"]}) == 1
    assert 0 < len(_log(p["ckpt"])) <= 4 * cores and spark.read.parquet(p["out"]).count() == n
    _docs(spark, p["docs"], {str(n): ["the plan description"]})
    wk.stream_process(spark, p["docs"], p["ledger"], p["out"], p["ckpt"], "w", **opts)
    assert spark.read.parquet(p["out"]).count() == n + 1
    assert lg.latest_status(jobs.read_ledger(spark, p["ledger"])).where("status = 'processed'").count() == n + 1
    wk.stream_process(spark, p["docs"], p["ledger"], p["out"], p["ckpt"], "w", **opts)
    assert spark.read.parquet(p["out"]).count() == n + 1
    wk.stream_process(spark, p["docs"], p["ledger"], p["o2"], p["c2"], "v", batch_files=100, **opts)
    assert len(_log(p["c2"])) == 5  # 401 paths


def test_an_earlier_checkpoint_goes_on(spark, tmp_dir):
    """A checkpoint whose source read the document files themselves: what it has done is not done again."""
    root, ckpt = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "ckpt")
    _docs(spark, root, {"a b+c": ["x"], "d": ["x"]})
    old = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
           .option("recursiveFileLookup", "true").load(root).select("path").writeStream.foreachBatch(lambda b, i: b.count())
           .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    old.awaitTermination()
    _docs(spark, root, {"e": ["x"], "f g": ["x"]})
    out = os.path.join(tmp_dir, "out")
    for _ in range(2):
        sj.stream_documents(spark, root, out, ckpt, terms=TERMS)
        assert sorted(r.ack_id for r in spark.read.parquet(out).collect()) == ["e", "f g"]


def test_batches_are_oldest_first(spark, tmp_dir):
    root, out = os.path.join(tmp_dir, "docs"), os.path.join(tmp_dir, "out")
    names = ["c", "a", "e", "b", "d"]
    _docs(spark, root, {k: ["x"] for k in names})
    for at, k in enumerate(names):
        os.utime(os.path.join(root, "2001", f"{k}.txt"), (10_000 + at, 10_000 + at))
    sj.stream_documents(spark, root, out, os.path.join(tmp_dir, "ckpt"), terms=TERMS, batch_files=2)
    got = {r.ack_id: r.batch_id for r in spark.read.parquet(out).collect()}
    assert got == {"c": 0, "a": 0, "e": 1, "b": 1, "d": 2}
