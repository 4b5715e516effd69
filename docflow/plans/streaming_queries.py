"""Registered queries for the streaming jobs (T1, T2, T3): run the stream to completion on
files derived from the tables, read the sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.plans import bindings as B
from docflow.plans import jobs
from docflow.plans import ledger_queries  # noqa: F401 - its twin of message_fold is used below
from docflow.operators import ledger as lg
from docflow.plans.pages_queries import _DOCS_SQL
from docflow.plans.registry import LATEST_SQL, ORACLE, register
from docflow.plans.source_queries import _doc_files
from docflow.session import scratch_path
from docflow.streaming import compaction as cp
from docflow.streaming import jobs as sj
from docflow.streaming import worker as wk


def _routed_stream(spark, d):
    out = scratch_path(spark, "routed")
    sj.stream_documents(spark, _doc_files(spark, d), out, scratch_path(spark, "routed_ckpt"),
                        terms=B.FIXTURE_TERMS, limit_pages=B.FIXTURE_PAGE_LIMIT)
    return sj.read_routed(spark, out)


@register(
    "stream_documents",
    f"with {_DOCS_SQL} select cast(doc_id as varchar) as ack_id, year, status, page_no, n_pages from classified",
)
def stream_documents(spark, d):
    """Documents drained from a folder in bounded micro-batches, each routed once."""
    return _routed_stream(spark, d).select("ack_id", "year", "status", "page_no", "n_pages")


@register(
    "stream_route",
    f"with {_DOCS_SQL} select status, count(*) as n from classified group by status",
)
def stream_route(spark, d):
    """Outputs land in one folder per outcome; counted per folder."""
    return _routed_stream(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@register("stream_ledger", f"select ack_id, year, status from ({LATEST_SQL})")
def stream_ledger(spark, d):
    """The ledger arrives as several transition files; the current status is maintained
    incrementally and equals the batch result."""
    src = scratch_path(spark, "ledger_stream_in")
    B.ledger(spark, d).repartition(4, "seq").write.parquet(src)
    out = scratch_path(spark, "ledger_current")
    sj.stream_ledger(spark, src, out, scratch_path(spark, "ledger_ckpt"), batch_files=1)
    return sj.read_current(spark, out)


def _compacted(spark, d):
    """The ledger streamed in two runs, compacted after the first."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("ledger_in", "ledger_log", "ledger_log_ckpt"))
    snapshots = scratch_path(spark, "ledger_snapshots")
    rows = B.ledger(spark, d)
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == part).repartition(2, "seq").write.mode("append").parquet(src)
        sj.stream_ledger(spark, src, out, ckpt, batch_files=1)
        if part == 0:
            cp.compact(spark, out, snapshots)
    return out, snapshots


@register("compact_ledger", f"select ack_id, year, status, ts, seq from ({LATEST_SQL})")
def compact_ledger(spark, d):
    """Snapshot of the first run merged with the batches of the second equals the batch result."""
    return cp.read_current(spark, *_compacted(spark, d)).select("ack_id", "year", "status", "ts", "seq")


@register(
    "new_ledger_ids",
    f"""select cast(doc_id as varchar) as ack_id, cast(1999 + doc_id % 20 as integer) as year from documents
    where cast(doc_id as varchar) not in (select ack_id from ({LATEST_SQL}))""",
)
def new_ledger_ids(spark, d):
    """K6: documents that the compacted ledger does not hold, by its stored key filter."""
    ids = B.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("ack_id"), (1999 + F.col("doc_id") % 20).cast("int").alias("year"))
    return cp.new_ids(spark, ids, *_compacted(spark, d))


@register(
    "stream_process",
    f"with {_DOCS_SQL} select cast(doc_id as varchar) as ack_id, year, status from classified",
)
def stream_process(spark, d):
    """Documents in ``to_process`` drained from a folder in micro-batches that write their
    transitions; the current ledger is the result."""
    ledger = scratch_path(spark, "worker_ledger")
    start = F.lit("2025-01-01").cast("timestamp")
    todo = B.pagesets(spark, d).select(
        F.col("doc_id").cast("string").alias("ack_id"), "year", F.lit(C.TO_PROCESS).alias("status"), start.alias("ts"),
        F.lit(0).cast("long").alias("seq"), F.lit(None).cast("string").alias("message"), F.lit(False).alias("overwrite_"))
    jobs.append_transitions(todo, ledger, "seed")
    wk.stream_process(spark, _doc_files(spark, d), ledger, scratch_path(spark, "worker_out"), scratch_path(spark, "worker_ckpt"),
                      "worker", terms=B.FIXTURE_TERMS, limit_pages=B.FIXTURE_PAGE_LIMIT)
    return lg.latest_status(jobs.read_ledger(spark, ledger)).select("ack_id", "year", "status")


@register("stream_bodies", ORACLE["message_fold"])
def stream_bodies(spark, d):
    """Messages streamed in two runs out of order, compacted after the first; the bodies equal
    the batch fold."""
    src, out, ckpt, snapshots = (scratch_path(spark, n) for n in ("said_in", "said_log", "said_ckpt", "said_snapshots"))
    rows = B.ledger(spark, d)
    for part in (0, 1):
        rows.where(F.pmod(F.xxhash64("seq"), F.lit(2)) == part).repartition(2, "seq").write.mode("append").parquet(src)
        wk.stream_messages(spark, src, out, ckpt, batch_files=1)
        if part == 0:
            wk.compact_messages(spark, out, snapshots)
    return wk.read_bodies(spark, out, snapshots)
