"""Registered queries for document files and token trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import ledger as lg
from docflow.operators import pages as pg
from docflow.plans import bindings as B
from docflow.plans.registry import LATEST_SQL, LEDGER_SQL, PAGES_SQL, register
from docflow.session import scratch_path
from docflow.sources import documents as dc
from docflow.sources import tokens as tk


def _doc_files(spark, d):
    ps = B.pagesets(spark, d).select(F.col("doc_id").cast("string").alias("ack_id"), "year", "pages")
    return dc.write_document_files(ps, scratch_path(spark, "documents"))


@register(
    "scan_documents",
    "select cast(doc_id as varchar) as ack_id, 1999 + cast(substring(source, 4) as int) as year, "
    "cast(strlen(text) + 1 as bigint) as length from documents",
)
def scan_documents(spark, d):
    """One text-layer file per document, read with the binaryFile source; the length is that of
    the bytes read."""
    docs = dc.scan_documents(spark, _doc_files(spark, d))
    return docs.select("ack_id", "year", F.length("content").cast("long").alias("length"))


@register(
    "extract_pages",
    f"select cast(doc_id as varchar) as ack_id, page_no, text from ({PAGES_SQL})",
)
def extract_pages(spark, d):
    """Pluggable extraction (a Python codec in mapInPandas) of every document file."""
    docs = dc.scan_documents(spark, _doc_files(spark, d))
    ps = dc.extract_pages(docs, dc.form_feed_pages, 1)
    return pg.explode_pages(ps.select("ack_id", "pages")).select("ack_id", F.col("page_no").cast("int"), "text")


_BODY_SQL = f"""
with m as (select * from ({LEDGER_SQL}) where message is not null and message <> ''),
o as (select ack_id, year, max((ts, seq)) filter (where overwrite_) as ow from m group by 1, 2),
b as (select m.ack_id, m.year, string_agg(m.message, chr(10) order by m.ts, m.seq) || chr(10) as body
      from m join o using (ack_id, year) where o.ow is null or (m.ts, m.seq) >= o.ow group by 1, 2),
cur as (select l.ack_id, l.year, l.status, b.body from ({LATEST_SQL}) l left join b using (ack_id, year))
"""


def _token_tree(spark, d):
    led = B.ledger(spark, d)
    cur = lg.latest_status(led).join(lg.message_fold(led), ["ack_id", "year"], "left")
    root = scratch_path(spark, "tracker")
    tk.write_token_tree(cur, root)
    return root


@register(
    "scan_status_tree",
    f"{_BODY_SQL} select ack_id, year, status, cast(coalesce(strlen(body), 0) as bigint) as size from cur",
)
def scan_status_tree(spark, d):
    """The ledger's current state as a token tree (bodies = message folds), listed back."""
    root = _token_tree(spark, d)
    return tk.status_records(tk.scan_status_tree(spark, root)).select("ack_id", "year", "status", "size")


@register(
    "read_payload",
    f"{_BODY_SQL} select ack_id, year, status, coalesce(body, '') as ocr_text from cur where status = 'processed'",
)
def read_payload(spark, d):
    """Bodies of processed tokens read back from the tree."""
    root = _token_tree(spark, d)
    recs = tk.status_records(tk.scan_status_tree(spark, root))
    return tk.read_payload(spark, recs, root).where(F.col("status") == "processed").select(
        "ack_id", "year", "status", "ocr_text")
