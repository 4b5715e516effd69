"""Registered queries for the full cascade route, staged extraction over document files, and
documents missing from the file store (A7 + A10 + P22, S6 + S7 staged, D11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import pages as pg
from docflow.plans import bindings as B
from docflow.plans.pages_queries import _PT_SQL, HIT, LIMIT, T
from docflow.plans.registry import INDEX_SQL, PAGES_SQL, register, sql_trim
from docflow.session import scratch_path
from docflow.sources import documents as dc

_TEXTS = """
t1 as (select c.doc_id, string_agg(p.text, chr(12) order by p.page_no) as t
       from cas c join pt p on p.doc_id = c.doc_id and p.extractor = 1
        and p.page_no between c.page_no and c.page_no + 3 where c.page_no >= 0 group by 1),
t3 as (select c.doc_id, string_agg(p.text, chr(10) order by p.page_no) as t
       from cas c join pt p on p.doc_id = c.doc_id and p.extractor = 3
        and p.page_no between c.page_no and c.page_no + 3 where c.page_no >= 0 group by 1),
txt as (select t1.doc_id, case when contains(lower(t1.t), 'the') then t1.t else t3.t end as text
        from t1 join t3 on t1.doc_id = t3.doc_id),
np as (select doc_id, cast(count(*) as integer) as n_pages from pt where extractor = 1 group by 1)
"""


@register(
    "process_cascade",
    f"""with {_PT_SQL}, {_TEXTS}
    select c.doc_id, c.extractor, c.page_no, np.n_pages,
           case when np.n_pages = 0 then 'corrupted_file' when np.n_pages > {LIMIT} then 'file_too_long'
                when c.page_no < 0 then 'plan_not_found'
                when not coalesce(contains(lower({sql_trim('x.text')}), 'the'), false) then 'text_extraction_empty'
                else 'processed' end as status
    from cas c join np on np.doc_id = c.doc_id left join txt x on x.doc_id = c.doc_id""",
)
def process_cascade(spark, d):
    """A7 + A10 + P22: every document through the three-extractor cascade, text-layer-or-OCR
    text of the window, and its outcome."""
    w = B.page_texts_wide(spark, d)
    r = pg.route_cascade(w, terms=T, limit_pages=LIMIT)
    return r.select("doc_id", "extractor", "page_no", "n_pages", "status")


# Three pluggable codecs over the same text-layer files, in cascade order:
#   1 a text layer that cannot map non-ASCII glyphs (such pages come out blank),
#   2 a second reader that cannot read pages over 200 characters (tolerant: no match),
#   3 OCR, which reads everything.
def _text_layer(b: bytes):
    return ["" if any(ord(ch) > 127 for ch in p) else p for p in dc.form_feed_pages(b)]


def _second_reader(b: bytes):
    return [None if len(p) > 200 else p for p in dc.form_feed_pages(b)]


def _ocr(b: bytes):
    return dc.form_feed_pages(b)


_STAGED_SQL = f"""
with p as ({PAGES_SQL}),
pt as (select doc_id, 1 as extractor, page_no,
              case when regexp_matches(text, '[^\\x00-\\x7F]') then '' else text end as text from p
       union all select doc_id, 2, page_no, case when length(text) > 200 then null else text end from p
       union all select doc_id, 3, page_no, text from p),
fh as (select doc_id, extractor, min(page_no) filter (where coalesce({HIT}, false)) as hp from pt group by 1, 2),
cas as (select doc_id, min(extractor) filter (where hp is not null) as extractor,
               coalesce(arg_min(hp, extractor) filter (where hp is not null), -1) as page_no
        from fh group by 1)
select cast(doc_id as varchar) as ack_id, extractor, page_no from cas
"""


def _doc_files(spark, d, stored=None):
    """Write one document file per page set; ``stored`` (a table of doc_id) limits the archive
    to those documents (semi join)."""
    ps = B.pagesets(spark, d)
    if stored is not None:
        ps = ps.join(stored, "doc_id", "left_semi")
    ps = ps.select(F.col("doc_id").cast("string").alias("ack_id"), "year", "pages")
    return dc.write_document_files(ps, scratch_path(spark, "documents"))


@register("staged_cascade", _STAGED_SQL)
def staged_cascade(spark, d):
    """S6 + S7 + A7 staged: document files read with binaryFile, extractor k run (mapInPandas)
    only on documents no earlier extractor decided, content carried along (no join), then the
    cascade decision."""
    docs = dc.scan_documents(spark, _doc_files(spark, d), with_content=False)  # stages read files by path
    wide = dc.run_cascade(docs, [(1, _text_layer, False), (2, _second_reader, True), (3, _ocr, False)], T)
    c = pg.with_cascade(wide, ["pages_1", "pages_2", "pages_3"], T, tolerant=["pages_2"])
    return c.select("ack_id", "extractor", "page_no")


@register(
    "missing_documents",
    f"""select ack_id, filing_year as year from ({INDEX_SQL})
        where ack_id not in (select cast(doc_id as varchar) from labels)""",
)
def missing_documents(spark, d):
    """Documents of the universe without a file (here the archive holds files only for the
    labelled documents) come out as a side table instead of stopping the job."""
    root = _doc_files(spark, d, stored=B.table(spark, d, "labels").select("doc_id"))
    found = dc.scan_documents(spark, root, with_content=False)
    expected = B.index(spark, d).select("ack_id", F.col("filing_year").alias("year"))
    return dc.missing_documents(expected, found)
