"""Registered queries for page selection and routing (P15-P18, P22, A5 flagship, A6-A10, J5, J7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions import text as tx
from docflow.operators import ledger as lg
from docflow.operators import pages as pg
from docflow.operators.rows import filter_computed
from docflow.plans import bindings as B
from docflow.plans.registry import PAGES_SQL, register, sql_terms_hit, sql_trim, waterfall_select

T = B.FIXTURE_TERMS
LIMIT = B.FIXTURE_PAGE_LIMIT
HIT = sql_terms_hit("text", T)

_DOCS_SQL = f"""
hits as (select *, {HIT} as hit from ({PAGES_SQL})),
docs as (select doc_id, year, cast(count(*) as integer) as n_pages,
                coalesce(min(page_no) filter (where hit), -1) as page_no
         from hits group by 1, 2),
win as (select d.doc_id, d.year, d.n_pages, d.page_no,
               string_agg(h.text, chr(10) order by h.page_no) as raw
        from docs d left join hits h
          on h.doc_id = d.doc_id and d.page_no >= 0 and h.page_no between d.page_no and d.page_no + 3
        group by 1, 2, 3, 4),
routed as (select doc_id, year, n_pages, page_no,
                  case when d_ok then {sql_trim('raw')} end as text
           from (select *, n_pages <= {LIMIT} and page_no >= 0 as d_ok from win)),
classified as (select *, case when n_pages = 0 then 'corrupted_file'
                             when n_pages > {LIMIT} then 'file_too_long'
                             when page_no < 0 then 'plan_not_found'
                             when not coalesce(contains(lower(text), 'the'), false) then 'text_extraction_empty'
                             else 'processed' end as status
               from routed)
"""


def routed(spark, d):
    return pg.route_documents(B.pagesets(spark, d), terms=T, limit_pages=LIMIT)


@register("process_waterfall", f"with {_DOCS_SQL} select year, {waterfall_select(C.STATUSES)} from classified group by year")
def process_waterfall(spark, d):
    """Flagship: route every document, then count documents per year and outcome."""
    return lg.status_waterfall(routed(spark, d))


@register("classify_outcome", f"with {_DOCS_SQL} select doc_id, status, page_no, n_pages from classified")
def classify_outcome(spark, d):
    return routed(spark, d).select("doc_id", "status", "page_no", "n_pages")


@register("find_terms", f"select doc_id, page_no, {HIT} as hit from ({PAGES_SQL})")
def find_terms(spark, d):
    p = B.pagesets(spark, d).select("doc_id", F.posexplode(pg.page_hits("pages", T)).alias("page_no", "hit"))
    return p


@register("first_hit_page", f"with {_DOCS_SQL} select doc_id, page_no from docs")
def first_hit_page(spark, d):
    return B.pagesets(spark, d).select("doc_id", pg.first_hit_page("pages", T).alias("page_no"))


@register("page_count", f"select doc_id, cast(count(*) as integer) as n_pages from ({PAGES_SQL}) group by 1")
def page_count(spark, d):
    return B.pagesets(spark, d).select("doc_id", pg.page_count("pages").alias("n_pages"))


@register("is_too_long", f"select doc_id, count(*) > {LIMIT} as too_long from ({PAGES_SQL}) group by 1")
def is_too_long(spark, d):
    return B.pagesets(spark, d).select("doc_id", pg.is_too_long("pages", LIMIT).alias("too_long"))


@register("is_corrupted", "select doc_id, text is null or doc_id % 9 in (0, 1) as corrupted from documents")
def is_corrupted(spark, d):
    """Some documents could not be opened (an error), some have no page at all."""
    k = F.col("doc_id") % 9
    opened = B.pagesets(spark, d).withColumns({
        "pages": F.when(k != 1, F.col("pages")).otherwise(F.array().cast("array<string>")),
        "error": F.when(k == 0, F.lit("cannot be opened"))})
    return opened.select("doc_id", pg.is_corrupted("pages", "error").alias("corrupted"))


@register(
    "page_window",
    f"""with {_DOCS_SQL}
    select h.doc_id, h.page_no, h.text from hits h join docs d on h.doc_id = d.doc_id
    where d.page_no >= 0 and h.page_no between d.page_no and d.page_no + 3""",
)
def page_window(spark, d):
    ps = B.pagesets(spark, d).withColumn("start", pg.first_hit_page("pages", T))
    w = ps.select("doc_id", "start", pg.page_window("pages", "start").alias("w"))
    # outer + filter: a plain posexplode of a column gets an inferred size(w) > 0 pushed below
    # the projection, which would run the page scan a second time
    rows = w.select("doc_id", "start", F.posexplode_outer("w").alias("i", "text")).where(F.col("i").isNotNull())
    return rows.select("doc_id", (F.col("start") + F.col("i")).cast("int").alias("page_no"), "text")


@register("join_page_texts", f"with {_DOCS_SQL} select doc_id, raw as text from win where page_no >= 0")
def join_page_texts(spark, d):
    ps = filter_computed(B.pagesets(spark, d).withColumn("start", pg.first_hit_page("pages", T)), "start",
                         lambda s: s >= 0)
    return ps.select("doc_id", pg.join_pages(pg.page_window("pages", "start"), "\n").alias("text"))


@register("has_text", "select doc_id, contains(lower(text), 'the') as has_text from documents")
def has_text(spark, d):
    return B.table(spark, d, "documents").select("doc_id", tx.has_text("text").alias("has_text"))


_PT_SQL = f"""
pt as (select doc_id, e.x as extractor, page_no,
              case when e.x = 1 and doc_id % 3 = 0 then '' when e.x = 2 and doc_id % 6 = 0 then ''
                   else text end as text
       from ({PAGES_SQL}) cross join (values (1), (2), (3)) e(x)),
fh as (select doc_id, extractor, min(page_no) filter (where {HIT}) as hp from pt group by 1, 2),
cas as (select doc_id, min(extractor) filter (where hp is not null) as extractor,
               coalesce(arg_min(hp, extractor) filter (where hp is not null), -1) as page_no
        from fh group by 1)
"""


@register("extractor_cascade", f"with {_PT_SQL} select doc_id, extractor, page_no from cas")
def extractor_cascade(spark, d):
    w = pg.with_cascade(B.page_texts_wide(spark, d), ["pages_1", "pages_2", "pages_3"], T, tolerant=["pages_2"])
    return w.select("doc_id", "extractor", "page_no")


@register(
    "text_or_ocr",
    f"""with {_PT_SQL},
    t1 as (select c.doc_id, string_agg(p.text, chr(12) order by p.page_no) as t
           from cas c join pt p on p.doc_id = c.doc_id and p.extractor = 1
            and p.page_no between c.page_no and c.page_no + 3 where c.page_no >= 0 group by 1),
    t3 as (select c.doc_id, string_agg(p.text, chr(10) order by p.page_no) as t
           from cas c join pt p on p.doc_id = c.doc_id and p.extractor = 3
            and p.page_no between c.page_no and c.page_no + 3 where c.page_no >= 0 group by 1)
    select t1.doc_id, case when contains(lower(t1.t), 'the') then t1.t else t3.t end as text
    from t1 join t3 on t1.doc_id = t3.doc_id""",
)
def text_or_ocr(spark, d):
    w = pg.with_cascade(B.page_texts_wide(spark, d), ["pages_1", "pages_2", "pages_3"], T, tolerant=["pages_2"])
    w = filter_computed(w, "page_no", lambda p: p >= 0)
    return w.select("doc_id", pg.text_or_ocr("pages_1", "pages_3", "page_no").alias("text"))


@register(
    "terms_table_join",
    f"""select doc_id, page_no from ({PAGES_SQL}) p
    where exists (select 1 from (values {", ".join(f"('{t}')" for t in T)}) t(term)
                  where contains(lower(p.text), lower(t.term))
                     or contains(regexp_replace(lower(p.text), '[^a-z0-9() ]', '', 'g'),
                                 regexp_replace(lower(t.term), '[^a-z0-9() ]', '', 'g')))""",
)
def terms_table_join(spark, d):
    rows = pg.explode_pages(B.pagesets(spark, d).select("doc_id", "pages"))
    return pg.terms_table_join(rows, pg.terms_table(spark, T)).select("doc_id", "page_no")


@register(
    "terms_index_join",
    f"""select doc_id, page_no from ({PAGES_SQL}) p
    where exists (select 1 from (select distinct regexp_replace(lower(w[i] || ' ' || w[i + 1]), '[^a-z0-9() ]', '', 'g') as term
                                 from (select w, unnest(range(1, len(w))) as i
                                       from (select string_split(text, ' ') as w from benchmark))) t
                  where contains(regexp_replace(lower(p.text), '[^a-z0-9() ]', '', 'g'), t.term))""",
)
def terms_index_join(spark, d):
    """J7 with thousands of terms: every two neighbouring words of the benchmark items."""
    rows = pg.explode_pages(B.pagesets(spark, d).select("doc_id", "pages"))
    words = B.table(spark, d, "benchmark").select(F.split("text", " ").alias("w")).where(F.size("w") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    return pg.terms_table_join(rows, words.select(F.explode(pairs).alias("term"))).select("doc_id", "page_no")
