"""Registered queries for records, texts and corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators import ledger as lg
from docflow.operators import outputs as out
from docflow.operators import pages as pg
from docflow.plans import bindings as B
from docflow.plans.ledger_queries import SEED_TS
from docflow.plans.pages_queries import _DOCS_SQL
from docflow.plans.registry import INDEX_SQL, LEDGER_SQL, register
from docflow.session import scratch_path
from docflow.sources import tables as tb

_REPAIR = "regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')"
# processed documents with the repaired text (the twin of outputs.year_texts)
_TEXTS_SQL = f"""with {_DOCS_SQL},
texts as (select cast(doc_id as varchar) as ack_id, year, status, {_REPAIR} as ocr_text
          from classified where status = 'processed' and text is not null),
train as (select distinct cast(doc_id as varchar) as ack_id from labels where quality = 1)
"""


def _routed(spark, d):
    r = pg.route_documents(B.pagesets(spark, d), terms=B.FIXTURE_TERMS, limit_pages=B.FIXTURE_PAGE_LIMIT)
    return r.withColumn("ack_id", F.col("doc_id").cast("string"))


def _texts(spark, d):
    return out.year_texts(_routed(spark, d))


@register(
    "non_null_text",
    f"with {_DOCS_SQL} select cast(doc_id as varchar) as ack_id, year, text as ocr_text from classified "
    "where status = 'processed' and text is not null",
)
def non_null_text(spark, d):
    return out.year_texts(_routed(spark, d), repair=False).select("ack_id", "year", "ocr_text")


@register("project_corpus", f"{_TEXTS_SQL} select ack_id, year, ocr_text from texts")
def project_corpus(spark, d):
    return out.project_corpus(_texts(spark, d))


@register("semi_train", f"{_TEXTS_SQL} select ack_id, year, ocr_text from texts where ack_id in (select ack_id from train)")
def semi_train(spark, d):
    return out.semi_train(out.project_corpus(_texts(spark, d)), B.train_ids(spark, d))


@register("anti_oos", f"{_TEXTS_SQL} select ack_id, year, ocr_text from texts where ack_id not in (select ack_id from train)")
def anti_oos(spark, d):
    return out.anti_oos(out.project_corpus(_texts(spark, d)), B.train_ids(spark, d))


@register(
    "merge_text",
    f"{_TEXTS_SQL} select u.*, t.ocr_text from ({INDEX_SQL}) u left join texts t on u.ack_id = t.ack_id",
)
def merge_text(spark, d):
    return out.merge_text(B.index(spark, d), _texts(spark, d))


@register(
    "stable_shuffle",
    f"{_TEXTS_SQL} select ack_id, year, ocr_text, md5(ack_id || ':42') as shuffle_key, "
    "row_number() over (order by md5(ack_id || ':42'), ack_id) as shuffle_rank from texts",
)
def stable_shuffle(spark, d):
    """L1: the permutation by its ranks, so that rows without an order can be compared."""
    return out.shuffle_rank(out.project_corpus(_texts(spark, d)))


_RECORDS_SQL = f"""with {_DOCS_SQL} select cast(doc_id as varchar) as ack_id, year, status,
    concat_ws('/', 'tracker', status, cast(year as varchar), cast(doc_id as varchar) || '.txt') as path from classified"""


@register("sample_k", f"select ack_id, year, status, path, md5(path || ':42') as shuffle_key from ({_RECORDS_SQL}) "
                      f"order by shuffle_key, path limit {C.SAMPLE_K}")
def sample_k(spark, d):
    return out.sample_k(out.records(_routed(spark, d)))


@register(
    "preview_first",
    f"""select ack_id, year, status, path from (
          select ack_id, year, status, concat_ws('/', 'to_download', cast(year as varchar), ack_id || '.txt') as path
          from (select distinct ack_id, filing_year as year, 'to_download' as status from ({INDEX_SQL}) u
                where not exists (select 1 from ({LEDGER_SQL}) l where l.ack_id = u.ack_id and l.year = u.filing_year)))
        order by path limit {C.PREVIEW_TOKENS}""",
)
def preview_first(spark, d):
    seeds = lg.seed_ledger(B.index(spark, d), B.ledger(spark, d), ts=SEED_TS)
    tokens = seeds.select("ack_id", "year", "status", F.concat_ws(
        "/", F.lit("to_download"), F.col("year").cast("string"), F.concat(F.col("ack_id"), F.lit(".txt"))).alias("path"))
    return out.preview_first(tokens)


@register("write_records", f"select * from ({_RECORDS_SQL})")
def write_records(spark, d):
    """K3: records partitioned by year, read back."""
    path = tb.write_records(out.records(_routed(spark, d)), scratch_path(spark, "records"))
    return spark.read.parquet(path).select("ack_id", "year", "status", "path")


@register("write_year_text", f"{_TEXTS_SQL} select * from texts")
def write_year_text(spark, d):
    """K4: per-year text tables, read back."""
    path = tb.write_year_text(_texts(spark, d), scratch_path(spark, "year_text"))
    return spark.read.parquet(path).select("ack_id", "year", "status", "ocr_text")


@register("scan_year_results", f"{_TEXTS_SQL} select ack_id, year, ocr_text from texts")
def scan_year_results(spark, d):
    """Per-year results written as CSV (texts with newlines and quotes), read back with
    a file-name filter and three projected columns."""
    path = tb.write_year_text(_texts(spark, d), scratch_path(spark, "year_text_csv"), fmt="csv")
    return tb.scan_year_results(spark, path, fmt="csv", glob="*.csv")


@register(
    "write_corpora",
    f"""{_TEXTS_SQL} select 'train' as corpus, ack_id, year, ocr_text from texts where ack_id in (select ack_id from train)
        union all select 'full' as corpus, ack_id, year, ocr_text from texts""",
)
def write_corpora(spark, d):
    """K5: train and full corpora written, read back."""
    texts = spark.read.parquet(tb.write_year_text(_texts(spark, d), scratch_path(spark, "year_text")))
    train, full = out.build_corpora(texts, B.train_ids(spark, d))
    paths = tb.write_corpora(train, full, scratch_path(spark, "train"), scratch_path(spark, "full"))
    parts = [spark.read.parquet(p).select(F.lit(name).alias("corpus"), "ack_id", "year", "ocr_text")
             for name, p in paths.items() if p]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res
