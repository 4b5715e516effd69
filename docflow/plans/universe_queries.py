"""Registered queries for the universe build."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions import text as tx
from docflow.operators import universe as uv
from docflow.plans import bindings as B
from docflow.plans.registry import INDEX_SQL, LEDGER_SQL, register, sql_trim
from docflow.session import scratch_path
from docflow.sources import index_files as ix
from docflow.sources import tables as tb

IDX_COLS = ["ack_id", "filing_year", "sponsor_name", "link", "facsimile_link"]
NA_SQL = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in C.NA_TOKENS) + ")"
NA_LIST_SQL = "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in C.NA_TOKENS) + "]"


def _na_trim(x: str) -> str:
    return f"case when {x} is null or {x} in {NA_SQL} then null else {sql_trim(x)} end"


def _index_files(spark, d, long_lines=False):
    """The index binding written as yearly index files (4 files per year)."""
    idx = B.index(spark, d).withColumn("bucket", F.col("ack_id").cast("bigint") % 4)
    path = scratch_path(spark, "index_files")
    ix.write_index_files(idx, path, header=IDX_COLS, long_lines=long_lines)
    return path


_SCANNED_SQL = f"""
select ack_id, filing_year, trim({_na_trim('sponsor_name')}, '"') as sponsor_name,
       {_na_trim('link')} as link, {_na_trim('facsimile_link')} as facsimile_link
from (select ack_id, filing_year, regexp_replace(sponsor_name, '[\\r\\n]', ' ', 'g') as sponsor_name, link,
             facsimile_link from ({INDEX_SQL}))
"""


@register("scan_index", _SCANNED_SQL)
def scan_index(spark, d):
    """Write the index as yearly '|' files with preambles and read them back."""
    return ix.scan_index(spark, _index_files(spark, d)).select(*IDX_COLS)


def _cell_sql(col: str) -> str:
    """A cell as the index files hold it."""
    return f"regexp_replace(regexp_replace(coalesce(cast({col} as varchar), ''), '[\\r\\n]', ' ', 'g'), '([|\\\\])', '\\\\\\1', 'g')"


@register(
    "quarantine_bad_lines",
    "select 'extra|x|x|x|x|x' as line, 6 as n_fields from "
    "(select distinct 1999 + cast(substring(source, 4) as int), doc_id % 4 from documents) "
    f"union all select concat_ws('|', {', '.join(map(_cell_sql, IDX_COLS))}, 'x'), 6 from ({INDEX_SQL})",
)
def quarantine_bad_lines(spark, d):
    """A constant line in every file, and each row once more with a field too many."""
    return ix.quarantine_bad_lines(spark, _index_files(spark, d, long_lines=True)).select("line", "n_fields")


@register(
    "null_tokens",
    f"""select doc_id, case when v in {NA_SQL} then null else v end as value from (
          select doc_id, case when doc_id % 7 = 0 then {NA_LIST_SQL}[cast((doc_id // 7) % {len(C.NA_TOKENS)} as integer) + 1]
                              else text end as v from documents)""",
)
def null_tokens(spark, d):
    """S3: whole texts, in one of seven rows replaced by a token."""
    doc = B.table(spark, d, "documents")
    tokens = F.array(*[F.lit(t) for t in C.NA_TOKENS])
    v = F.when(F.col("doc_id") % 7 == 0,
               F.element_at(tokens, (F.floor(F.col("doc_id") / 7) % len(C.NA_TOKENS) + 1).cast("int"))
               ).otherwise(F.col("text"))
    return doc.select("doc_id", tx.null_tokens(v).alias("value"))


@register("scan_id_list", "select distinct trim(cast(doc_id as varchar)) as ack_id from labels")
def scan_id_list(spark, d):
    """An id list file without a code column: every id is acceptable."""
    return tb.read_id_list(spark, f"{d}/labels.parquet", id_col="doc_id")


@register(
    "filter_codes",
    f"select distinct trim(cast(p_partkey as varchar)) as ack_id from part "
    f"where coalesce(regexp_matches(p_type, '{B.CODE_FIXTURE_PATTERN}'), false)",
)
def filter_codes(spark, d):
    """An id list with a code column: only matching codes."""
    return tb.read_id_list(spark, f"{d}/part.parquet", id_col="p_partkey", code_col="p_type",
                           pattern=B.CODE_FIXTURE_PATTERN)


_DUP_INDEX = f"(select * from ({INDEX_SQL}) union all select * from ({INDEX_SQL}) where cast(ack_id as bigint) % 4 = 0)"
_UNIVERSE_SQL = f"""select distinct ack_id, sponsor_name, link, facsimile_link, filing_year from {_DUP_INDEX} u
    where ack_id in (select cast(doc_id as varchar) from labels)"""


def _dup_index(spark, d):
    idx = B.index(spark, d)
    return idx.unionByName(idx.where(F.col("ack_id").cast("bigint") % 4 == 0))


def _universe(spark, d):
    return uv.build_universe(_dup_index(spark, d), B.ids(spark, d))


@register("semi_universe", f"select * from ({INDEX_SQL}) where ack_id in (select cast(doc_id as varchar) from labels)")
def semi_universe(spark, d):
    return uv.semi_universe(B.index(spark, d), B.ids(spark, d))


@register("dedupe_rows", f"select distinct * from {_DUP_INDEX}")
def dedupe_rows(spark, d):
    return uv.dedupe_rows(_dup_index(spark, d))


@register("write_universe", _UNIVERSE_SQL)
def write_universe(spark, d):
    """K1: write the universe, read it back."""
    path = tb.write_universe(_universe(spark, d), scratch_path(spark, "universe_all"))
    return spark.read.parquet(path)


@register("write_by_year", _UNIVERSE_SQL)
def write_by_year(spark, d):
    """K2: write one folder per filing year, read every year back."""
    path = tb.write_by_year(_universe(spark, d), scratch_path(spark, "universe_by_year"))
    return spark.read.parquet(path).select("ack_id", "sponsor_name", "link", "facsimile_link", "filing_year")


@register("scan_universe", f"select * from ({_UNIVERSE_SQL}) where filing_year = 2005")
def scan_universe(spark, d):
    """One year of the year-partitioned universe (partition pruning), de-duplicated."""
    u = _dup_index(spark, d).join(B.ids(spark, d), "ack_id", "left_semi")  # duplicates kept on purpose
    path = tb.write_by_year(u, scratch_path(spark, "universe_by_year"))
    return tb.scan_universe(spark, path, 2005).select("ack_id", "sponsor_name", "link", "facsimile_link",
                                                      "filing_year")


@register(
    "drop_ruler_rows",
    f"""select ack_id, filing_year from (
          select case when cast(ack_id as bigint) % 25 = 0 then repeat('-', cast(1 + cast(ack_id as bigint) % 7 as integer))
                      when cast(ack_id as bigint) % 25 = 1 then null else ack_id end as ack_id, filing_year
          from ({INDEX_SQL})) where not coalesce(regexp_full_match(ack_id, '-+'), false)""",
)
def drop_ruler_rows(spark, d):
    idx = B.index(spark, d)
    k = F.col("ack_id").cast("bigint")
    first = (F.when(k % 25 == 0, F.repeat(F.lit("-"), (1 + k % 7).cast("int")))
             .when(k % 25 == 1, F.lit(None).cast("string")).otherwise(F.col("ack_id")))
    return uv.drop_ruler_rows(idx.select(first.alias("ack_id"), "filing_year"))


@register("clean_headers", f"select * from ({INDEX_SQL})")
def clean_headers(spark, d):
    raw = B.index(spark, d).toDF(" id ", "filing_year\t", " sponsor_name", "link", "facsimile_link ")
    return uv.clean_headers(raw)


@register("cast_year", f"select ack_id, filing_year from ({INDEX_SQL})")
def cast_year(spark, d):
    idx = B.index(spark, d).select("ack_id", F.concat(F.lit(" "), F.col("filing_year").cast("string")).alias("filing_year"))
    return uv.cast_year(idx)


@register(
    "coerce_year",
    f"select ack_id, case when cast(ack_id as bigint) % 9 = 0 then null else filing_year end as filing_year from ({INDEX_SQL})",
)
def coerce_year(spark, d):
    idx = B.index(spark, d)
    s = F.when(F.col("ack_id").cast("bigint") % 9 == 0, F.lit("n/a")).otherwise(F.col("filing_year").cast("string"))
    return idx.select("ack_id", uv.coerce_year(s).alias("filing_year"))


_WS_WRAP_SQL = "chr(160) || chr(9) || chr(12288) || {x} || ' ' || chr(28) || chr(10)"


@register(
    "trim_all_strings",
    f"""select {sql_trim('ack_id')} as ack_id, filing_year,
               {sql_trim(_WS_WRAP_SQL.format(x='sponsor_name'))} as sponsor_name,
               {sql_trim('link')} as link, {sql_trim(_WS_WRAP_SQL.format(x='facsimile_link'))} as facsimile_link
        from ({INDEX_SQL})""",
)
def trim_all_strings(spark, d):
    def wrap(c):
        return F.concat(F.lit(" \t　"), F.col(c), F.lit(" \u001c\n"))

    idx = B.index(spark, d).select("ack_id", "filing_year", wrap("sponsor_name").alias("sponsor_name"), "link",
                                   wrap("facsimile_link").alias("facsimile_link"))
    return tx.trim_all_strings(idx)


@register(
    "strip_quotes",
    f"""select ack_id, trim(case when cast(ack_id as bigint) % 3 = 0 then '"' || sponsor_name || '"'
                               when cast(ack_id as bigint) % 3 = 1 then '"' || sponsor_name || '" ' else sponsor_name end,
                          '"') as sponsor_name from ({INDEX_SQL})""",
)
def strip_quotes(spark, d):
    idx = B.index(spark, d)
    k = F.col("ack_id").cast("bigint")
    q = (F.when(k % 3 == 0, F.concat(F.lit('"'), F.col("sponsor_name"), F.lit('"')))
         .when(k % 3 == 1, F.concat(F.lit('"'), F.col("sponsor_name"), F.lit('" ')))
         .otherwise(F.col("sponsor_name")))
    return idx.select("ack_id", tx.strip_quotes(q).alias("sponsor_name"))


@register("filter_year", f"select * from ({INDEX_SQL}) where filing_year = 2005")
def filter_year(spark, d):
    return uv.filter_year(B.index(spark, d), 2005)


@register("filter_year_range", f"select * from ({INDEX_SQL}) where filing_year between 2003 and 2010")
def filter_year_range(spark, d):
    return uv.filter_year_range(B.index(spark, d), 2003, 2010)


@register("distinct_ids", f"select distinct {sql_trim('ack_id')} as ack_id from ({LEDGER_SQL})")
def distinct_ids(spark, d):
    return uv.distinct_ids(B.ledger(spark, d))


@register(
    "filter_counts",
    f"""select count(*) as n_rows, count(*) filter (where coalesce(regexp_matches(p_type, '{B.CODE_FIXTURE_PATTERN}'), false)) as n_kept,
               count(distinct case when coalesce(regexp_matches(p_type, '{B.CODE_FIXTURE_PATTERN}'), false)
                                   then cast(p_partkey as varchar) end) as n_unique_ids from part""",
)
def filter_counts(spark, d):
    return uv.filter_counts(B.codes(spark, d), pattern=B.CODE_FIXTURE_PATTERN)


@register(
    "all_valid",
    f"""select coalesce(bool_and(y is not null and {sql_trim('cast(y as varchar)')} <> ''), true) as all_valid from (
          select case when cast(ack_id as bigint) % 9 = 0 then null else filing_year end as y from ({INDEX_SQL}))""",
)
def all_valid(spark, d):
    return uv.all_valid(coerce_year(spark, d))


@register(
    "union_years",
    f"select ack_id, filing_year, case when filing_year < 2009 then sponsor_name end as early from ({INDEX_SQL})",
)
def union_years(spark, d):
    idx = B.index(spark, d)
    early = idx.where(F.col("filing_year") < 2009).select("ack_id", "filing_year", F.col("sponsor_name").alias("early"))
    late = idx.where(F.col("filing_year") >= 2009).select("ack_id", "filing_year")
    return uv.union_years([early, late])


@register(
    "union_ids",
    f"""select distinct cast(doc_id as varchar) as ack_id from labels union
        select distinct cast(p_partkey as varchar) from part where coalesce(regexp_matches(p_type, '{B.CODE_FIXTURE_PATTERN}'), false)""",
)
def union_ids(spark, d):
    codes = uv.filter_codes(B.codes(spark, d), pattern=B.CODE_FIXTURE_PATTERN)
    return uv.union_ids([B.ids(spark, d), codes])
