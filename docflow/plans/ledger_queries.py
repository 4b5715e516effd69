"""Registered queries for the status ledger and token paths (K6, W1, W2, A5, A11, A12, J4, J6,
J9, P10-P14, F9, F11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions import paths as ph
from docflow.operators import ledger as lg
from docflow.plans import bindings as B
from docflow.plans.registry import (
    ATTEMPT_CODE_SQL,
    ATTEMPTS_SQL,
    INDEX_SQL,
    LATEST_SQL,
    LEDGER_SQL,
    TOKEN_PATHS_SQL,
    register,
    sql_trim,
    waterfall_select,
)

SEED_TS = dt.datetime(2025, 1, 1)


@register("latest_status", f"select ack_id, year, status from ({LATEST_SQL})")
def latest_status(spark, d):
    return lg.latest_status(B.ledger(spark, d)).select("ack_id", "year", "status")


@register("status_waterfall", f"select year, {waterfall_select(C.STATUSES)} from ({LATEST_SQL}) group by year")
def status_waterfall(spark, d):
    return lg.status_waterfall(lg.latest_status(B.ledger(spark, d)))


@register(
    "next_batch",
    f"""select ack_id, year, status, batch_rank from (
          select ack_id, year, status, cast(row_number() over (partition by year order by ack_id) as integer) as batch_rank
          from ({LATEST_SQL}) where status = 'to_download') where batch_rank <= {C.PROCESS_BATCH_SIZE}""",
)
def next_batch(spark, d):
    cur = lg.latest_status(B.ledger(spark, d))
    return lg.next_batch(cur, C.PROCESS_BATCH_SIZE, C.TO_DOWNLOAD).select("ack_id", "year", "status", "batch_rank")


@register(
    "message_fold",
    f"""with m as (select * from ({LEDGER_SQL}) where message is not null and message <> ''),
        o as (select ack_id, year, max((ts, seq)) filter (where overwrite_) as ow from m group by 1, 2)
        select m.ack_id, m.year, string_agg(m.message, chr(10) order by m.ts, m.seq) || chr(10) as body
        from m join o using (ack_id, year) where o.ow is null or (m.ts, m.seq) >= o.ow group by 1, 2""",
)
def message_fold(spark, d):
    return lg.message_fold(B.ledger(spark, d))


_FETCH_SQL = f"""
with a as ({ATTEMPTS_SQL}),
t as (select doc, min(event_id) filter (where status_code < 500) as tid,
             arg_min(status_code, event_id) filter (where status_code < 500) as tcode from a group by 1),
c as (select a.doc, t.tid, t.tcode,
             count(*) filter (where t.tid is null or a.event_id < t.tid) as n from a join t using (doc)
      group by 1, 2, 3)
select doc,
  case when tid is not null and n < {C.MAX_RETRIES} and tcode < 400 then 'ok'
       when tid is not null and n < {C.MAX_RETRIES} then 'permanent'
       when n >= {C.MAX_RETRIES} then 'exhausted' else 'pending' end as outcome,
  cast(case when tid is not null and n < {C.MAX_RETRIES} then n + 1 else least(n, {C.MAX_RETRIES}) end as integer)
    as attempts,
  case when not (tid is not null and n < {C.MAX_RETRIES}) and n < {C.MAX_RETRIES}
       then {C.BACKOFF_SECONDS} * pow(2, n - 1) end as next_wait_s
from c
"""


@register("fetch_outcome", _FETCH_SQL)
def fetch_outcome(spark, d):
    return lg.fetch_outcome(B.attempts(spark, d))


@register(
    "fetch_outcome_lots",
    f"""with a as (select user_id as doc, cast(event_id % 40 as integer) as lot, event_id, props as said, {ATTEMPT_CODE_SQL} as status_code
                  from events),
        r as (select *, row_number() over (partition by doc, lot order by event_id) as rn from a),
        t as (select doc, lot, min(rn) filter (where status_code < 500) as trn, count(*) as n_all from r group by 1, 2),
        o as (select doc, lot, coalesce(trn <= {C.MAX_RETRIES}, false) as done, trn,
                     least(n_all, {C.MAX_RETRIES}) as n from t),
        u as (select doc, lot, done, n, cast(case when done then trn else n end as integer) as used from o)
        select u.doc, u.lot,
               case when done and r.status_code < 400 then 'ok' when done then 'permanent'
                    when n >= {C.MAX_RETRIES} then 'exhausted' else 'pending' end as outcome,
               used as attempts,
               case when not done and n < {C.MAX_RETRIES} then {C.BACKOFF_SECONDS} * pow(2, n - 1) end as next_wait_s,
               r.said as message
        from u join r on r.doc = u.doc and r.lot = u.lot and r.rn = u.used""",
)
def fetch_outcome_lots(spark, d):
    """A12 on short logs, so that some documents still wait for their next attempt, with messages."""
    return lg.fetch_outcome(B.attempt_log(spark, d), ["doc", "lot"], message="said")


@register(
    "waiting_to_fetch",
    f"""select ack_id, year, max(ts) filter (where status in ('to_download', 'to_process')) as since
        from ({LEDGER_SQL}) group by 1, 2
        having arg_max(status, (ts, seq)) in ('to_download', 'claimed')
           and coalesce(arg_max(status, (ts, seq)) filter (where status in ('to_download', 'to_process')),
                        'to_download') = 'to_download'""",
)
def waiting_to_fetch(spark, d):
    return lg.waiting_to_fetch(B.ledger(spark, d))


@register(
    "backoff_seconds",
    f"select doc, event_id, {C.BACKOFF_SECONDS} * pow(2, rn - 1) as wait_s from "
    f"(select doc, event_id, cast(row_number() over (partition by doc order by event_id) as bigint) as rn "
    f"from ({ATTEMPTS_SQL})) where rn <= {C.MAX_RETRIES - 1}",
)
def backoff_seconds(spark, d):
    """F10 on every retried attempt number (1..max_retries-1) of every document."""
    from pyspark.sql import Window

    from docflow.functions.text import backoff_seconds as bo

    a = B.attempts(spark, d)
    w = Window.partitionBy("doc").orderBy("event_id")
    r = a.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= C.MAX_RETRIES - 1)
    return r.select("doc", "event_id", bo("rn", C.BACKOFF_SECONDS).alias("wait_s"))


@register(
    "seed_ledger",
    f"""select distinct ack_id, filing_year as year, 'to_download' as status
        from ({INDEX_SQL}) u
        where not exists (select 1 from ({LEDGER_SQL}) l where l.ack_id = u.ack_id and l.year = u.filing_year)""",
)
def seed_ledger(spark, d):
    # the transition's ts is a run constant; the check compares what is seeded
    return lg.seed_ledger(B.index(spark, d), B.ledger(spark, d), ts=SEED_TS).select("ack_id", "year", "status")


@register(
    "lookup_attributes",
    f"""with i as (select * from ({INDEX_SQL})),
        r as (select * from i
              union all select ack_id, filing_year, sponsor_name || '?', link, facsimile_link from i where cast(ack_id as bigint) % 7 = 3
              union all select * from i where cast(ack_id as bigint) % 7 = 4),
        u as (select distinct ack_id, filing_year as year, link, facsimile_link, sponsor_name from r),
        k as (select ack_id, year, count(*) = 1 as one, max(link) as link, max(facsimile_link) as facsimile_link,
                     max(sponsor_name) as sponsor_name from u group by 1, 2)
        select l.ack_id, l.year, l.status,
               case when k.one then k.link end as link,
               case when k.one then k.facsimile_link end as facsimile_link,
               case when k.one then k.sponsor_name end as sponsor_name,
               not k.one as ambiguous
        from ({LATEST_SQL}) l left join k on l.ack_id = k.ack_id and l.year = k.year""",
)
def lookup_attributes(spark, d):
    cur = lg.latest_status(B.ledger(spark, d)).select("ack_id", "year", "status")
    return lg.lookup_attributes(cur, B.index_with_repeats(spark, d))


@register(
    "resolve_url",
    f"""select ack_id, case when link is null or {sql_trim('link')} = '' then facsimile_link else link end as url
        from ({INDEX_SQL})""",
)
def resolve_url(spark, d):
    return B.index(spark, d).select("ack_id", lg.resolve_url().alias("url"))


@register(
    "pending_work",
    f"""select distinct ack_id, filing_year as year from ({INDEX_SQL}) u
        where not exists (select 1 from ({LATEST_SQL}) l where l.ack_id = u.ack_id and l.year = u.filing_year
                          and l.status in ({", ".join(f"'{s}'" for s in C.TERMINAL_STATUSES)}))""",
)
def pending_work(spark, d):
    return lg.pending_work(B.index(spark, d), B.ledger(spark, d))


@register(
    "recover_claims",
    f"""select ack_id, year, coalesce(arg_max(status, (ts, seq)) filter (where status in ('to_download', 'to_process')),
                                   'to_download') as status
        from ({LEDGER_SQL}) group by 1, 2 having arg_max(status, (ts, seq)) = 'claimed'""",
)
def recover_claims(spark, d):
    return lg.recover_claims(B.ledger(spark, d), ts=SEED_TS).select("ack_id", "year", "status")


# ---- token paths ---------------------------------------------------------------------------
_NORM = "replace(path, chr(92), '/')"


_PARSED_SQL = f"""select regexp_replace(string_split({_NORM}, '/')[-1], '\\.[^.]+$', '') as ack_id,
               try_cast(string_split({_NORM}, '/')[-2] as integer) as year,
               string_split({_NORM}, '/')[-3] as status, path
        from ({TOKEN_PATHS_SQL}) where try_cast(string_split({_NORM}, '/')[-2] as integer) is not null"""


@register(
    "parse_status_path",
    f"""select regexp_replace(string_split({_NORM}, '/')[-1], '\\.[^.]+$', '') as ack_id,
               try_cast(string_split({_NORM}, '/')[-2] as integer) as year,
               string_split({_NORM}, '/')[-3] as status, path
        from ({TOKEN_PATHS_SQL}) where try_cast(string_split({_NORM}, '/')[-2] as integer) is not null""",
)
def parse_status_path(spark, d):
    return ph.parse_status_path(B.token_paths(spark, d)).select("ack_id", "year", "status", "path")


_NAME = f"string_split({_NORM}, '/')[-1]"
_STEM = f"case when regexp_matches({_NAME}, '^(.+)\\.[^.]+$') then regexp_extract({_NAME}, '^(.+)\\.[^.]+$', 1) else {_NAME} end"


@register(
    "parse_token_path",
    f"select {_STEM} as ack_id, string_split({_NORM}, '/')[-2] as year, path from ({TOKEN_PATHS_SQL})",
)
def parse_token_path(spark, d):
    return ph.parse_token_path(B.token_paths(spark, d))


@register(
    "path_parts",
    f"""select path, {_NAME} as name, {_STEM} as stem, regexp_extract({_NAME}, '^.+(\\.[^.]+)$', 1) as suffix,
               string_split({_NORM}, '/')[-2] as parent from ({TOKEN_PATHS_SQL})""",
)
def path_parts(spark, d):
    t = B.token_paths(spark, d)
    return t.select("path", ph.name("path").alias("name"), ph.stem("path").alias("stem"),
                    ph.suffix("path").alias("suffix"), ph.parent_name("path").alias("parent"))


@register(
    "is_year_name",
    f"select path, coalesce(regexp_matches(string_split({_NORM}, '/')[-2], '^[0-9]{{4}}$'), false) as is_year "
    f"from ({TOKEN_PATHS_SQL})",
)
def is_year_name(spark, d):
    t = B.token_paths(spark, d)
    return t.select("path", ph.is_year_name(ph.parent_name("path")).alias("is_year"))


@register(
    "skip_in_progress",
    f"select path, {_NAME} as name from ({TOKEN_PATHS_SQL}) where not contains({_NAME}, '.claiming.')",
)
def skip_in_progress(spark, d):
    t = B.token_paths(spark, d).select("path", ph.name("path").alias("name"))
    return ph.skip_in_progress(t)


_FOLDER = f"regexp_replace({_NORM}, '/[^/]*$', '')"


@register(
    "clean_token_names",
    f"""with t as (select distinct {_FOLDER} as folder, {_NAME} as name from ({TOKEN_PATHS_SQL})),
        c as (select folder, name, case when contains(name, '.txt') then split_part(name, '.txt', 1) || '.txt'
                                        else name end as clean from t),
        g as (select *, max(cast(name = clean as int)) over (partition by folder, clean) as ex,
                        row_number() over (partition by folder, clean order by name) as rn from c)
        select folder, name, case when name <> clean and ex = 0 and rn = 1 then clean else name end as new_name
        from g""",
)
def clean_token_names(spark, d):
    t = B.token_paths(spark, d).select(
        F.regexp_replace(ph.normalize_separators("path"), "/[^/]*$", "").alias("folder"),
        ph.name("path").alias("name"),
    )
    return ph.clean_token_names(t)


@register(
    "claim_conflicts",
    f"""with r as (select distinct ack_id, year, status, path from ({_PARSED_SQL}))
        select c.ack_id, c.year, c.path from r c
        where c.status = 'claimed'
          and exists (select 1 from r d where d.status = 'to_download' and d.ack_id = c.ack_id and d.year = c.year)""",
)
def claim_conflicts(spark, d):
    """J9 conflicts: a token tree's claimed tokens whose queue already holds one for the id."""
    recs = ph.parse_status_path(B.token_paths(spark, d).select("path").distinct())
    return lg.claim_conflicts(recs)
