"""Registry of named queries and their DuckDB twins (the driver contract reads it)."""

from __future__ import annotations

from collections.abc import Callable

from docflow.constants import WHITESPACE

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: ``fn(spark, sf_dir) -> DataFrame`` registered under ``key``; ``sql`` is the
    equivalent DuckDB query over the driver's views (None for rows-only checks)."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


# SQL helpers shared by the twins -------------------------------------------------------------
WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def sql_trim(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


def sql_terms_hit(expr: str, terms: list[str]) -> str:
    """DuckDB twin of find_terms over the literal term list (no driver-side folding)."""
    import re

    low = f"lower({expr})"
    parts = [f"contains({low}, '{t.lower()}')" for t in terms]
    folded = f"regexp_replace({low}, '[^a-z0-9() ]', '', 'g')"
    parts += [f"contains({folded}, '{re.sub(r'[^a-z0-9() ]', '', t.lower())}')" for t in terms]
    return "(" + " or ".join(parts) + ")"


FILING_YEAR_SQL = "(1999 + cast(substring(source, 4) as int))"

INDEX_SQL = f"""
select cast(doc_id as varchar) as ack_id,
       {FILING_YEAR_SQL} as filing_year,
       lang as sponsor_name,
       case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '  '
            else concat('https://a/', doc_id) end as link,
       case when doc_id % 10 = 0 then null else concat('https://b/', doc_id) end as facsimile_link
from documents
"""

# pages of 3 lines, 0-based, like bindings.pagesets
PAGES_SQL = f"""
select doc_id, year, cast(floor((i - 1) / 3) as int) as page_no,
       string_agg(l, chr(10) order by i) as text
from (select doc_id, {FILING_YEAR_SQL} as year,
             unnest(string_split(text, chr(10))) as l,
             generate_subscripts(string_split(text, chr(10)), 1) as i
      from documents)
group by 1, 2, 3
"""

LEDGER_SQL = """
select cast(user_id as varchar) as ack_id, cast(1999 + user_id % 20 as integer) as year,
       case event_type when 'signup' then 'to_download' when 'view' then 'claimed'
                       when 'click' then 'to_process' when 'purchase' then 'processed'
                       else 'plan_not_found' end as status,
       ts, event_id as seq, props as message, event_type = 'purchase' as overwrite_
from events
"""

LATEST_SQL = f"""
select ack_id, year, arg_max(status, (ts, seq)) as status, max(ts) as ts,
       arg_max(seq, (ts, seq)) as seq
from ({LEDGER_SQL}) group by 1, 2
"""

ATTEMPT_CODE_SQL = """
       cast(case when event_type = 'error' then (case when event_id % 2 = 0 then 404 else 503 end)
                 when event_type = 'purchase' then 200 else 503 end as integer)"""

ATTEMPTS_SQL = f"select user_id as doc, event_id, {ATTEMPT_CODE_SQL} as status_code from events"


def waterfall_select(statuses: list[str]) -> str:
    return ", ".join(f"count(*) filter (where status = '{s}') as {s}" for s in statuses)

TOKEN_PATHS_SQL = """
select event_id,
  case when event_id % 13 = 0 then replace(p, '/', chr(92)) else p end as path
from (select event_id, concat_ws('/', '/srv/tracker',
         concat(case when event_type in ('signup', 'click') then 'queue/'
                     when event_type not in ('view', 'purchase') then 'error/' else '' end,
                case event_type when 'signup' then 'to_download' when 'view' then 'claimed'
                     when 'click' then 'to_process' when 'purchase' then 'processed'
                     else 'plan_not_found' end),
         case when event_id % 17 = 0 then 'abcd' else cast(1999 + user_id % 20 as varchar) end,
         case when event_id % 11 = 0 then concat(user_id, '.txt.claiming.', event_id)
              else concat(user_id, '.txt') end) as p
      from events)
"""
