"""Command line for the entry points (python -m docflow <command> ...).

  universe  --index DIR --ids PATH [--ids PATH ...] --out DIR [--min-year Y --max-year Y]
  seed      --universe PATH --ledger PATH [--year Y]
  claim     --universe PATH --ledger PATH --out DIR --n N [--queue STATUS] [--min-year Y --max-year Y]
  fetch     --attempts PATH --ledger PATH --out DIR [--min-year Y --max-year Y]
  recover   --ledger PATH [--before TIME] [--min-year Y --max-year Y]
  process   --docs DIR --ledger PATH --out DIR [--claimed-by RUN] [--min-year Y --max-year Y]
            [--extractor ID=MODULE:FUNCTION ...] [--tolerant ID ...]
  outputs   --ledger PATH --train PATH --out DIR [--min-year Y --max-year Y]
  tree-outputs --tracker DIR --train PATH --out DIR [--min-year Y --max-year Y]

Id lists are tables with ``ack_id`` and optionally ``pension_benefit_code``. ``--format csv`` reads and
writes tables (not the ledger) as CSV. Extractors are functions from bytes to pages, in the order of
the cascade, OCR last; ``ID=native`` is the built-in text layer.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json

from docflow.plans import jobs
from docflow.session import build_session
from docflow.sources import tables as tb


def load_extractors(specs: list[str], tolerant: list[int]) -> list[tuple] | None:
    """``ID=MODULE:FUNCTION`` (or ``ID=native``) to the cascade list of ``process_job``."""
    found = []
    for spec in specs or []:
        number, _, name = spec.partition("=")
        module, _, function = name.partition(":")
        codec = None if name == "native" else getattr(importlib.import_module(module), function)
        found.append((int(number), codec, int(number) in (tolerant or [])))
    return found or None


def main(argv=None):
    ap = argparse.ArgumentParser(prog="docflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    u = sub.add_parser("universe")
    u.add_argument("--index", required=True)
    u.add_argument("--ids", action="append", required=True)
    u.add_argument("--out", required=True)
    s = sub.add_parser("seed")
    s.add_argument("--universe", required=True)
    s.add_argument("--ledger", required=True)
    s.add_argument("--year", type=int)
    c = sub.add_parser("claim")
    c.add_argument("--universe", required=True)
    c.add_argument("--ledger", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--n", type=int, required=True)
    c.add_argument("--queue", default="to_download", choices=["to_download", "to_process"])
    f = sub.add_parser("fetch")
    f.add_argument("--attempts", required=True)
    f.add_argument("--ledger", required=True)
    f.add_argument("--out", required=True)
    r = sub.add_parser("recover")
    r.add_argument("--ledger", required=True)
    r.add_argument("--before", type=dt.datetime.fromisoformat)
    p = sub.add_parser("process")
    p.add_argument("--claimed-by")
    p.add_argument("--extractor", action="append")
    p.add_argument("--tolerant", action="append", type=int)
    p.add_argument("--docs", required=True)
    p.add_argument("--ledger", required=True)
    p.add_argument("--out", required=True)
    o = sub.add_parser("outputs")
    o.add_argument("--ledger", required=True)
    o.add_argument("--train", required=True)
    o.add_argument("--out", required=True)
    t = sub.add_parser("tree-outputs")
    t.add_argument("--tracker", required=True)
    t.add_argument("--train", required=True)
    t.add_argument("--out", required=True)
    for x in (u, s, c, f, o):
        x.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    for x in (u, c, f, r, p, o, t):
        x.add_argument("--min-year", type=int)
        x.add_argument("--max-year", type=int)
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    if (getattr(a, "min_year", None) is None) != (getattr(a, "max_year", None) is None):
        ap.error("give both --min-year and --max-year, or neither")
    spark = build_session(a.master)
    years = (a.min_year, a.max_year) if getattr(a, "min_year", None) and getattr(a, "max_year", None) else None
    if a.cmd == "universe":
        res = jobs.build_universe_job(spark, a.index, [{"path": x, "fmt": a.format} for x in a.ids], a.out, years, a.format)
    elif a.cmd == "seed":
        res = {"seeded": jobs.seed_job(spark, a.universe, a.ledger, a.year, fmt=a.format)}
    elif a.cmd == "claim":
        res = jobs.claim_job(spark, a.universe, a.ledger, a.out, a.n, a.queue, years, fmt=a.format)
    elif a.cmd == "fetch":
        res = jobs.fetch_job(spark, a.attempts, a.ledger, a.out, years, fmt=a.format)
    elif a.cmd == "recover":
        res = {"recovered": jobs.recover_job(spark, a.ledger, a.before, years)}
    elif a.cmd == "process":
        res = {"routed": jobs.process_job(spark, a.docs, a.ledger, a.out, years=years, claimed_by=a.claimed_by,
                                          extractors=load_extractors(a.extractor, a.tolerant))}
    elif a.cmd == "tree-outputs":
        train = spark.read.parquet(a.train).select("ack_id")
        yrs = range(years[0], years[1] + 1) if years else None
        res = jobs.tree_outputs_job(spark, a.tracker, a.out, train, yrs)
    else:
        train = tb.read_table(spark, a.train, fmt=a.format).select("ack_id")
        res = jobs.outputs_job(spark, a.ledger, a.out, train, years, fmt=a.format)
    print(json.dumps(res))


if __name__ == "__main__":
    main()
