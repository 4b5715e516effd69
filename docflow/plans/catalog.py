"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from docflow.plans import pages_queries  # noqa: F401
from docflow.plans.registry import ORACLE, QUERIES


def _load():
    # modules added later register themselves on import
    import importlib

    for name in ("ledger_queries", "universe_queries", "text_queries", "output_queries", "source_queries",
                 "cascade_queries",
                 "streaming_queries"):
        try:
            importlib.import_module(f"docflow.plans.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"docflow.plans.{name}":
                raise


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
