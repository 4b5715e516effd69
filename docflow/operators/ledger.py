"""The status ledger.

The original pipeline keeps one zero-byte token file per (year, id) and moves it between status
folders. Here the ledger is a table of transitions ``(ack_id, year, status, ts, seq, message,
overwrite_)``; the current state and every report are aggregations over it. Ordering key of a
transition is ``(ts, seq)``.

Skew: one id or year may hold a large share of rows. Per-id results use aggregates with partial
(map-side) aggregation; the per-year batch uses ``row_number() <= n``, which Spark plans as a
partial ``WindowGroupLimit`` before the shuffle, so a hot year ships at most n rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.text import backoff_seconds, strip_text

KEY = ["ack_id", "year"]


def _order_key(ts: str = "ts", seq: str = "seq"):
    return F.struct(F.col(ts), F.col(seq))


# ---- W2 -------------------------------------------------------------------------------------
def latest_status(ledger: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Current status per document: ``max_by(status, struct(ts, seq))``."""
    k = _order_key()
    return ledger.groupBy(*keys).agg(
        F.max_by(F.col("status"), k).alias("status"),
        F.max(k).alias("_k"),
    ).select(*keys, "status", F.col("_k.ts").alias("ts"), F.col("_k.seq").alias("seq"))


# ---- A5 -------------------------------------------------------------------------------------
def status_waterfall(current: DataFrame, year: str = "year", status: str = "status",
                     statuses: Sequence[str] = C.STATUSES) -> DataFrame:
    """A5: documents per year and status, one column per status (0 when none).
    The status list is fixed, so this is one aggregation with a conditional count per status
    (a pivot would plan a second aggregation and shuffle)."""
    return current.groupBy(year).agg(*[F.count_if(F.col(status) == s).alias(s) for s in statuses])


# ---- W1 -------------------------------------------------------------------------------------
def next_batch(current: DataFrame, n: int, status: str = C.TO_DOWNLOAD, partition: str = "year",
               order: str = "ack_id") -> DataFrame:
    """Up to n documents per year waiting in ``status``, lowest ids first."""
    w = Window.partitionBy(partition).orderBy(F.col(order))
    return (
        current.where(F.col("status") == status)
        .withColumn("batch_rank", F.row_number().over(w))
        .where(F.col("batch_rank") <= n)
    )


# ---- A11 ------------------------------------------------------------------------------------
def live_messages(ledger: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The messages that still count: not empty, and none from before the document's last overwrite."""
    msgs = ledger.where(F.col("message").isNotNull() & (F.col("message") != "")).dropna(subset=list(keys))
    k = _order_key()
    # the last overwrite per document: a partial aggregate joined back (AQE splits a hot
    # document on the message side), so messages before it are dropped before the fold
    ow = msgs.where(F.col("overwrite_")).groupBy(*[F.col(c).alias(f"_k_{c}") for c in keys]).agg(
        F.max(k).alias("_ow"))
    # plain equality (ids are never null, D3): the join's partitioning serves the fold as well, so
    # the messages are shuffled once
    on = [msgs[c] == ow[f"_k_{c}"] for c in keys]
    return (msgs.join(ow, on, "left").where(F.col("_ow").isNull() | (k >= F.col("_ow")))
            .drop("_ow", *[f"_k_{c}" for c in keys]))


def message_fold(ledger: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The token body: messages appended with a newline each, an overwrite message drops
    everything before it, empty messages write nothing (and do not overwrite)."""
    return live_messages(ledger, keys).groupBy(*keys).agg(
        F.concat(
            F.expr("listagg(message, '\\n') WITHIN GROUP (ORDER BY ts, seq)"), F.lit("\n")
        ).alias("body")
    )


# ---- A12 ------------------------------------------------------------------------------------
def fetch_outcome(attempts: DataFrame, doc: str | Sequence[str] = "doc", order: str = "event_id",
                  status_code: str = "status_code", error_kind: str | None = None,
                  max_retries: int = C.MAX_RETRIES, backoff: float = C.BACKOFF_SECONDS,
                  message: str | None = None) -> DataFrame:
    """Decision of the retry loop over an attempt log.

    An attempt succeeds with a status below 400, fails for good with 400-499 (or a non-HTTP,
    non-network error when ``error_kind`` says 'other'), and is retried otherwise. Outcome per
    document: ``ok`` / ``permanent`` at the first terminal attempt within ``max_retries``,
    ``exhausted`` after ``max_retries`` retried attempts, else ``pending`` with the next wait.
    With ``message`` the message of the attempt that decided (or of the last one) is kept.

    Only the first ``max_retries`` attempts of a document matter. The rank is planned as a limit per
    document and task before the shuffle, so a document with a huge log sends a few rows, and
    the aggregate on the same key needs no further exchange."""
    keys = [doc] if isinstance(doc, str) else list(doc)
    said = F.col(message) if message else F.lit(None).cast("string")
    code = F.col(status_code)
    terminal = code < 500
    if error_kind is not None:
        terminal = terminal | (F.col(error_kind) == "other")
    ok = code < 400
    tried = (
        attempts.select(*keys, order, terminal.alias("_terminal"), ok.alias("_ok"), said.alias("_said"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        .where(F.col("_rank") <= max_retries)
    )
    counted = tried.groupBy(*keys).agg(
        F.min(F.when(F.col("_terminal"), F.struct("_rank", "_ok", "_said"))).alias("_t"), F.count("*").alias("_n"),
        *([F.max_by("_said", "_rank").alias("_last")] if message else []))
    has_t = F.col("_t").isNotNull()
    n = F.when(has_t, F.col("_t._rank") - 1).otherwise(F.col("_n")).cast("long")
    outcome = (
        F.when(has_t & F.col("_t._ok"), "ok")
        .when(has_t, "permanent")
        .when(n >= max_retries, "exhausted")
        .otherwise("pending")
    )
    used = F.when(has_t, n + 1).otherwise(n)
    return counted.select(
        *keys,
        outcome.alias("outcome"),
        used.cast("int").alias("attempts"),
        F.when(outcome == "pending", backoff_seconds(n, backoff)).alias("next_wait_s"),
        *([F.when(has_t, F.col("_t._said")).otherwise(F.col("_last")).alias("message")] if message else []),
    )


def waiting_to_fetch(ledger: DataFrame) -> DataFrame:
    """Documents that wait for their download: in ``to_download``, or claimed from there. ``since`` is
    when they entered that queue. One aggregation per document."""
    k = _order_key()
    queued = F.when(F.col("status").isin(C.QUEUE_STATUSES), k)
    cur = ledger.groupBy(*KEY).agg(F.max_by("status", k).alias("current"), F.max_by("status", queued).alias("queue"),
                                   F.max(queued).alias("_q"))
    return cur.where(
        F.col("current").isin(C.TO_DOWNLOAD, C.CLAIMED) & (F.coalesce("queue", F.lit(C.TO_DOWNLOAD)) == C.TO_DOWNLOAD)
    ).select(*KEY, F.col("_q.ts").alias("since"))


# ---- K6 -------------------------------------------------------------------------------------
def seed_ledger(universe: DataFrame, ledger: DataFrame | None, ts=None,
                year: str = "filing_year") -> DataFrame:
    """K6: one ``to_download`` transition per (ack_id, year) of the universe that has no ledger
    row in any status yet (re-running adds nothing; fixes D4)."""
    keys = universe.select(F.col("ack_id"), F.col(year).cast("int").alias("year")).where(
        F.col("ack_id").isNotNull() & F.col("year").isNotNull()
    ).distinct()
    if ledger is not None:
        keys = keys.join(ledger.select(*KEY), KEY, "left_anti")
    ts_col = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return keys.select(*KEY, F.lit(C.TO_DOWNLOAD).alias("status"), ts_col.alias("ts"))


# ---- J4 -------------------------------------------------------------------------------------
def lookup_attributes(docs: DataFrame, universe: DataFrame, year: str = "filing_year",
                      attrs: Sequence[str] = ("link", "facsimile_link", "sponsor_name")) -> DataFrame:
    """Attach link / facsimile link / sponsor to each document from the year's universe.
    An id on several differing universe rows is ambiguous: values null, ``ambiguous`` true,
    no row fan-out (D2). The universe is de-duplicated per key by one partial aggregation;
    the join strategy is left to AQE (it broadcasts only when the measured side is small)."""
    u = universe.select("ack_id", F.col(year).cast("int").alias("year"), F.struct(*attrs).alias("_v"))
    # all rows of a key are equal exactly when their smallest and largest value agree: one
    # aggregation (partial, map-side) instead of distinct + group by
    per_key = u.groupBy(*KEY).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    one = F.col("_lo") == F.col("_hi")
    per_key = per_key.select(*KEY, *[F.when(one, F.col(f"_lo.{a}")).alias(a) for a in attrs], (~one).alias("ambiguous"))
    return docs.join(per_key, KEY, "left")


def resolve_url(link: str = "link", facsimile: str = "facsimile_link"):
    """The primary link unless missing or blank, else the facsimile link (may be null)."""
    blank = F.col(link).isNull() | (strip_text(F.col(link)) == "")
    return F.when(blank, F.col(facsimile)).otherwise(F.col(link))


# ---- J6 -------------------------------------------------------------------------------------
def pending_work(universe: DataFrame, ledger: DataFrame, year: str = "filing_year",
                 terminal: Sequence[str] = C.TERMINAL_STATUSES) -> DataFrame:
    """Documents of the universe not yet in a terminal status."""
    done = latest_status(ledger).where(F.col("status").isin(list(terminal))).select(*KEY)
    keys = universe.select("ack_id", F.col(year).cast("int").alias("year")).distinct()
    return keys.join(done, KEY, "left_anti")


# ---- J9 -------------------------------------------------------------------------------------
def recover_claims(ledger: DataFrame, queues: Sequence[str] = C.QUEUE_STATUSES,
                   default: str = C.TO_DOWNLOAD, ts=None) -> DataFrame:
    """Documents whose current status is ``claimed`` go back to the queue they were claimed
    from (their latest queue status). One aggregation per document."""
    k = _order_key()
    in_queue = F.col("status").isin(list(queues))
    cur = ledger.groupBy(*KEY).agg(
        F.max_by(F.col("status"), k).alias("current"),
        F.max_by(F.col("status"), F.when(in_queue, k)).alias("queue"),
    )
    ts_col = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return cur.where(F.col("current") == C.CLAIMED).select(
        *KEY, F.coalesce(F.col("queue"), F.lit(default)).alias("status"), ts_col.alias("ts")
    )


def claim_conflicts(records: DataFrame, destination: str = C.TO_DOWNLOAD) -> DataFrame:
    """J9 on an imported token tree (records from ``scan_status_tree``): claimed tokens whose
    destination queue already holds a token for the same (id, year). The original raises on
    these instead of moving; here they are a side table to resolve. One semi join."""
    claimed = records.where(F.col("status") == C.CLAIMED).select(*KEY, "path")
    dest = records.where(F.col("status") == destination).select(*KEY)
    return claimed.join(dest, KEY, "left_semi")
