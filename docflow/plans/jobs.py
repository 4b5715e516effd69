"""End-to-end jobs: the pipeline's entry points as Spark jobs over a ledger table.

1. ``build_universe_job`` - scan every yearly index file once, keep acceptable ids, de-duplicate,
   write the universe whole and by year, report whether every year is filled in; then
   ``seed_job`` adds one ``to_download`` transition per new document to the ledger.
   ``claim_job`` takes a batch of waiting documents and looks up their urls, ``fetch_job`` turns a log
   of download attempts into ``to_process`` / ``download_failed``, and ``recover_job`` gives back
   what interrupted workers had claimed.
2. ``process_job`` - documents whose current status is ``to_process`` are read from the file
   store, extracted (built-in text layer, or a staged cascade of pluggable codecs), routed, and
   their transitions (with the token body: text, overwrite for processed) appended to the ledger.
3. ``outputs_job`` - records, per-year texts (bodies of processed documents, repaired) and the
   train / full corpora.

The ledger is a Parquet table partitioned by ``run``: each job run writes its own partition with
dynamic overwrite, so re-running a failed run replaces its rows instead of duplicating them.
The order key of a transition is (ts, seq) with ts = the run's start time.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators import ledger as lg
from docflow.operators import outputs as out
from docflow.operators import pages as pg
from docflow.operators import universe as uv
from docflow.session import shuffles_go
from docflow.sources import documents as dc
from docflow.sources import fs
from docflow.sources import index_files as ix
from docflow.sources import tables as tb

LEDGER_COLUMNS = ["ack_id", "year", "status", "ts", "seq", "message", "overwrite_"]


ATTEMPT_SCHEMA = ("ack_id string, year int, attempt int, ts timestamp, status_code int, error_kind string, "
                  "message string")
MAX_TASKS = 50_000  # of one extraction; beyond that tasks hold more documents
LEDGER_SCHEMA = "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean, run string"


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The ledger with its ``run`` column; the schema is given, so a folder that no run has written
    rows to is an empty ledger, and so is an absent one."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_runs(spark, path).select(*LEDGER_COLUMNS)


def append_transitions(transitions: DataFrame, path: str, run: str | None = None) -> str:
    """Write one run's transitions into its own ``run`` partition (idempotent per run)."""
    run = run or uuid.uuid4().hex
    (
        transitions.select(*LEDGER_COLUMNS).withColumn("run", F.lit(run))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )
    return run


def build_universe_job(spark: SparkSession, index_root: str, id_lists: Sequence[dict], out_root: str,
                       years: tuple[int, int] | None = None, fmt: str = "parquet") -> dict:
    """Entry 1a. ``id_lists``: dicts of read_id_list arguments (path, fmt, id_col, code_col).

    Lines with too many fields are written to ``bad_lines`` and files without a header to
    ``files_without_header`` (Parquet, counted in the result). Each id list is counted by one
    aggregation (rows, rows with an acceptable code, unique ids) rather than by observed metrics: these
    count a task again when a lost executor's map output is made anew. ``fmt`` is the format of the universe ("parquet" or "csv")."""
    scan = ix.read_index(spark, index_root)
    index = scan.rows
    if years:
        index = uv.filter_year_range(index, *years)
    ids = uv.union_ids([tb.read_id_list(spark, **spec) for spec in id_lists])
    universe = uv.build_universe(index, ids)
    whole = tb.write_universe(universe, f"{out_root}/universe_all", fmt)
    written = tb.read_table(spark, whole, universe.schema, fmt)
    by_year = tb.write_by_year(written, f"{out_root}/universe_by_year", fmt)
    valid = uv.all_valid(written).first()["all_valid"]
    sides = {}
    for name, df in (("bad_lines", scan.bad_lines), ("files_without_header", scan.no_header)):
        path = tb.write_universe(df, f"{out_root}/{name}")
        sides[name] = {"path": path, "rows": spark.read.schema(df.schema).parquet(path).count()}
    seen = [{"path": spec["path"], **tb.count_id_list(spark, **spec).first().asDict()} for spec in id_lists]
    return {"universe_all": whole, "universe_by_year": by_year, "all_valid": valid, "rows": written.count(),
            "id_lists": seen, **sides}


def _now(ts: dt.datetime | None) -> dt.datetime:
    return ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _between(df: DataFrame, years: tuple[int, int] | None) -> DataFrame:
    return df.where(F.col("year").between(*years)) if years else df


def _write_run(df: DataFrame, path: str, run: str, *more: str) -> DataFrame:
    """Write ``df`` as the ``run`` partition of a table and return that partition as stored."""
    rows = df.withColumn("run", F.lit(run))
    with shuffles_go(df.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", *more).parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path).where(F.col("run") == run)


def claim_job(spark: SparkSession, universe_path: str, ledger_path: str, out_path: str, n: int,
              queue: str = C.TO_DOWNLOAD, years: tuple[int, int] | None = None, ts: dt.datetime | None = None,
              run: str | None = None, fmt: str = "parquet") -> dict:
    """Claim up to ``n`` documents of each year that wait in ``queue``, lowest ids first, and write
    the batch with the url to fetch (ack_id, year, url, sponsor_name, ambiguous) as the ``run``
    partition of ``out_path``. The url is null for documents that the universe does not hold or
    holds with differing links (``ambiguous``). ``process_job`` takes the run of a batch claimed from ``to_process``.

    A run repeated under its id claims the same rows again. Two claims at the same time must be
    for different years: tables have no lock that would keep both from claiming one document."""
    run = run or uuid.uuid4().hex
    earlier = read_runs(spark, ledger_path).where(F.col("run") != run)
    batch = lg.next_batch(lg.latest_status(_between(earlier, years)), n, queue).select("ack_id", "year")
    universe = tb.read_table(spark, universe_path, None, fmt)
    attrs = ("link", "facsimile_link", "sponsor_name")
    universe = universe.withColumns({a: F.lit(None).cast("string") for a in attrs if a not in universe.columns})
    found = lg.lookup_attributes(batch, universe, attrs=attrs)
    written = _write_run(found.select("ack_id", "year", lg.resolve_url().alias("url"), "sponsor_name", "ambiguous"),
                         out_path, run)
    append_transitions(_transitions(written, F.lit(C.CLAIMED), _now(ts)), ledger_path, run)
    return {"run": run, "claimed": written.count()}


def fetch_job(spark: SparkSession, attempts_path: str, ledger_path: str, out_path: str,
              years: tuple[int, int] | None = None, ts: dt.datetime | None = None, run: str | None = None,
              fmt: str = "parquet") -> dict:
    """Apply the retry rule to a log of download attempts (ack_id, year, attempt, ts, status_code,
    error_kind, message) and record the outcome of each document that waits for its download:
    ``to_process`` when an attempt succeeded, ``download_failed`` with the message of the deciding attempt
    when it failed for good or used up its attempts. Others stay where they are.

    Attempts older than the document's entry into the queue belong to an earlier try and do not count,
    so a log may be read again. All outcomes, with the wait before the next attempt, are the ``run``
    partition of ``out_path``."""
    run = run or uuid.uuid4().hex
    waiting = lg.waiting_to_fetch(_between(read_runs(spark, ledger_path).where(F.col("run") != run), years))
    log = tb.read_table(spark, attempts_path, ATTEMPT_SCHEMA, fmt).join(waiting, ["ack_id", "year"])
    log = log.where(F.col("since").isNull() | F.col("ts").isNull() | (F.col("ts") >= F.col("since")))
    decided = lg.fetch_outcome(log, ["ack_id", "year"], "attempt", error_kind="error_kind", message="message")
    written = _write_run(decided, out_path, run)
    status = (F.when(F.col("outcome") == "ok", C.TO_PROCESS)
              .when(F.col("outcome").isin("permanent", "exhausted"), C.DOWNLOAD_FAILED))
    message = F.when(status == C.DOWNLOAD_FAILED, F.col("message"))
    append_transitions(_transitions(written, status, _now(ts), message).where(F.col("status").isNotNull()), ledger_path, run)
    return {"run": run, **{r["outcome"]: r["count"] for r in written.groupBy("outcome").count().collect()}}


def recover_job(spark: SparkSession, ledger_path: str, before: dt.datetime | None = None,
                years: tuple[int, int] | None = None, ts: dt.datetime | None = None, run: str | None = None) -> int:
    """Give claimed documents back to the queue they were claimed from. ``before`` limits this to
    claims made before that time, so that workers still at work keep theirs."""
    run = run or uuid.uuid4().hex
    ledger = _between(read_runs(spark, ledger_path).where(F.col("run") != run), years)
    back = lg.recover_claims(ledger)
    if before is not None:
        old = lg.latest_status(ledger).where((F.col("status") == C.CLAIMED) & (F.col("ts") < F.lit(before)))
        back = back.join(old.select("ack_id", "year"), ["ack_id", "year"], "left_semi")
    append_transitions(_transitions(back, F.col("status"), _now(ts)), ledger_path, run)
    return read_runs(spark, ledger_path).where(F.col("run") == run).count()


def _transitions(rows: DataFrame, status, ts: dt.datetime, message=None, overwrite=None) -> DataFrame:
    message = F.lit(None) if message is None else message
    overwrite = F.lit(False) if overwrite is None else overwrite
    return rows.select("ack_id", "year", status.alias("status"), F.lit(ts).cast("timestamp").alias("ts"),
                       F.lit(1).cast("long").alias("seq"), message.cast("string").alias("message"),
                       overwrite.alias("overwrite_"))


def seed_job(spark: SparkSession, universe_path: str, ledger_path: str, year: int | None = None,
             ts: dt.datetime | None = None, run: str | None = None, fmt: str = "parquet") -> int:
    """Entry 1b: a ``to_download`` transition for every universe document without one."""
    universe = tb.read_table(spark, universe_path, None, fmt)
    if year is not None:
        universe = uv.filter_year(universe, year)
    ts = _now(ts)
    seeds = lg.seed_ledger(universe, read_ledger(spark, ledger_path), ts=ts).select(
        "ack_id", "year", "status", "ts", F.lit(0).cast("long").alias("seq"),
        F.lit(None).cast("string").alias("message"), F.lit(False).alias("overwrite_"))
    run = append_transitions(seeds, ledger_path, run)
    # counted from the written run partition, not by recomputing the anti join
    return read_runs(spark, ledger_path).where(F.col("run") == run).count()


def spread_documents(docs: DataFrame, docs_per_task: int = C.PROCESS_BATCH_SIZE) -> DataFrame:
    """Spread a document listing over tasks by count, about ``docs_per_task`` documents each.

    A listing row is ~100 bytes while extracting its document can take minutes, so partitions
    sized by bytes (adaptive coalescing after a join) would put every document into one or two
    tasks. An explicit partition count is kept by adaptive execution. Ranges of (year, id hash)
    keep a task's documents mostly within one year and are deterministic for retried tasks.
    The count reads the listing only."""
    n = docs.count()
    if n == 0:
        return docs
    try:
        cores = docs.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext
        cores = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(cores, min(MAX_TASKS, -(-n // max(1, docs_per_task))))
    return docs.repartitionByRange(min(n, parts), F.col("year"), F.xxhash64("ack_id"))


def route_files(docs: DataFrame, terms: Sequence[str], extractors: Sequence[tuple] | None, n: int, limit_pages: int) -> DataFrame:
    """Extract and route the files of a listing (ack_id, year, path); files that cannot be read have a
    null status. Adds ``message``: why a file could not be read, opened or searched."""
    if extractors is None:
        ps = dc.extract_pages_native(dc.read_content(docs)).withColumn("reader_error", F.lit(None).cast("string"))
        routed = pg.route_documents(ps, terms, n, limit_pages, error="error", sep="\f")  # a text layer: form feed
    else:
        wide = dc.run_cascade(docs, extractors, terms, n=n, keep_errors=True)
        ids = [k for k, _, _ in extractors]
        routed = pg.route_cascade(wide, [f"pages_{k}" for k in ids], f"pages_{ids[0]}", f"pages_{ids[-1]}",
                                  [f"pages_{k}" for k, _, tol in extractors if tol], terms, n, limit_pages,
                                  error="error")
    unread = F.col("read_error").isNotNull()
    failed = F.coalesce("reader_error", F.lit("a page before the first hit cannot be read"))
    routed = routed.withColumns({
        "message": F.when(unread, F.col("read_error")).when(F.col("status") == C.PDF_READER_FAILED, failed)
        .otherwise(F.col("error")),
        "status": F.when(~unread, F.col("status")),
        "text": F.when(~unread, F.col("text"))})
    return routed


def record_routed(out_rows: DataFrame, out_path: str, ledger_path: str, run: str, ts: dt.datetime | None) -> None:
    """Write a run's routed rows, then the transitions of those that have a status, read back from them."""
    cols = ["ack_id", "year", "status", "page_no", "n_pages", "text", "message"]
    # extraction runs in the small tasks above; the routed rows are then rebalanced by year so
    # each year is written as files of the advisory size rather than one small file per task
    out_rows = out_rows.select(*cols).hint("rebalance", "year")
    written = _write_run(out_rows, out_path, run, "year")
    with_text = F.col("status").isin(C.PROCESSED, C.TEXT_EXTRACTION_EMPTY)
    message = F.when(with_text, F.col("text")).when(F.col("status") == C.PDF_READER_FAILED, F.col("message"))
    decided = written.where(F.col("status").isNotNull())
    append_transitions(_transitions(decided, F.col("status"), _now(ts), message, F.col("status") == C.PROCESSED),
                       ledger_path, run)


def process_job(spark: SparkSession, doc_root: str, ledger_path: str, out_path: str,
                terms: Sequence[str] = C.TERMS, extractors: Sequence[tuple] | None = None,
                n: int = C.NUMBER_PAGES_TO_SAVE, limit_pages: int = C.PAGE_LIMIT,
                years: tuple[int, int] | None = None, ts: dt.datetime | None = None,
                docs_per_task: int = C.PROCESS_BATCH_SIZE, run: str | None = None,
                claimed_by: str | None = None) -> str:
    """Entry 2. ``extractors``: None for the built-in text layer, or the cascade list of
    (id, callable, tolerant) with text layer first and OCR last (see ``run_cascade``).
    About ``docs_per_task`` documents go to each extraction task (the original's claim size).
    Each run writes its own ``run`` partition of the output and of the ledger; a run repeated
    under its id replaces its own rows, and one without work writes nothing.

    The work is every document in ``to_process``, or with ``claimed_by`` the documents that this claim
    run holds. Documents without a file, and files that cannot be read, get an output row
    with a null status and the reason as ``message``, and no transition: they stay where they are. The
    message of a document whose reader failed goes to the ledger."""
    run = run or uuid.uuid4().hex
    fs.filesystem(doc_root)  # an unknown scheme fails here, not in every task
    runs = _between(read_runs(spark, ledger_path), years).where(F.col("run") != run)
    if claimed_by:
        last = F.max_by(F.struct("status", "run"), F.struct("ts", "seq"))
        todo = runs.groupBy("ack_id", "year").agg(last.alias("_last")).where(
            (F.col("_last.status") == C.CLAIMED) & (F.col("_last.run") == claimed_by)).select("ack_id", "year")
    else:
        todo = lg.latest_status(runs).where(F.col("status") == C.TO_PROCESS).select("ack_id", "year")
    # the semi join sees the file listing only; each extraction task reads its own files by path,
    # so document bytes are never shuffled whatever the size of the to-do list
    if todo.isEmpty():
        return out_path
    files = dc.scan_documents(spark, doc_root, with_content=False)
    missing = dc.missing_documents(todo, files).withColumn("message", F.lit("no file"))
    docs = spread_documents(files.join(todo, ["ack_id", "year"], "left_semi"), docs_per_task)
    routed = route_files(docs, terms, extractors, n, limit_pages)
    # extraction and routing run once: the routed table is written, transitions read it back
    record_routed(routed.unionByName(missing, allowMissingColumns=True), out_path, ledger_path, run, ts)
    return out_path


def outputs_job(spark: SparkSession, ledger_path: str, out_root: str, train_ids: DataFrame,
                years: tuple[int, int] | None = None, exclude_train: bool = False, fmt: str = "parquet") -> dict:
    """Entry 3: records (K3), per-year texts (K4) and the corpora (K5), as "parquet" or "csv". Texts
    are the token bodies, so each message ends with a newline, as in ``tree_outputs_job``."""
    ledger = read_ledger(spark, ledger_path)
    if years:
        ledger = ledger.where(F.col("year").between(*years))
    current = lg.latest_status(ledger).join(lg.message_fold(ledger), ["ack_id", "year"], "left")
    recs = out.records(current.select("ack_id", "year", "status"))
    rec_path = tb.write_records(recs, f"{out_root}/records", fmt)
    texts = out.year_texts(current.withColumn("text", F.col("body")))
    text_path = tb.write_year_text(texts, f"{out_root}/year_text", fmt)
    train, full = out.build_corpora(tb.read_table(spark, text_path, texts.schema, fmt), train_ids, exclude_train)
    corpora = tb.write_corpora(train, full, f"{out_root}/train", f"{out_root}/full", fmt)
    return {"records": rec_path, "year_text": text_path, **corpora}


def tree_outputs_job(spark: SparkSession, tracker_root: str, out_root: str, train_ids: DataFrame,
                     years: Sequence[int] | None = None, exclude_train: bool = False) -> dict:
    """Entry 3 from an existing token tree (for installations that still have one): list every
    token including zero-byte ones (S8), parse records (P10), read processed bodies (S9), drop rows
    without text (P19), repair (F8), write records and per-year texts (K3, K4) and the corpora (K5).
    Each token is one record (D4: duplicate tokens of an id stay separate rows, as in the tree)."""
    from docflow.sources import tokens as tk

    from docflow.session import scratch_path

    # list the tree once (driver walks to the year folders, executors list them) and keep it
    listing_path = scratch_path(spark, "token_listing")
    tk.status_records(tk.scan_status_tree(spark, tracker_root, years)).write.parquet(listing_path)
    listing = spark.read.parquet(listing_path)
    rec_path = tb.write_records(listing.select("ack_id", "year", "status", "path"), f"{out_root}/records")
    payload = tk.read_payload(spark, listing, tracker_root)
    texts = out.year_texts(payload.withColumnRenamed(C.OCR_TEXT_COL, "text"))
    text_path = tb.write_year_text(texts, f"{out_root}/year_text")
    train, full = out.build_corpora(spark.read.schema(texts.schema).parquet(text_path), train_ids, exclude_train)
    corpora = tb.write_corpora(train, full, f"{out_root}/train", f"{out_root}/full")
    return {"records": rec_path, "year_text": text_path, **corpora}
