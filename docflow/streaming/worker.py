"""The worker loop and the token bodies as streams.

``stream_process`` takes document files as they arrive and does for each micro-batch what ``process_job``
does for the whole folder: documents that the ledger has in ``to_process`` are extracted (built-in layer
or cascade), routed and recorded. Every micro-batch is a run of its own, named after the stream and the
batch: a batch that is repeated replaces its own rows in the output and in the ledger.

``stream_messages`` keeps the messages of a stream of transitions as a log by batch. Bodies are folded when
they are read, in the order of (ts, seq), so files may arrive in any order and no text is held as
streaming state. ``compact_messages`` writes what still counts - nothing before a document's last overwrite -
as a snapshot with a commit marker; ``compaction.vacuum`` deletes the batches that snapshots hold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators import ledger as lg
from docflow.plans import jobs
from docflow.sources import documents as dc
from docflow.streaming import compaction as cp
from docflow.streaming.jobs import DOCS_PER_CORE, LEDGER_SCHEMA, arrivals

MESSAGE_ROWS = "ack_id string, year int, ts timestamp, seq long, message string, overwrite_ boolean"


def process_files(files: DataFrame, run: str, ledger_path: str, out: str, terms: Sequence[str] = C.TERMS,
                  extractors: Sequence[tuple] | None = None, n: int = C.NUMBER_PAGES_TO_SAVE,
                  limit_pages: int = C.PAGE_LIMIT, ts: dt.datetime | None = None) -> None:
    """One micro-batch of file listing rows (``path``) as the run ``run``. Only the ledger rows of
    the batch's documents are aggregated. Files of other documents are passed over: when such a document
    comes to ``to_process`` later, ``process_job`` finds it."""
    listing = files.select(*dc.document_keys(), "path")
    runs = jobs.read_runs(files.sparkSession, ledger_path).where(F.col("run") != run)
    known = runs.join(listing.select(*lg.KEY).distinct(), lg.KEY, "left_semi")
    todo = lg.latest_status(known).where(F.col("status") == C.TO_PROCESS).select(*lg.KEY)
    # a text layer is decoded at once, a document of other codecs may take minutes
    per_task = DOCS_PER_CORE if extractors is None else C.PROCESS_BATCH_SIZE
    docs = jobs.spread_documents(listing.join(todo, lg.KEY, "left_semi"), per_task)
    jobs.record_routed(jobs.route_files(docs, terms, extractors, n, limit_pages), out, ledger_path, run, ts)


def stream_process(spark: SparkSession, doc_root: str, ledger_path: str, out: str, checkpoint: str, name: str,
                   batch_files: int | None = None, **options):
    """Drain the files that arrived under ``doc_root`` since the last call in batches of
    ``batch_files`` (all of them by default). ``name`` tells this stream's runs from others and belongs
    to the checkpoint; ``options`` go to ``process_files``. Returns the finished query."""
    def sink(batch: DataFrame, batch_id: int):
        process_files(batch, f"{name}-{batch_id}", ledger_path, out, **options)

    q = (
        arrivals(spark, doc_root, checkpoint, batch_files).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def stream_messages(spark: SparkSession, ledger_root: str, out: str, checkpoint: str, batch_files: int | None = None):
    """Append the messages of transition files to a log, one ``batch_id`` partition a micro-batch."""
    reader = spark.readStream.schema(LEDGER_SCHEMA)
    if batch_files:
        reader = reader.option("maxFilesPerTrigger", batch_files)
    said = reader.parquet(ledger_root).where((F.col("message") != "") & F.col("ack_id").isNotNull() & F.col("year").isNotNull())

    def sink(batch: DataFrame, batch_id: int):
        (
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)
        )

    q = (
        said.drop("status").writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q


def _snapshot(spark: SparkSession, snapshots: str | None) -> tuple[int, list[str]]:
    """The newest committed snapshot: its last batch and the folder of its rows (-1 and none if there is none)."""
    found = cp._children(spark, snapshots, "snapshot") if snapshots else {}
    for n, path in sorted(found.items(), reverse=True):
        fs, marker = cp._path(spark, f"{path}/{cp.MARKER}")
        if fs.exists(marker):
            return n, [f"{path}/rows"]
    return -1, []


def read_messages(spark: SparkSession, log: str, snapshots: str | None = None) -> DataFrame:
    """The newest committed snapshot and the batches after it; batches that it holds are not read again."""
    upto, paths = _snapshot(spark, snapshots)
    paths = paths + [p for n, p in sorted(cp._children(spark, log, "batch_id").items()) if n > upto]
    return spark.read.schema(MESSAGE_ROWS).parquet(*paths) if paths else spark.createDataFrame([], MESSAGE_ROWS)


def read_bodies(spark: SparkSession, log: str, snapshots: str | None = None) -> DataFrame:
    """The current token body of every document that has one."""
    return lg.message_fold(read_messages(spark, log, snapshots))


def compact_messages(spark: SparkSession, log: str, snapshots: str) -> int | None:
    """Write a snapshot of the messages that still count, up to the log's last batch, and commit it;
    returns that batch, or None if there is nothing new. What a failed compaction left is overwritten."""
    upto = max(cp._children(spark, log, "batch_id"), default=-1)
    if upto <= _snapshot(spark, snapshots)[0]:
        return None
    path = f"{snapshots.rstrip('/')}/snapshot={upto}"
    lg.live_messages(read_messages(spark, log, snapshots)).hint("rebalance").write.mode("overwrite").parquet(f"{path}/rows")
    fs, marker = cp._path(spark, f"{path}/{cp.MARKER}")
    fs.create(marker, True).close()
    return upto
