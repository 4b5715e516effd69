"""Incremental processing with Structured Streaming.

The original workers loop: take up to n queued items, process them, repeat until the queue is
empty. Here the queue is a folder of document files. A run lists what has arrived and appends it to a
table beside the checkpoint, n paths a file; the stream reads this table one file at a time, so that Spark's
source, which keeps every file it has seen in the driver's memory, sees few of them.
``trigger(availableNow=True)`` drains what is there in bounded batches and stops, and a rerun picks up
only new files (each file once).

Sinks are idempotent per micro-batch: ``foreachBatch`` is at-least-once, so every batch writes
its own ``batch_id`` partition with dynamic partition overwrite; a retried batch replaces its
own output instead of adding rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.operators.pages import route_documents
from docflow.session import cores, shuffles_go
from docflow.sources.documents import document_keys, extract_pages_native, list_files, read_content

# Documents a core in one micro-batch: what a micro-batch costs whatever its size (offset and commit logs,
# listing, planning, output commit) is seconds, so the original's claim of 20 would spend hours on it.
DOCS_PER_CORE = 1000
DOC_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
ARRIVED_SCHEMA = "path string, modified long"


def _stored(read) -> DataFrame | None:
    """What ``read`` returns; none if there is no such folder."""
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def arrivals(spark: SparkSession, doc_root: str, checkpoint: str, batch_files: int | None):
    """The stream of paths (``path``) under ``doc_root``, each once, in micro-batches of ``batch_files``, oldest
    first, or all in one. What is new since the last call is appended to a table under ``checkpoint``; a call that
    fails before its stream is done leaves its paths there for the next one. A checkpoint that was begun with the document
    files as Spark's source goes on with them: its log is of no use to another source."""
    checkpoint = checkpoint.rstrip("/")
    arrived = f"{checkpoint}/arrived"
    listed = _stored(lambda: spark.read.schema(ARRIVED_SCHEMA).parquet(arrived))
    if listed is None and _stored(lambda: spark.read.text(f"{checkpoint}/sources/0")) is not None:
        reader = spark.readStream.format("binaryFile").schema(DOC_FILE_SCHEMA).option("recursiveFileLookup", "true")
        if batch_files:
            reader = reader.option("maxFilesPerTrigger", batch_files)
        return reader.load(doc_root).select("path")
    new = list_files(spark, doc_root).select("path", "modified")
    if listed is not None:
        new = new.join(listed, "path", "left_anti")
    if listed is None or not new.isEmpty():
        if batch_files:  # one task writes file after file: paths only, in order, each file full
            new = new.orderBy("modified", "path").coalesce(1)
        new.write.mode("append").option("maxRecordsPerFile", batch_files or 0).parquet(arrived)
    reader = spark.readStream.schema(ARRIVED_SCHEMA)
    if batch_files:
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.parquet(arrived).select("path")


def process_batch(batch: DataFrame, batch_id: int, out: str, terms: Sequence[str], n: int, limit_pages: int,
                  text_sep: str = "\f", tasks: int | None = None) -> None:
    """Route one micro-batch of files (``path``) and write it under status=<outcome>/batch_id=<id>."""
    tasks = tasks or 2 * cores(batch.sparkSession)
    docs = batch.select(*document_keys(), "path").repartition(tasks, F.xxhash64("path"))
    ps = extract_pages_native(read_content(docs, errors=None))
    routed = route_documents(ps, terms=terms, n=n, limit_pages=limit_pages, error="error", sep=text_sep)
    # one file of an outcome a batch, or few: a reader of the whole output lists them all
    routed = routed.hint("rebalance", "status")
    with shuffles_go(batch.sparkSession):
        (
            routed.select("ack_id", "year", "page_no", "n_pages", "text", "status", F.lit(batch_id).alias("batch_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("status", "batch_id")
            .parquet(out)
        )


def stream_documents(spark: SparkSession, doc_root: str, out: str, checkpoint: str,
                     terms: Sequence[str] = C.TERMS, batch_files: int | None = None,
                     n: int = C.NUMBER_PAGES_TO_SAVE, limit_pages: int = C.PAGE_LIMIT):
    """T1 + T3: drain the document folder in batches of ``batch_files`` files, route every
    document exactly once. Returns the finished StreamingQuery (its progress lists the batches).

    A micro-batch runs on every core of the cluster, so the default batch is ``DOCS_PER_CORE`` documents
    times the session's parallelism."""
    if batch_files is None:
        batch_files = DOCS_PER_CORE * cores(spark)
    tasks = max(2 * cores(spark), -(-batch_files // DOCS_PER_CORE))
    q = (
        arrivals(spark, doc_root, checkpoint, batch_files)
        .writeStream.foreachBatch(lambda b, i: process_batch(b, i, out, terms, n, limit_pages, tasks=tasks))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def read_routed(spark: SparkSession, out: str) -> DataFrame:
    """Routed documents written by ``stream_documents`` (status and batch_id from the folders)."""
    return spark.read.parquet(out)


LEDGER_SCHEMA = "ack_id string, year int, status string, ts timestamp, seq long, message string, overwrite_ boolean"


def stream_ledger(spark: SparkSession, ledger_root: str, out: str, checkpoint: str, batch_files: int | None = None):
    """Maintain the current status per document from a stream of transition files
    (``batch_files`` caps the files per micro-batch; by default a backlog is one batch).

    ``max_by(status, (ts, seq))`` is order-insensitive, so late or out-of-order transitions are
    harmless, and the state holds one row per document. Each micro-batch appends the updated
    keys with its ``batch_id`` (a changelog); ``read_current`` takes the latest per key."""
    reader = spark.readStream.schema(LEDGER_SCHEMA)
    if batch_files:
        reader = reader.option("maxFilesPerTrigger", batch_files)
    stream = reader.parquet(ledger_root)
    k = F.struct("ts", "seq")
    current = stream.groupBy("ack_id", "year").agg(F.max_by("status", k).alias("status"), F.max(k).alias("k"))

    def sink(batch: DataFrame, batch_id: int):
        (
            batch.select("ack_id", "year", "status", F.col("k.ts").alias("ts"), F.col("k.seq").alias("seq"),
                         F.lit(batch_id).alias("batch_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out)
        )

    q = (
        current.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def read_current(spark: SparkSession, out: str) -> DataFrame:
    """Current status per document from the changelog written by ``stream_ledger``."""
    log = spark.read.parquet(out)
    return log.groupBy("ack_id", "year").agg(F.max_by("status", F.col("batch_id")).alias("status"))
