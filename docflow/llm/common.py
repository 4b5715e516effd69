"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators import bloom
from docflow.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The maximal runs of non-blank characters, in order; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return let(
        trimmed,
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"[\x20\x09-\x0D]+")),
    )


# Settings while a table is written: shuffle files go once it is done, and Python tasks get texts
# four megabytes at a time (rows without long texts are bounded by their number as before).
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: later steps neither
    recompute it nor depend on the executors that made it. The shuffle files of the write go once it
    is done (nothing reads them again), and Arrow batches are small."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {k: spark.conf.get(k) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    made = spark.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def discard(made: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, once the tables made from it are written too."""
    jvm, conf = made.sparkSession._jvm, made.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(made.stored_at)
    path.getFileSystem(conf).delete(path, True)


# A list of ids is broadcast up to this many (16 bytes each, and a hash table of like size).
MAX_BROADCAST_IDS = 1_000_000


def with_ids(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in ``ids`` (one stored column of that name), filtered before any
    shuffle where the counted list is small enough to broadcast. Beyond that the rows come back
    unfiltered: callers join them with the list's table anyway."""
    if ids.count() > MAX_BROADCAST_IDS:
        return rows
    return rows.join(F.broadcast(ids), key, "left_semi")


def split_by_hash(rows: DataFrame, key: str, hashes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose ``key`` (never null) may be among ``hashes``, a stored table with a column of
    that name, and the others. Up to ``MAX_BROADCAST_IDS`` counted hashes the rows are told apart
    before any shuffle; beyond that all come back as the first part, and callers join them anyway."""
    known = stored(hashes.select(key).distinct(), "hashes")
    if known.count() > MAX_BROADCAST_IDS:
        return rows, None
    known = F.broadcast(known)
    return rows.join(known, key, "left_semi"), rows.join(known, key, "left_anti")


def releasing(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``run`` for ``mapInPandas``. When a task ends, the memory that it has freed goes back to the
    system: Python workers stay beside the executor for the tasks of other steps."""

    def released(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from run(frames)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return released


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def drop_rows(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose id and text hash are in ``gone``, a stored table ``gone_id,
    gone_hash``; null ids are equal to each other.

    Texts stay where they are, at every size of the list: a Bloom filter of the list tells most rows
    apart; the keys alone of the others are joined with the list, which leaves those that the
    filter took for listed ones, and only these few are fetched by a join."""
    filt = bloom.build(gone, "gone_id", "gone_hash")
    filt.bits = stored(filt.bits, "bloom")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = docs.select(row.alias("row"), F.col(doc_id).alias("row_id"), text_hash(text).alias("row_hash"))
    columns = [F.col("row")[c].alias(c) for c in docs.columns]
    told = filt.split(tagged, "row_id", "row_hash")
    listed = F.col("row_id").eqNullSafe(F.col("gone_id")) & (F.col("row_hash") == F.col("gone_hash"))
    taken = filt.split(tagged.select("row_id", "row_hash"), "row_id", "row_hash").where("_maybe").select("row_id", "row_hash")
    spared = stored(taken.join(gone, listed, "left_anti").distinct().toDF("gone_id", "gone_hash"), "spared")
    left = told.where(~F.col("_maybe")).select(*columns)
    if spared.isEmpty():
        return left
    again = bloom.build(spared, "gone_id", "gone_hash").split(told.where("_maybe").drop("_maybe"), "row_id", "row_hash")
    return left.union(again.where("_maybe").join(spared, listed, "left_semi").select(*columns))
