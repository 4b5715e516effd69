"""Table sources and sinks.

Parquet is the default format: it keeps '' apart from null and texts with newlines and quotes
intact, and it dictionary-encodes the status column. CSV is available with options that make
texts survive a round trip (quote everything, '"' escapes, no whitespace trimming, multi-line
records on read); CSV still reads '' back as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.text import strip_text
from docflow.operators.universe import distinct_ids, filter_codes, filter_counts

CSV_WRITE = {"header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {"header": "true", "multiLine": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false"}


def _reader(spark: SparkSession, fmt: str):
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.options(**CSV_READ)
    return r


def _write(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str] = (), mode: str = "overwrite"):
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(**CSV_WRITE)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A table that this module wrote; with a ``schema`` an empty one needs no files and CSV cells
    get their types."""
    r = _reader(spark, fmt)
    return (r.schema(schema) if schema is not None else r).load(path)


# ---- S4 -------------------------------------------------------------------------------------
def read_id_list(spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "ack_id",
                 code_col: str | None = "pension_benefit_code", pattern: str = C.CODE_PATTERN) -> DataFrame:
    """S4 + P7 + A1: the acceptable ids of one list. Only the id (and code) columns are read;
    if the list has a code column only matching ids are kept, otherwise all of them (D7: only a
    missing column - not any read error - switches to keep-all)."""
    df = _reader(spark, fmt).load(path)
    cols = [id_col] + ([code_col] if code_col and code_col in df.columns else [])
    df = df.select(*cols)
    if code_col:
        df = filter_codes(df, code_col, pattern)
    return distinct_ids(df, id_col)


def count_id_list(spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "ack_id",
                  code_col: str | None = "pension_benefit_code", pattern: str = C.CODE_PATTERN) -> DataFrame:
    """A3 for the list that ``read_id_list`` reads: rows, rows kept and unique trimmed ids of these."""
    df = _reader(spark, fmt).load(path)
    ids = strip_text(F.col(id_col).cast("string")).alias("ack_id")
    if code_col and code_col in df.columns:
        return filter_counts(df.select(ids, F.col(code_col).alias("_code")), "_code", pattern)
    return filter_counts(df.select(ids, F.lit("").alias("_code")), "_code", "")  # keeps every row


# ---- K1 / K2 / S5 ---------------------------------------------------------------------------
def write_universe(universe: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K1: the whole universe as one table."""
    return _write(universe, path, fmt)


def write_by_year(universe: DataFrame, path: str, fmt: str = "parquet", year: str = "filing_year",
                  partitions: int | None = None) -> str:
    """K2: one folder per filing year (split by the column, not by the source file).

    Rows go to tasks by year with a ``REBALANCE`` hint: adaptive execution cuts a year that
    holds a large share of the rows into partitions of the advisory size (by measured shuffle
    bytes, no extra pass) and packs small years together, so each task writes few, well-sized
    files. With ``partitions`` the rows are range-partitioned on (year, hash of the id) instead
    (sampled bounds; also for sessions without adaptive execution).
    A null year lands in the default partition; the original only writes it to the whole table."""
    if partitions:
        spread = universe.repartitionByRange(partitions, F.col(year), F.xxhash64("ack_id"))
    else:
        spread = universe.hint("rebalance", year)
    return _write(spread, path, fmt, [year])


def scan_universe(spark: SparkSession, path: str, year: int | None = None, fmt: str = "parquet",
                  col: str = "filing_year") -> DataFrame:
    """A year of the universe (partition pruning), ack_id as string, full-row de-duplicated.
    Callers that look the same year up repeatedly should ``cache()`` the result."""
    df = _reader(spark, fmt).load(path)
    if year is not None:
        df = df.where(F.col(col) == year)
    return df.withColumn("ack_id", F.col("ack_id").cast("string")).dropDuplicates()


# ---- K3 / K4 / S10 / K5 ---------------------------------------------------------------------
def write_records(records: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K3: records (ack_id, year, status, path) partitioned by year. Rows usually come out of a
    per-document aggregation (every task holds every year), so they are rebalanced by year
    first: files of the advisory size, a hot year split by measured bytes."""
    return _write(records.hint("rebalance", "year"), path, fmt, ["year"])


def write_year_text(texts: DataFrame, path: str, fmt: str = "parquet") -> str:
    """K4: records with their text, partitioned by year (rebalanced by year, as K3)."""
    return _write(texts.hint("rebalance", "year"), path, fmt, ["year"])


def scan_year_results(spark: SparkSession, path: str, fmt: str = "parquet",
                      glob: str | None = None, columns: Sequence[str] = ("ack_id", "year", C.OCR_TEXT_COL)) -> DataFrame:
    """All per-year result files under ``path``, three columns. ``glob`` filters file names
    (the original layout is ``*[0-9][0-9][0-9][0-9].csv``)."""
    r = _reader(spark, fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(*columns)


def write_corpora(train: DataFrame, full: DataFrame, train_path: str, full_path: str,
                  fmt: str = "parquet", shuffle_full: bool = True) -> dict[str, str | None]:
    """K5: write the training and the full corpus; an empty corpus is reported, not written.
    The full corpus is written in its seeded shuffle order (a range-partitioned sort), so every
    output file is a representative chunk. Build both from a written text table (K4) so the
    emptiness checks and writes do not recompute the extraction."""
    from docflow.operators.outputs import stable_shuffle

    out: dict[str, str | None] = {}
    for name, df, path in (("full", full, full_path), ("train", train, train_path)):
        if df.isEmpty():
            print(f"No rows for the {name} corpus: nothing written.")
            out[name] = None
            continue
        if name == "full" and shuffle_full:
            df = stable_shuffle(df).drop("shuffle_key")
        out[name] = _write(df, path, fmt)
    return out
