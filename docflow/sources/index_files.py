"""Yearly '|'-delimited index files.

Format: 3 physical preamble lines, then the first non-blank line is the header, blank lines are
ignored, quotes are ordinary characters and ``\\`` escapes the next character (so ``\\|`` is a
literal bar). Lines with more fields than the header are quarantined; shorter lines are padded
with nulls. Cells equal to an NA token become null before any trimming.

Spark's CSV reader cannot do this (with quoting off it still splits an escaped delimiter, and
it takes the column count from the first preamble line), so the files are read with the text
source, which splits large files. One scan writes the lines, each with its place (start of its
split, position in it), to the shared scratch folder; headers and rows are both taken from that
table, so places cannot change between jobs, whatever the number of executors or the split size.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.text import null_tokens, strip_text
from docflow.operators.universe import clean_cells
from docflow.session import scratch_path

_FIELD = r"\|((?:[^|\\]|\\.)*)"
_UNESCAPE = r"\\(.)"
# an odd number of trailing backslashes escapes the line end: not a complete line
_DANGLING = r"(^|[^\\])(\\\\)*\\$"


class IndexScan(NamedTuple):
    rows: DataFrame  # cleaned index rows (header columns, id -> ack_id, filing_year int)
    raw: DataFrame  # string cells as they are (names stripped, id -> ack_id), ruler rows too, plus _file
    bad_lines: DataFrame  # (_file, line, n_fields, n_header)
    no_header: DataFrame  # (_file): files with lines but without a header


def split_fields(line):
    """Escape-aware split of one line on '|'."""
    return F.transform(
        F.regexp_extract_all(F.concat(F.lit("|"), line), F.lit(_FIELD), 1),
        lambda f: F.regexp_replace(f, _UNESCAPE, "$1"),
    )


def _blank(col):
    return strip_text(col) == ""


_RULER = "^-+$"


def _stored_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``_file, _place, value`` of every line, written once. Places order the lines of a file: splits
    by their start, lines of a split by the ids that the writing task gave them."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths).select(
        F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("_place"),
        "value",
    )
    path = scratch_path(spark, "index_lines")
    lines.write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def _headers(lines: DataFrame, preamble: int) -> DataFrame:
    """``_file, _header, _at`` of every file: its first non-blank line after the preamble."""
    place = lines.select("_file", "_place")
    # planned as a limit per file and task before the shuffle
    top = place.withColumn("_n", F.row_number().over(Window.partitionBy("_file").orderBy("_place"))).where(F.col("_n") <= preamble)
    ends = top.groupBy("_file").agg(F.max("_place").alias("_end"))
    after = lines.where(~_blank(F.col("value"))).join(ends, "_file", "left")
    after = after.where(F.col("_end").isNull() | (F.col("_place") > F.col("_end")))
    return after.groupBy("_file").agg(F.min_by("value", "_place").alias("_header"), F.min("_place").alias("_at"))


def read_index(spark: SparkSession, paths: str | list[str], preamble: int = C.INDEX_PREAMBLE_LINES,
               na_tokens=C.NA_TOKENS, clean: bool = True) -> IndexScan:
    """S1 + S2 + S3 over every index file under ``paths`` (files or folders, recursive).

    The columns are the union of all files' names, so the distinct header lines - one per layout,
    not one per file - come to the driver. Without any header the columns are ``ack_id`` and
    ``filing_year`` and there are no rows."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _stored_lines(spark, paths)
    where = scratch_path(spark, "index_headers")
    _headers(lines, preamble).write.parquet(where)
    headers = spark.read.parquet(where)
    layouts = {r["_header"]: _header_names(r["_header"]) for r in headers.select("_header").distinct().collect()}
    all_names = list(dict.fromkeys(n for names in layouts.values() for n in names)) or ["ack_id", "filing_year"]
    named_layouts = spark.createDataFrame(list(layouts.items()), "_header string, _names array<string>")
    tops = headers.join(F.broadcast(named_layouts), "_header").select(F.col("_file"), "_at", "_names")
    data = (
        lines.join(tops, "_file")
        .where(F.col("_place") > F.col("_at"))
        .where(~_blank(F.col("value")))
        .select("_file", "_names", F.col("value").alias("line"), split_fields(F.col("value")).alias("_fields"),
                F.col("value").rlike(_DANGLING).alias("_dangling"))
    )
    too_many = (F.size("_fields") > F.size("_names")) | F.col("_dangling")
    bad = data.where(too_many).select("_file", "line", F.size("_fields").alias("n_fields"),
                                      F.size("_names").alias("n_header"))
    good = data.where(~too_many)

    def cells(df: DataFrame) -> DataFrame:
        # name -> cell of the line (missing trailing cells are null); columns a file lacks are null
        named = df.select(
            "_file", F.map_from_arrays("_names", F.transform("_names", lambda _, i: F.get(F.col("_fields"), i))).alias("_m"))
        return named.select(*[null_tokens(F.try_element_at("_m", F.lit(n)), na_tokens).alias(n) for n in all_names], "_file")

    raw = cells(good)
    # a ruler is a line whose own first cell is dashes, whatever column that is in the union
    rows = clean_cells(cells(good.where(~F.get("_fields", F.lit(0)).rlike(_RULER))).drop("_file")) if clean else raw
    no_header = lines.select("_file").distinct().join(headers, "_file", "left_anti")
    return IndexScan(rows, raw, bad, no_header)


def _header_names(header: str) -> list[str]:
    """Names of one header line: unescaped, stripped, ``id`` renamed, repeated names numbered
    (a, a.1, a.2 ...) past suffixes that are taken."""
    fields = re.findall(_FIELD, "|" + header)
    names = [re.sub(_UNESCAPE, r"\1", f).strip() for f in fields]
    names = ["ack_id" if n == "id" else n for n in names]
    seen: dict[str, int] = {}
    out: list[str] = []
    for n in names:
        k = seen.get(n, 0)
        cand = n if k == 0 else f"{n}.{k}"
        while cand in out:
            k += 1
            cand = f"{n}.{k}"
        seen[n] = k + 1
        out.append(cand)
    return out


def scan_index(spark: SparkSession, paths, **kw) -> DataFrame:
    """Cleaned index rows of every file under ``paths``."""
    return read_index(spark, paths, **kw).rows


def quarantine_bad_lines(spark: SparkSession, paths, **kw) -> DataFrame:
    """Lines with more fields than their file's header (or a dangling escape)."""
    return read_index(spark, paths, **kw).bad_lines


def write_index_files(df: DataFrame, path: str, year: str = "filing_year", bucket: str = "bucket",
                      header: list[str] | None = None, preamble: list[str] | None = None,
                      bad_line: bool = True, long_lines: bool = False) -> str:
    """Write rows in the index-file format: one file per (year, bucket), each with its own
    preamble, header and ruler row; '|' and '\\' in cells are escaped, nulls written empty,
    line breaks inside cells become blanks. ``long_lines`` adds one line with too many fields for
    each row, made of its cells. Used to materialise test inputs."""
    cols = header or [c for c in df.columns if c != bucket]
    preamble = preamble or ["Index of filings", "", "exported listing"]

    def esc(c):
        v = F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\r\n]", " ")
        return F.regexp_replace(v, r"([|\\])", r"\\$1")

    head = " | ".join(("id" if c == "ack_id" else c) for c in cols)
    ruler = "|".join("-" * max(3, len(c)) for c in cols)
    body = df.select(F.col(year).alias("y"), F.col(bucket).alias("b"), F.lit(1 << 20).alias("_o"),
                     F.concat_ws("|", *[esc(c) for c in cols]).alias("value"))
    groups = df.select(F.col(year).alias("y"), F.col(bucket).alias("b")).distinct()
    fixed = preamble + ["", head, ruler]
    if bad_line:
        fixed = fixed + ["extra|" + "|".join(["x"] * len(cols))]
    top = groups.select("y", "b", F.posexplode(F.array(*[F.lit(x) for x in fixed])).alias("_o", "value"))
    out = top.unionByName(body)
    if long_lines:
        again = F.concat_ws("|", *[esc(c) for c in cols], F.lit("x"))
        out = out.unionByName(df.select(F.col(year).alias("y"), F.col(bucket).alias("b"), F.lit(1 << 21).alias("_o"), again.alias("value")))
    (
        out.repartition("y", "b")
        .sortWithinPartitions("y", "b", "_o")
        .drop("_o")
        .write.mode("overwrite")
        .partitionBy("y", "b")
        .text(path)
    )
    return path
