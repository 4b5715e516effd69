"""Building the document universe.

The universe is every index row whose id is on an acceptable-id list, de-duplicated. One job:
scan all yearly index files at once, clean, semi-join the id list, drop duplicates, coerce the
year. The id list is left to AQE: it becomes a broadcast only when its measured size is small.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.text import strip_quotes, strip_text, trim_all_strings


def drop_ruler_rows(df: DataFrame, first_col: str | None = None) -> DataFrame:
    """Drop rows whose first column is only dashes; a null first column is kept."""
    c = F.col(first_col or df.columns[0])
    return df.where(~F.coalesce(c.rlike("^-+$"), F.lit(False)))


def clean_headers(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Strip header names (Python whitespace) and rename ``id`` to ``ack_id``."""
    renames = {"id": "ack_id"} if renames is None else renames
    names = [c.strip() for c in df.columns]
    names = [renames.get(n, n) for n in names]
    return df.toDF(*names)


def cast_year(df: DataFrame, col: str = "filing_year") -> DataFrame:
    """Strict integer cast (ANSI mode raises on a bad value, like the original)."""
    return df.withColumn(col, F.col(col).cast("int"))


def coerce_year(col: Column | str) -> Column:
    """Lenient integer cast, a bad value becomes null."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("int")


def filter_codes(df: DataFrame, code_col: str = "pension_benefit_code", pattern: str = C.CODE_PATTERN) -> DataFrame:
    """Keep rows whose code matches ``pattern`` (null never matches). When the list has no
    code column every id is kept, with a warning."""
    if code_col not in df.columns:
        warnings.warn(f"no {code_col} column: keeping every id", stacklevel=2)
        return df
    return df.where(F.coalesce(F.col(code_col).rlike(pattern), F.lit(False)))


def filter_year(df: DataFrame, year: int, col: str = "filing_year") -> DataFrame:
    """Rows of one year (a partition filter on a year-partitioned table)."""
    return df.where(F.col(col) == year)


def filter_year_range(df: DataFrame, lo: int, hi: int, col: str = "filing_year") -> DataFrame:
    """Inclusive year range, the argument form of every range job."""
    return df.where(F.col(col).between(lo, hi))


def distinct_ids(df: DataFrame, col: str = "ack_id") -> DataFrame:
    """A1: unique trimmed ids of a list, nulls dropped (D3: a missing id never becomes 'nan')."""
    ids = strip_text(F.col(col).cast("string"))
    return df.select(ids.alias("ack_id")).where(F.col("ack_id").isNotNull()).distinct()


def dedupe_rows(df: DataFrame) -> DataFrame:
    """A2: full-row distinct."""
    return df.dropDuplicates()


def filter_counts(df: DataFrame, code_col: str = "pension_benefit_code", pattern: str = C.CODE_PATTERN,
                  id_col: str = "ack_id") -> DataFrame:
    """A3: rows, rows passing the code filter and unique kept ids - one pass."""
    keep = F.coalesce(F.col(code_col).rlike(pattern), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(keep).alias("n_kept"),
        F.count_distinct(F.when(keep, F.col(id_col))).alias("n_unique_ids"),
    )


def all_valid(df: DataFrame, col: str = "filing_year") -> DataFrame:
    """A4: is the column filled in on every row (an empty table counts as valid)."""
    ok = F.col(col).isNotNull() & (strip_text(F.col(col).cast("string")) != "")
    return df.agg(F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_valid"))


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate per-year frames by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_ids(lists: Iterable[DataFrame], col: str = "ack_id") -> DataFrame:
    """Set union of several id lists: one distinct over the concatenation (partial
    aggregation removes duplicates map-side), not one per list."""
    parts = [df.select(strip_text(F.col(col).cast("string")).alias("ack_id")) for df in lists]
    return reduce(lambda a, b: a.union(b), parts).where(F.col("ack_id").isNotNull()).distinct()


def semi_universe(index: DataFrame, ids: DataFrame, col: str = "ack_id") -> DataFrame:
    """Index rows whose id is acceptable (left semi join)."""
    return index.join(ids.select(F.col(col).alias("ack_id")), "ack_id", "left_semi")


def clean_cells(df: DataFrame) -> DataFrame:
    """P3, P5, P6 in the original order: year cast, trim, quotes."""
    if "filing_year" in df.columns:
        df = cast_year(df)
    df = trim_all_strings(df)
    if "sponsor_name" in df.columns:
        df = df.withColumn("sponsor_name", strip_quotes("sponsor_name"))
    return df


def clean_index(df: DataFrame) -> DataFrame:
    """P1, P2 and ``clean_cells`` in the original order, for one file's frame."""
    return clean_cells(clean_headers(drop_ruler_rows(df)))


def build_universe(index_rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The universe: acceptable ids only, full-row de-duplication, lenient year."""
    u = dedupe_rows(semi_universe(index_rows, ids))
    return u.withColumn("filing_year", coerce_year("filing_year"))
