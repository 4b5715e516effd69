"""Token path parsing (F9, F11, P10-P13): pure Column expressions over path strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def normalize_separators(path: Column | str) -> Column:
    """Windows separators become '/'."""
    return F.replace(_c(path), F.lit("\\"), F.lit("/"))


def _parts(path: Column | str) -> Column:
    return F.split(normalize_separators(path), "/")


def name(path: Column | str) -> Column:
    """last path component."""
    return F.element_at(_parts(path), -1)


def parent_name(path: Column | str) -> Column:
    """name of the parent folder (null when there is none)."""
    return F.try_element_at(_parts(path), F.lit(-2))


def grandparent_name(path: Column | str) -> Column:
    return F.try_element_at(_parts(path), F.lit(-3))


def stem(path: Column | str) -> Column:
    """file name without its last suffix; a leading dot or a trailing dot is not a suffix."""
    n = name(path)
    s = F.regexp_extract(n, r"^(.+)\.[^.]+$", 1)
    return F.when(s == "", n).otherwise(s)


def suffix(path: Column | str) -> Column:
    """the last suffix including its dot, '' when none."""
    n = name(path)
    return F.regexp_extract(n, r"^.+(\.[^.]+)$", 1)


def is_year_name(col: Column | str) -> Column:
    """exactly four ASCII digits."""
    return F.coalesce(_c(col).rlike("^[0-9]{4}$"), F.lit(False))


def parse_status_path(df: DataFrame, path: str = "path") -> DataFrame:
    """P10: root/status/year/filename from the right; id = filename minus its last dot-suffix;
    lenient year (bad -> null); only rows with a valid year are kept."""
    parts = _parts(path)
    filename = F.try_element_at(parts, F.lit(-1))
    out = df.select(
        F.regexp_replace(filename, r"\.[^.]+$", "").alias("ack_id"),
        F.expr(f"try_cast(try_element_at(split(replace(`{path}`, '\\\\', '/'), '/'), -2) as int)").alias("year"),
        F.try_element_at(parts, F.lit(-3)).alias("status"),
        F.col(path).alias("path"),
        *[F.col(c) for c in df.columns if c not in ("path", "ack_id", "year", "status")],
    )
    return out.where(F.col("year").isNotNull() & (F.size(parts) >= 4))


def parse_token_path(df: DataFrame, path: str = "path") -> DataFrame:
    """(ack_id, year) as strings from the token's stem and parent folder."""
    return df.select(stem(path).alias("ack_id"), parent_name(path).alias("year"), F.col(path).alias("path"))


def skip_in_progress(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Ignore tokens being claimed (``.claiming.`` in the name)."""
    return df.where(~F.col(name_col).contains(".claiming."))


def clean_token_names(df: DataFrame, folder: str = "folder", name_col: str = "name") -> DataFrame:
    """Names with text after the first '.txt' are cut back to '<x>.txt'. A name is left
    alone when the clean name already exists in the folder; when several names map to the same
    missing clean name, the first by name order takes it (the original order is arbitrary).
    Windows are per (folder, clean name): groups of a few names each."""
    n = F.col(name_col)
    has_txt = n.contains(".txt")
    clean = F.when(has_txt, F.concat(F.substring_index(n, ".txt", 1), F.lit(".txt"))).otherwise(n)
    g = Window.partitionBy(folder, "_clean")
    ranked = df.select(folder, name_col).distinct().withColumn("_clean", clean)
    exists = F.max((F.col(name_col) == F.col("_clean")).cast("int")).over(g) == 1
    first = F.row_number().over(g.orderBy(name_col)) == 1
    renamed = (F.col(name_col) != F.col("_clean")) & ~exists & first
    return ranked.select(
        folder, name_col, F.when(renamed, F.col("_clean")).otherwise(F.col(name_col)).alias("new_name")
    )
