"""Registered queries for the scalar text functions.

The test prose is already NFKC-stable, has no CR and no surrounding blanks, so each query
perturbs its input in a way whose expected result the SQL twin states independently."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import text as tx
from docflow.plans import bindings as B
from docflow.plans.registry import register, sql_trim

_CRLF_SQL = "replace(text, '. ', '.' || chr(10))"


def _docs(spark, d):
    return B.table(spark, d, "documents").select("doc_id", "text")


def _crlf(c):
    """'. ' becomes '.\\r\\n' on even ids and '.\\r' on odd ids."""
    return F.when(F.col("doc_id") % 2 == 0, F.replace(c, F.lit(". "), F.lit(".\r\n"))).otherwise(
        F.replace(c, F.lit(". "), F.lit(".\r")))


@register("lower", "select doc_id, lower(text) as text from documents")
def lower(spark, d):
    return _docs(spark, d).select("doc_id", tx.lower("text").alias("text"))


@register("alnum_fold", "select doc_id, regexp_replace(lower(text), '[^a-z0-9() ]', '', 'g') as text from documents")
def alnum_fold(spark, d):
    return _docs(spark, d).select("doc_id", tx.alnum_fold(tx.lower("text")).alias("text"))


@register("nfkc", "select doc_id, 'fi1' || text as text from documents")
def nfkc(spark, d):
    """a ligature and a circled digit in front of every text."""
    return _docs(spark, d).select("doc_id", tx.nfkc(F.concat(F.lit("ﬁ①"), F.col("text"))).alias("text"))


@register("drop_bad_utf8", "select doc_id, text from documents")
def drop_bad_utf8(spark, d):
    """a stray 0xFF byte after every text (a string cast from bytes) is dropped."""
    broken = F.concat(F.encode(F.col("text"), "UTF-8"), F.unhex(F.lit("FF"))).cast("string")
    return _docs(spark, d).select("doc_id", tx.drop_bad_utf8(broken).alias("text"))


@register("unify_newlines", f"select doc_id, {_CRLF_SQL} as text from documents")
def unify_newlines(spark, d):
    return _docs(spark, d).select("doc_id", tx.unify_newlines(_crlf(F.col("text"))).alias("text"))


_WRAP_SQL = "chr(160) || chr(9) || chr(12288) || {x} || ' ' || chr(28) || chr(10)"


def _wrap(c):
    return F.concat(F.lit(" \t　"), c, F.lit(" \u001c\n"))


@register("strip_text", f"select doc_id, {sql_trim(_WRAP_SQL.format(x='text'))} as text from documents")
def strip_text(spark, d):
    return _docs(spark, d).select("doc_id", tx.strip_text(_wrap(F.col("text"))).alias("text"))


@register("normalize_text", f"select doc_id, {sql_trim(chr(39) + 'fi' + chr(39) + ' || ' + _CRLF_SQL)} as text from documents")
def normalize_text(spark, d):
    """blanks around, a ligature in front, CR line ends inside."""
    x = _wrap(F.concat(F.lit("ﬁ"), _crlf(F.col("text"))))
    return _docs(spark, d).select("doc_id", tx.normalize_text(x).alias("text"))


@register(
    "repair_mojibake",
    "select doc_id, 'é' || regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') as text from documents",
)
def repair_mojibake(spark, d):
    """F8: a double-encoded 'é' in front is repaired; other non-ASCII letters are dropped."""
    return _docs(spark, d).select("doc_id", tx.repair_mojibake(F.concat(F.lit("Ã©"), F.col("text"))).alias("text"))


@register("preview_text", "select doc_id, substring(text, 1, 500) as preview from documents")
def preview_text(spark, d):
    return _docs(spark, d).select("doc_id", tx.preview_text("text").alias("preview"))
