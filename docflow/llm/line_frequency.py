"""Quality rules from line frequencies across the documents of a host.

Lines are normalised and hashed; each host's hashes are counted over its documents; lines that
more than ``max_docs`` documents of the host carry are removed, and a document that loses more
than ``1 - min_kept`` of its line characters is rejected. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, table, words

MAX_DOCS = 10
MIN_KEPT = 0.5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def _normalised(text: Column) -> Column:
    """Lower-case A-Z, digits as 0, runs of blanks inside a line as one blank."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(plain, r"[\x20\x09\x0B-\x0D]+", " ")


def _lines(text: Column, host: Column) -> Column:
    """Per line with a word: ``h``, the hash of host and normalised line, and ``n``, its length."""
    lines = F.filter(F.transform(F.split(_normalised(text), "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    return F.transform(
        lines, lambda x: F.struct(F.xxhash64(host.isNull(), host, x).alias("h"), F.length(x).cast("long").alias("n"))
    )


def _repeat_words(w: Column) -> Column:
    """Words inside windows of five words that the text holds at least twice. Window hashes are
    compared first; only texts with equal ones sort them. Each repeated start adds as many
    words as lie before the next one, at most five."""
    last = F.size(w) - WINDOW

    def covered(starts: Column) -> Column:
        n = F.size(starts)
        return F.aggregate(
            F.sequence(F.lit(0), n - 1),
            F.lit(0).cast("long"),
            lambda acc, k: acc
            + F.when(k == n - 1, WINDOW).otherwise(F.least(F.lit(WINDOW), F.get(starts, k + 1) - F.get(starts, k))),
        )

    def repeated(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            order,
            lambda s: covered_of(
                F.transform(
                    F.filter(
                        s,
                        lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"]))
                        | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])),
                    ),
                    lambda x: x["i"],
                )
            ),
        )

    def covered_of(starts: Column) -> Column:
        return let(F.sort_array(starts), covered)

    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    )
    none = F.lit(0).cast("long")
    return F.when(last < 1, none).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(repeated(h)))
    )


def base_rules(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    t = F.coalesce(text, F.lit(""))
    per_words = let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    with_word = F.filter(F.split(t, "\n"), lambda x: F.translate(x, " \t\x0b\x0c\r", "") != "")
    dup = let(with_word, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    chars = F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long")
    symbols = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")
    return let(
        per_words,
        lambda p: F.struct(
            p["n"].alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            p["r"].alias("n_repeat_words"),
        ),
    )


def line_frequency(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = MAX_DOCS,
    min_kept: float = MIN_KEPT,
) -> DataFrame:
    """One row per input row: its key (``doc_id, host, text_hash``), ``n_line_chars``,
    ``n_removed_chars``, ``removed`` (the hashes of the lines to remove) and ``depleted``.

    A document is an id: its rows count once for a line, however many carry it and however often.
    Rows without an id are told apart by their texts. A null host is a host of its own. Null or blank texts have no lines and are not depleted. Rows that agree
    in id, host and text share one output row. Other columns are ignored, whatever their names.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        _lines(F.col(text), F.col(host).cast("string")).alias("lines"),
    )
    nameless = F.when(F.col("doc_id").isNull(), F.col("text_hash"))
    common = (
        rows.select("doc_id", nameless.alias("nameless"), F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
        .distinct()
        .groupBy("h")
        .count()
        .where(F.col("count") > max_docs)
        .select("h", F.lit(True).alias("common"))
    )
    lines = rows.select("doc_id", "host", "text_hash", F.inline("lines"))
    marked = lines.join(common, "h", "left")
    return (
        marked.groupBy("doc_id", "host", "text_hash")
        .agg(
            F.sum("n").alias("n_line_chars"),
            F.coalesce(F.sum(F.when(F.col("common"), F.col("n"))), F.lit(0)).alias("n_removed_chars"),
            F.collect_set(F.when(F.col("common"), F.col("h"))).alias("removed"),
        )
        .withColumn("depleted", F.col("n_removed_chars") > (1 - min_kept) * F.col("n_line_chars"))
    )


def _same(a: DataFrame, b: DataFrame) -> Column:
    keys = ["doc_id", "host", "text_hash"]
    cond = a[keys[0]].eqNullSafe(b[keys[0]])
    for k in keys[1:]:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def clean_lines(docs: DataFrame, **names) -> DataFrame:
    """The documents with their common lines removed (``text``) and without depleted ones; all
    columns of ``docs`` stay. Kept lines keep their spelling."""
    doc_id, text, host = (names.get(k, k if k != "host" else "source") for k in ("doc_id", "text", "host"))
    found = line_frequency(docs, **names).select("doc_id", "host", "text_hash", "removed", "depleted")
    key = F.struct(
        F.col(doc_id).alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
    )
    tagged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    cond = (
        tagged["key"]["doc_id"].eqNullSafe(found["doc_id"])
        & tagged["key"]["host"].eqNullSafe(found["host"])
        & (tagged["key"]["text_hash"] == found["text_hash"])
    )
    h = F.col("row")[host].cast("string")

    def line_hash(x: Column) -> Column:
        return F.xxhash64(h.isNull(), h, F.btrim(_normalised(x)))

    old = F.col("row")[text]
    new = F.when(F.coalesce(F.size("removed"), F.lit(0)) == 0, old).otherwise(
        F.array_join(
            F.filter(F.split(old, "\n"), lambda x: ~F.array_contains("removed", line_hash(x))),
            "\n",
        )
    )
    joined = tagged.join(found, cond, "left").where(~F.coalesce("depleted", F.lit(False)))
    return joined.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base figures and the verdict of the line frequencies."""
    docs = table(spark, sf_dir, "documents")
    base = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("host"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        base_rules(F.col("text")).alias("b"),
    )
    found = line_frequency(docs)
    failed = (F.col("b.n_words") < MIN_WORDS) | (
        100 * F.col("b.n_repeat_words") > MAX_REPEAT_PCT * F.col("b.n_words")
    )
    return base.join(found, _same(base, found), "left").select(
        base["doc_id"],
        "b.*",
        failed.alias("base_failed"),
        (~failed & ~F.coalesce("depleted", F.lit(False))).alias("kept"),
        F.coalesce("n_line_chars", F.lit(0)).alias("n_line_chars"),
        F.coalesce("n_removed_chars", F.lit(0)).alias("n_removed_chars"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM w),
winh AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS s FROM win),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM winh) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
rl AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS l FROM d),
dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM rl
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
nl AS (SELECT doc_id, source, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
       'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS l FROM rl),
common AS (SELECT source, l FROM nl WHERE l <> '' GROUP BY source, l HAVING count(DISTINCT doc_id) > 10),
lc AS (SELECT nl.doc_id, sum(length(nl.l)) AS n, coalesce(sum(length(common.l)), 0) AS r
       FROM nl LEFT JOIN common ON nl.source IS NOT DISTINCT FROM common.source AND nl.l = common.l
       WHERE nl.l <> '' GROUP BY nl.doc_id),
b AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
      coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
      coalesce(lc.n, 0)::BIGINT AS n_line_chars, coalesce(lc.r, 0)::BIGINT AS n_removed_chars
      FROM w LEFT JOIN dl USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_removed_chars > 0.5 * n_line_chars) AS kept,
       n_line_chars, n_removed_chars
FROM b
"""
