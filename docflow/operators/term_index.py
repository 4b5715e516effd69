"""J7 for term tables of any size: a scan that looks every place of a page up in the terms, or an inverted
index of q-grams.

A page contains a term when its folded text contains the folded term (deleting characters keeps
containment, so the folded check covers the plain one).

Terms of at most ``SCANNED_BYTES`` in all go to every task (``term_scan``): pages are read once, and what a page costs
depends on its length, not on the terms that it nearly holds.

More terms than that are joined by an index. Pages are cut into blocks of q characters, end to
end. A term of 2q - 1 characters or more covers a whole block wherever it stands, and that block is one of
any q grams in a row of the term; the term is filed under the q grams in a row that are rarest on the
pages. Pages and postings meet in an equi-join of blocks. A block brings the text around it, as far as a
term of its size can reach, and ``contains`` decides on this window within the join: what is
written is one row for each page that holds a term, not one for each pair that shares a block. Only terms
longer than ``PROBE`` go on to the whole page, those of which ``PROBE`` characters were found.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions import text as tx
from docflow.operators import bloom
from docflow.operators.term_scan import END, TermScan
from docflow.session import scratch_path

# Block sizes: a term uses the largest that it covers at every place.
SIZES = (1, 2, 3, 4, 6, 8)
# Rarity is estimated on every 16th page, by a hash of its text. It decides which grams a term is filed
# under, never a result.
RARITY_SHARE = 16
# Folded terms that tasks hold, with TERM_BYTES for each term: over a million terms of 16 characters.
SCANNED_BYTES = 48 << 20
TERM_BYTES = 24
# Characters of a term that are looked for around a block; a longer term is met by this much of it.
PROBE = 40


def folded(text: Column) -> Column:
    return tx.alnum_fold(F.lower(text))


def block_size(length: Column) -> Column:
    out = F.lit(0)
    for s in SIZES:
        out = F.when(length >= 2 * s - 1, F.lit(s)).otherwise(out)
    return out


def page_blocks(value: Column, sizes: list[int]) -> Column:
    """Hashes of the distinct blocks of a folded text, for each size in use."""

    def cut(v: Column) -> Column:
        parts = [F.regexp_extract_all(v, F.lit(f".{{{s}}}"), F.lit(0)) for s in sizes]
        return F.array_distinct(F.transform(F.concat(*parts) if len(parts) > 1 else parts[0], lambda b: F.xxhash64(b)))

    return tx.let(value, cut) if len(sizes) > 1 else cut(value)  # bound once: the text is folded once


def _widest(size: int, longest: int) -> int:
    """Length of the longest probe of terms with blocks of ``size``, ``longest`` being the longest term."""
    larger = [s for s in SIZES if s > size]
    return min(PROBE, longest, 2 * larger[0] - 2 if larger else longest)


def page_windows(value: Column, sizes: list[int], longest: int) -> Column:
    """``gram, around`` for the blocks of a folded text: the block's hash and the text that a probe holding
    the block may cover. ``#``, which no folded text holds, stands before its begin and after its end."""

    def of_size(v: Column, s: int) -> Column:
        before = _widest(s, longest) - s
        pad = F.lit("#" * before)
        around = F.regexp_extract_all(F.concat(pad, v, pad), F.lit(f"(?=(.{{{2 * before + s}}})).{{{s}}}"), F.lit(1))
        return F.transform(F.array_distinct(around), lambda w: F.struct(
            F.xxhash64(F.substring(w, before + 1, s)).alias("gram"), w.alias("around")))

    def cut(v: Column) -> Column:
        parts = [of_size(v, s) for s in sizes]
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    return tx.let(value, cut) if len(sizes) > 1 else cut(value)


def file_terms(terms: DataFrame, sample: DataFrame, sizes: list[int]) -> DataFrame:
    """Postings ``gram, probe, folded_term``: each distinct folded term under the hashes of its rarest grams
    in a row, with at most ``PROBE`` of its characters that hold these grams. ``sample`` holds the texts ``_fold`` that tell rarity."""
    size = block_size(F.length("folded_term"))
    at = F.sequence(F.lit(1), F.length("folded_term") - size + 1)
    held = terms.select("folded_term", size.alias("size"), F.posexplode(F.transform(at, lambda i: F.xxhash64(F.substring("folded_term", i, size)))).alias("at", "gram"))
    # explode_outer: no second evaluation of the array in an inferred filter
    seen = sample.select(F.explode_outer(page_blocks(F.col("_fold"), sizes)).alias("gram"))
    # only grams of terms are counted; the rest stops before the shuffle
    counts = bloom.build(held, "gram").split(seen, "gram").where("_maybe").groupBy("gram").agg(F.count("*").alias("n"))
    known = held.join(counts, "gram", "left").groupBy("folded_term", "size").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("grams")
    )

    def total(j: Column) -> Column:
        return F.aggregate(F.slice("grams", j, F.col("size")), F.lit(0).cast("long"), lambda acc, g: acc + g["n"])

    starts = F.sequence(F.lit(1), F.size("grams") - F.col("size") + 1)
    best = F.array_min(F.transform(starts, lambda j: F.struct(total(j).alias("n"), j.alias("j"))))
    chosen = known.select("folded_term", "size", "grams", best["j"].alias("j"))
    probe = F.substring("folded_term", F.greatest(F.least(F.col("j"), F.length("folded_term") - (PROBE - 1)), F.lit(1)), F.lit(PROBE))
    return chosen.select("folded_term", probe.alias("probe"), F.explode(F.array_distinct(F.transform(F.slice("grams", F.col("j"), F.col("size")), lambda g: g["gram"]))).alias("gram"))


def scan_pages(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``_h1, _h2`` of the rows of ``texts`` (``_h1, _h2, _fold``) whose folded text holds a term."""
    scan = TermScan([t.encode() for t in terms.select("folded_term").toArrow().column(0).to_pylist()])

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            fold = batch.column("_fold").cast(pa.large_binary())
            at = np.frombuffer(fold.buffers()[1], np.int64, len(fold) + 1, fold.offset * 8)
            data = np.frombuffer(fold.buffers()[2], np.uint8) if at[-1] else np.zeros(0, np.uint8)
            hit = scan.matches(data[at[0]:at[-1]], at[1:] - at[0])
            yield batch.select(["_h1", "_h2"]).filter(pa.array(hit))

    ended = texts.select("_h1", "_h2", F.concat("_fold", F.lit(chr(END))).alias("_fold"))
    return ended.mapInArrow(run, "_h1 long, _h2 long")


def pages_with_terms(rows: DataFrame, terms: DataFrame, text: str = "text", term: str = "term") -> DataFrame:
    """The rows whose text contains any term of the table, each as often as it occurs.

    Null terms match nothing; a term without letters, digits, parentheses or blanks matches every text
    that is not null. Null texts match nothing. Terms are measured before they are collected; beyond
    ``SCANNED_BYTES`` what is broadcast is a filter of bounded size, and Spark chooses the joins by measured sizes.
    The keys of the pages that hold a term are written to the shared folder, and postings if there are any."""
    spark = rows.sparkSession
    distinct = terms.select(folded(F.col(term)).alias("folded_term")).where("folded_term is not null").distinct()
    # one row: the block sizes in use, the length of the longest term, and what all of them take
    length = F.length("folded_term")
    of = distinct.agg(F.collect_set(block_size(length)).alias("s"), F.max(length).alias("n"),
                      F.coalesce(F.sum(length + TERM_BYTES), F.lit(0)).alias("bytes")).first()
    sizes, longest = sorted(of["s"]), of["n"]
    if 0 in sizes:
        return rows.where(F.col(text).isNotNull())
    if not sizes:
        return rows.where(F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    raw = F.col(f"`{text}`")
    key = [F.xxhash64(raw).alias("_h1"), F.xxhash64(raw, F.lit(1)).alias("_h2")]
    full = rows.select(raw.alias("_text"), *key).where("_text is not null")
    if of["bytes"] <= SCANNED_BYTES:
        where = scratch_path(spark, "met")
        found = scan_pages(full.select("_h1", "_h2", folded(F.col("_text")).alias("_fold")), distinct)
        found.select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2")).distinct().write.parquet(where)
        met = spark.read.schema("_g1 long, _g2 long").parquet(where)
        hit = rows.select(row.alias("_row"), raw.alias("_text"), *key).where("_text is not null").join(
            met, (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2")), "left_semi")
        return hit.select(*[F.col("_row")[c].alias(c) for c in rows.columns])
    sample = full.where(F.pmod("_h1", F.lit(RARITY_SHARE)) == 0).select(folded(F.col("_text")).alias("_fold"))
    where = scratch_path(spark, "postings")
    file_terms(distinct, sample, sizes).write.parquet(where)
    postings = spark.read.schema("folded_term string, probe string, gram long").parquet(where)
    slim = full.select("_h1", "_h2", F.explode_outer(page_windows(folded(F.col("_text")), sizes, longest)).alias("b"))
    slim = slim.select("_h1", "_h2", "b.gram", "b.around")
    few = bloom.build(postings, "gram").split(slim, "gram").where("_maybe").drop("_maybe")
    where = scratch_path(spark, "met")
    found = few.join(postings, (few["gram"] == postings["gram"]) & F.contains("around", "probe"))
    rest = F.when(F.length("folded_term") > PROBE, F.col("folded_term"))  # null: the probe is the term
    found.select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), rest.alias("folded_term")).distinct().write.parquet(where)
    met = spark.read.schema("_g1 long, _g2 long, folded_term string").parquet(where)
    same = (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2"))
    # texts are folded once, and only where they met a term
    near = rows.select(row.alias("_row"), raw.alias("_text"), *key).join(met.select("_g1", "_g2").distinct(), same, "left_semi")
    near = near.select("_row", "_h1", "_h2", folded(F.col("_text")).alias("_fold"))
    held = F.col("folded_term").isNull() | F.col("_fold").contains(F.col("folded_term"))
    hit = near.join(met, same & held, "left_semi")
    return hit.select(*[F.col("_row")[c].alias(c) for c in rows.columns])
