"""Benchmark decontamination with a hash set of test n-grams.

The windows of all benchmark items are hashed, and the runs of half their size in them, the seeds.
Documents are cut into seeds, of which each window holds one; the windows around the benchmark's seeds
are looked up in the set, hits are verified word by word, and hit words are counted, removed or condemn
the document. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_rows, let, lower_ascii, stored, table

WINDOW = 13
MAX_HIT_PCT = 5
# The window set is broadcast up to this many windows (about 300 bytes each); a larger one is
# shuffled by its hash instead.
MAX_BROADCAST_WINDOWS = 200_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def gram_words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)
    return F.filter(parts, lambda x: x != "")


def _seed(size: int) -> tuple[int, int]:
    """Length and distance of the seeds of windows of this size: of the runs of so many words that start
    at every ``distance``-th word of a text, each window holds exactly one."""
    length = (size + 1) // 2
    return length, size - length + 1


def _seeds(w: Column, sizes: list[int]) -> Column:
    """Size of the windows, hash of the seed, first word and words of the windows around it."""

    def of(size: int) -> Column:
        length, step = _seed(size)

        def around(i: Column) -> Column:
            first = F.greatest(i - (step - 1), F.lit(1))
            return F.struct(
                F.lit(size).alias("size"),
                F.xxhash64(F.slice(w, i, F.lit(length))).alias("seed"),
                first.alias("first"),
                F.slice(w, first, i + size - first).alias("near"),
            )

        made = F.transform(F.sequence(F.lit(1), F.size(w) - length + 1, F.lit(step)), around)
        return F.when(F.size(w) >= size, made).otherwise(F.array().cast("array<struct<size:int,seed:bigint,first:int,near:array<string>>>"))

    all_of = [of(s) for s in sizes]
    return F.concat(*all_of) if len(all_of) > 1 else all_of[0]


def _seeds_of(grams: DataFrame, sizes: list[int]) -> DataFrame:
    """``size, seed``: the hashes of all runs of a seed's length in the windows."""
    made = F.array().cast("array<bigint>")
    for size in sizes:
        length, step = _seed(size)
        runs = F.array(*[F.xxhash64(F.slice("gram", i, length)) for i in range(1, step + 1)])
        made = F.when(F.col("size") == size, runs).otherwise(made)
    return grams.select("size", F.explode(made).alias("seed")).distinct()


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW):
    """Distinct windows ``size, h, gram`` with the ids of their items. An item with fewer words
    than a window is one window; an item without words has none; a null id marks words but is
    in no list."""
    w = benchmark.select(F.col(item_id).cast("string").alias("item"), gram_words(F.col(text)).alias("w")).where(
        F.size("w") > 0
    )
    n = F.least(F.size("w"), F.lit(size))
    starts = F.sequence(F.lit(1), F.size("w") - n + 1)
    grams = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("gram"))
    return (
        grams.groupBy("gram")
        .agg(F.collect_set("item").alias("items"))
        .select(F.size("gram").alias("size"), F.xxhash64("gram").alias("h"), "gram", "items")
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST_WINDOWS,
) -> DataFrame:
    """Per document with hits: ``doc_id, text_hash, spans`` (sorted, distinct start and size of
    verified windows, starts from 1), ``items`` (sorted ids as strings), ``n_hit`` (words inside
    any span) and ``n_words``. Rows that agree in id and text share one output row; null and blank texts, and an
    empty benchmark, give none. Other columns are ignored, whatever their names."""
    grams = benchmark_windows(benchmark, size=size)
    # at most `size` sizes; the count decides between broadcast and shuffle
    per_size = grams.groupBy("size").count().collect()
    sizes = sorted(r["size"] for r in per_size) or [size]
    small = sum(r["count"] for r in per_size) <= max_broadcast
    scanned = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
        gram_words(F.col(text)).alias("w"),
    )
    rows = scanned.select("doc_id", "text_hash", "w", F.size("w").alias("n_words"))
    rows = rows.select("doc_id", "text_hash", "n_words", F.explode(_seeds(F.col("w"), sizes)).alias("x")).select("doc_id", "text_hash", "n_words", "x.*")
    # few seeds are the benchmark's: only the windows around those are hashed
    seeds = _seeds_of(grams, sizes)
    near = rows.join(F.broadcast(seeds) if small else seeds, ["size", "seed"], "left_semi")
    starts = F.when(F.size("near") >= F.col("size"), F.sequence(F.lit(0), F.size("near") - F.col("size"))).otherwise(F.array().cast("array<int>"))
    at = near.select("doc_id", "text_hash", "n_words", "size", "first", "near", F.explode(starts).alias("at"))
    own = F.slice("near", F.col("at") + 1, F.col("size"))
    windows = at.select("doc_id", "text_hash", "n_words", "size", (F.col("first") + F.col("at")).alias("pos"), own.alias("own"))
    windows = windows.withColumn("h", F.xxhash64("own"))
    hits = windows.join(F.broadcast(grams) if small else grams, ["size", "h"]).where(F.col("own") == F.col("gram"))
    per_doc = hits.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("pos", "size"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max("n_words").cast("long").alias("n_words"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["pos"] + s["size"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], s["pos"])).alias("n"))

    return per_doc.withColumn("n_hit", F.aggregate("spans", zero, add, lambda acc: acc["n"]).cast("long"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its hit words and the benchmark items it holds."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_contamination(docs, benchmark).drop("n_words")
    base = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.size(gram_words(F.col("text"))).cast("long").alias("n_words"),
    )
    same = base["doc_id"].eqNullSafe(found["doc_id"]) & (base["text_hash"] == found["text_hash"])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return base.join(found, same, "left").select(
        base["doc_id"],
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (100 // MAX_HIT_PCT * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    max_hit_pct: float = MAX_HIT_PCT,
    **options,
) -> DataFrame:
    """The documents whose hit words are under ``max_hit_pct`` percent of their words; columns,
    texts and repeated rows stay as they are."""
    found = find_contamination(docs, benchmark, doc_id, text, **options)
    bad = found.where(100 * F.col("n_hit") >= max_hit_pct * F.col("n_words"))
    gone = stored(bad.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")), "contaminated")
    return drop_rows(docs, gone, doc_id, text)


def remove_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options):
    """The documents with the words of all hit spans taken out. A hit document's text becomes its
    remaining words, as scanned, joined by blanks; other texts stay as they are."""
    found = find_contamination(docs, benchmark, doc_id, text, **options).select("doc_id", "text_hash", "spans")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = docs.select(row.alias("row"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_hash"))
    same = (F.col("row_hash") == F.col("text_hash")) & F.col("row")[doc_id].eqNullSafe(F.col("doc_id"))
    joined = tagged.join(found, same, "left")

    def kept(w: Column) -> Column:
        hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["size"] - 1)))
        left = F.array_except(F.sequence(F.lit(1), F.size(w)), hit)
        return F.array_join(F.transform(left, lambda i: F.element_at(w, i)), " ")

    old = F.col("row")[text]
    new = F.when(F.col("spans").isNull(), old).otherwise(let(gram_words(old), kept))
    return joined.select(*[(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i+k-1], ' ') AS g FROM bi),
sizes AS (SELECT DISTINCT k FROM grams),
di AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k),
dg AS (SELECT doc_id, k, i, array_to_string(w[i:i+k-1], ' ') AS g FROM di),
hits AS (SELECT doc_id, dg.k AS k, i, item_id FROM dg JOIN grams ON dg.k = grams.k AND dg.g = grams.g),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(hw.n, 0) > 0 AND 20 * coalesce(hw.n, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""
