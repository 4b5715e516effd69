"""Removal of near-duplicate paragraphs by MinHash banding.

Paragraphs (lines with at least five words) are signed; bands are tuned for recall at the
threshold; paragraphs that share a band are joined and verified by the exact Jaccard similarity
of their five-word shingles; of each component the first paragraph, by document and place, stays. A
short paragraph goes only with a block: repeated lines on end that hold enough words together. Passages that are repeated
inside lines that otherwise differ, or across lines, go after that (``passages``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusters import link_buckets
from .common import releasing, split_by_hash, stored, table
from .passages import remove_passages
from .textbytes import U, band_codes, batches, digest64, distinct, mix, plain_words, shingle_sets, shingles

THRESHOLD = 0.8
MIN_WORDS = 20
# Lines with fewer words than this have no whole shingle; those from here to MIN_WORDS are short paragraphs.
LEAST_WORDS = 5
HASHES = 27
RECALL = 0.995
# There are few bands, so each bucket is compared with several of its members at first.
HUBS = 6
WIDTH = 5


def tune_bands(threshold: float = THRESHOLD, hashes: int = HASHES, recall: float = RECALL) -> tuple[int, int]:
    """The most selective (bands, rows) of ``hashes`` functions that still finds a pair at the
    threshold with probability ``recall``."""
    fits = [(hashes // r, r) for r in range(1, hashes + 1) if 1 - (1 - threshold**r) ** (hashes // r) >= recall]
    return fits[-1] if fits else (hashes, 1)


def minhash(owner: np.ndarray, elements: np.ndarray, n: int, hashes: int = HASHES) -> np.ndarray:
    """MinHash signature of each of ``n`` sets; ``owner`` is sorted and names every set."""
    firsts = np.searchsorted(owner, np.arange(n))
    seeds = mix(np.arange(1001, 1001 + hashes, dtype=U))
    return np.stack([np.minimum.reduceat(mix(elements ^ s), firsts) for s in seeds], axis=1)


def _paragraphs(text: str | None, least_words: int) -> Iterator[tuple[int, int, bytes, int]]:
    """Line number, number among the lines with words, words, and how many, of each paragraph."""
    seq = 0
    for i, line in enumerate((text or "").split("\n")):
        plain = plain_words(line)
        if plain:
            n = plain.count(b" ") + 1
            if n >= least_words:
                yield i, seq, plain, n
            seq += 1


def paragraph_signatures(docs: DataFrame, doc_id: str, text: str, rows: int, least_words: int) -> DataFrame:
    """``doc_id, text_hash, place, seq, words, node, bands`` of every paragraph; ``seq`` counts the
    lines with words, ``words`` those of the line."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a, b in batches([len(t or "") for t in frame["text"]]):
                who, place, seq, plain, count = [], [], [], [], []
                for k, t in enumerate(frame["text"].iloc[a:b], a):
                    for i, j, p, n in _paragraphs(t, least_words):
                        who.append(k)
                        place.append(i)
                        seq.append(j)
                        plain.append(p)
                        count.append(n)
                if plain:
                    d, h, _ = distinct(*shingles(plain, WIDTH))
                    codes = band_codes(minhash(d, h, len(plain)), rows)
                    yield pd.DataFrame(
                        {
                            "doc_id": frame["doc_id"].iloc[who].reset_index(drop=True),
                            "text_hash": frame["text_hash"].iloc[who].reset_index(drop=True),
                            "place": np.array(place, dtype=np.int32),
                            "seq": np.array(seq, dtype=np.int32),
                            "words": np.array(count, dtype=np.int64),
                            "node": np.array([digest64(p) for p in plain], dtype=np.int64),
                            "bands": list(codes),
                        }
                    )

    source = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text")
    )
    out = source.mapInPandas(releasing(run), "doc_id string, text_hash long, place int, seq int, words long, node long, bands array<long>")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def repeated_paragraphs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, text_hash, places, short_places``: the paragraphs to remove from each document that
    has any, as line numbers from 0, in order; those of fewer than ``min_words`` words apart. Both
    kinds are compared with each other. Short ones go only where repeated lines that follow each
    other, blank lines aside, hold ``min_words`` words together.

    Null and blank texts and lines of fewer than ``least_words`` words have no paragraphs. Of repeated rows with one id and
    text the first occurrence is the same paragraph and stays in all of them. Null ids come before
    all others. Other columns are ignored, whatever their names."""
    _, rows = tune_bands(threshold)
    items = stored(paragraph_signatures(docs, doc_id, text, rows, least_words), "paragraphs")
    spot = F.struct("doc_id", "text_hash", "place")
    nodes = stored(items.groupBy("node").agg(F.min(spot).alias("spot"), F.count("*").alias("n"), F.first("bands").alias("bands")), "nodes")

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = stored(
            nodes.join(ids, nodes["node"] == ids["id"])
            .groupBy("spot.doc_id", "spot.text_hash")
            .agg(F.collect_list(F.struct(F.col("spot.place").alias("place"), "id")).alias("wanted")),
            "wanted",
        )
        own = docs.select(
            F.col(doc_id).alias("row_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_hash"), F.col(text).alias("text")
        )
        own, _ = split_by_hash(own, "row_hash", wanted.select(F.col("text_hash").alias("row_hash")))
        same = (F.col("row_hash") == F.col("text_hash")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
        lines = own.join(wanted, same).select(
            F.inline(F.transform("wanted", lambda x: F.struct(x["id"].alias("id"), F.get(F.split("text", "\n"), x["place"]).alias("text"))))
        )
        return lines.mapInPandas(releasing(_sets), "id long, grams array<long>, sketch array<long>").dropDuplicates(["id"])

    labels = link_buckets(nodes.select(F.col("node").alias("id"), "bands"), sets_of, threshold, HUBS)
    labelled = nodes.join(labels, nodes["node"] == labels["id"], "left").select("node", "spot", "n", F.coalesce("label", "node").alias("label"))
    kept = labelled.groupBy("label").agg(F.min("spot").alias("kept"), F.sum("n").alias("total")).where("total > 1")
    repeated = stored(labelled.join(kept, "label").select("node", "kept"), "repeated")
    lines = items.select("node", "doc_id", "text_hash", "place", "seq", "words")
    gone = lines.join(repeated, "node").where(~spot.eqNullSafe(F.col("kept")))
    # lines on end have one difference of place and rank; repeated rows share their ranks
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "text_hash").orderBy("seq"))
    blocks = gone.withColumn("block", F.col("seq") - rank).groupBy("doc_id", "text_hash", "block").agg(F.collect_set(F.struct("place", "words")).alias("lines"))
    held = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["words"])

    def places(keep) -> Column:
        return F.sort_array(F.flatten(F.collect_list(F.transform(F.filter("lines", keep), lambda x: x["place"]))))

    return (
        blocks.withColumn("held", held)
        .groupBy("doc_id", "text_hash")
        .agg(
            places(lambda x: x["words"] >= min_words).alias("places"),
            places(lambda x: (x["words"] < min_words) & (F.col("held") >= min_words)).alias("short_places"),
        )
        .where((F.size("places") > 0) | (F.size("short_places") > 0))
    )


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part, _ in shingle_sets(frame["id"], [plain_words(t) for t in frame["text"]], WIDTH):
            yield part


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without their repeated paragraphs, and the line numbers removed, as
    ``removed_places`` and, for short paragraphs, ``removed_short``; then without the passages that
    an earlier place of what is left holds word for word, with the words removed as
    ``removed_passages`` (all empty if none). All columns of ``docs`` stay and every row stays."""
    gone = stored(repeated_paragraphs(docs, doc_id, text, **options), "gone")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    tagged = docs.select(
        others.alias("row"), F.col(doc_id).alias("row_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_hash"), F.col(text).alias("text")
    )
    same = (F.col("row_hash") == F.col("text_hash")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
    tagged, whole = split_by_hash(tagged, "row_hash", gone.select(F.col("text_hash").alias("row_hash")))
    joined = tagged.join(gone, same, "left")
    lines = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("places", i) & ~F.array_contains("short_places", i))
    new = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    none = F.array().cast("array<int>")
    made = joined.select(
        "row",
        "row_id",
        "row_hash",
        new.alias("text"),
        F.coalesce("places", none).alias("removed_places"),
        F.coalesce("short_places", none).alias("removed_short"),
    )
    if whole is not None:
        made = made.union(whole.select("row", "row_id", "row_hash", "text", none.alias("removed_places"), none.alias("removed_short")))
    left = remove_passages(stored(made, "lines_left"))
    return left.select(
        *[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns], "removed_places", "removed_short", "removed_passages"
    )


def op3_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left and the lines and passages that went."""
    docs = table(spark, sf_dir, "documents")
    kept = remove_repeated(docs.select("doc_id", "text", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars")))
    return kept.select(
        "doc_id",
        "n_chars",
        (F.size("removed_places") + F.size("removed_short")).cast("long").alias("n_removed"),
        (F.col("n_chars") - F.length(F.coalesce("text", F.lit("")))).cast("long").alias("chars_removed"),
        "removed_places",
        "removed_short",
        "removed_passages",
        F.coalesce("text", F.lit("")).alias("text"),
    )
