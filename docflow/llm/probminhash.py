"""Near-duplicate documents by ProbMinHash.

Each five-word shingle of a document is a Poisson process whose rate is its count. Its arrivals
fall on random registers, and a register keeps the shingle that arrives first; a shingle stops as
soon as its next arrival is later than all registers. Two signatures agree in a register with
the probability Jaccard similarity of the weighted shingle sets, and with all rates 1 with the Jaccard
similarity of the sets. Bands of registers of both kinds give candidates; the Jaccard similarity of the shingle sets decides; components are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .clusters import link_buckets
from .common import drop_rows, releasing, stored, table, with_ids
from .textbytes import U, band_codes, batches, digest64, distinct, mix, plain_words, shingle_sets, shingles

REGISTERS = 144
ROWS = 6
THRESHOLD = 0.8
WIDTH = 5


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, registers: int = REGISTERS):
    """Signature of each of ``n`` weighted sets; sets without elements keep zeros. All elements take
    their k-th arrival together; those past the slowest register of their set drop out."""
    best = np.full(n * registers, np.inf)
    kept = np.zeros(n * registers, dtype=U)
    time = np.zeros(len(elements))
    owner, elements, rate = owner.astype(np.int64), elements, weights.astype(float)
    step = 0
    while len(elements):
        step += 1
        draw = mix(elements + U(step * 0xD1342543DE82EF95 % 2**64))
        uniform = ((draw >> U(11)).astype(float) + 0.5) / 2.0**53
        time = time - np.log(uniform) / rate
        at = owner * registers + (mix(draw) % U(registers)).astype(np.int64)
        np.minimum.at(best, at, time)
        won = best[at] == time
        kept[at[won]] = elements[won]
        slowest = best.reshape(n, registers).max(axis=1)
        on = time < slowest[owner]
        owner, elements, rate, time = owner[on], elements[on], rate[on], time[on]
    return kept.reshape(n, registers)


def both_bands(owner: np.ndarray, elements: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Band codes of the signatures weighted by the counts, then of those with all rates 1, by which
    a pair is found whatever its counts. The two agree where no shingle occurs twice."""
    flat = signatures(owner, elements, np.ones(len(elements)), n)
    weighted = flat.copy()
    several = np.zeros(n, dtype=bool)
    several[owner[counts > 1]] = True
    if several.any():
        on, number = several[owner], np.cumsum(several) - 1
        weighted[several] = signatures(number[owner[on]], elements[on], counts[on], int(several.sum()))
    return np.concatenate((band_codes(weighted, ROWS), band_codes(flat, ROWS)), axis=1)


def _signed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [plain_words(t) for t in frame["text"]]
        for a, b in batches([len(t) for t in texts]):
            own = texts[a:b]
            bands: list = [None] * len(own)
            node: list = [None] * len(own)
            full = [i for i, t in enumerate(own) if t]
            if full:
                d, h, c = distinct(*shingles([own[i] for i in full], WIDTH))
                codes = both_bands(d, h, c, len(full))
                for k, i in enumerate(full):
                    bands[i], node[i] = codes[k], digest64(own[i])
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].iloc[a:b].reset_index(drop=True), "text_hash": frame["text_hash"].iloc[a:b].reset_index(drop=True), "node": pd.array(node, dtype="Int64"), "bands": bands}
            )


def _hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, node`` (digest of the lower-cased words), ``label``
    (the class), ``class_id`` (the
    smallest doc_id of the class), ``class_size`` (rows) and ``first`` (true for the class's row
    with that id).

    Texts that agree in all words are one class and enter the comparison once. Null and blank
    texts have no shingles: each such row is a class of its own with its own id. Null ids belong to
    a class but never name it, unless it has no other. Repeated rows are members like any other;
    all rows that carry the class's id and text are ``first``. Other columns are ignored. The node
    digest has 64 bits: among 10^10 different texts, three pairs are expected to be confused."""
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), _hash(text).alias("text_hash"), F.col(text).alias("text"))
    signed = rows.mapInPandas(releasing(_signed), "doc_id string, text_hash long, node long, bands array<long>").withColumn(
        "doc_id", F.col("doc_id").cast(kind)
    )
    items = stored(signed, "signatures")
    nodes = stored(items.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.count("*").alias("n")), "nodes")

    def sets_of(ids: DataFrame) -> DataFrame:
        every = stored(nodes.join(ids, nodes["node"] == ids["id"]).select("id", "doc_id", "text_hash"), "wanted")
        wanted = every.where("doc_id is not null").select("id", "doc_id")
        source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        found = with_ids(source, "doc_id", wanted.select("doc_id")).join(wanted, "doc_id").select("id", "text")
        nameless = every.where("doc_id is null").select("id", "text_hash")
        if not nameless.isEmpty():  # texts whose rows all have a null id
            texts = docs.where(F.col(doc_id).isNull()).select(_hash(text).alias("text_hash"), F.col(text).alias("text"))
            found = found.union(texts.dropDuplicates(["text_hash"]).join(nameless, "text_hash").select("id", "text"))
        made = found.mapInPandas(releasing(_named_sets), "id long, node long, grams array<long>, sketch array<long>")
        return made.where("id = node").dropDuplicates(["id"]).select("id", "grams", "sketch")

    labels = link_buckets(
        items.where("node is not null").select(F.col("node").alias("id"), "bands"), sets_of, threshold
    )
    classed = nodes.join(labels, nodes["node"] == labels["id"], "left").select(
        "node", "doc_id", "n", F.coalesce("label", "node").alias("label")
    )
    sizes = classed.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    by_node = stored(classed.join(sizes, "label").select("node", "label", "class_id", "class_size"), "classes")
    out = items.select("doc_id", "text_hash", "node").join(by_node, "node", "left")
    return out.select(
        "doc_id",
        "text_hash",
        "node",
        "label",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (F.col("node").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("first"),
    )


def _named_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets with the node of their own text: rows of another text under the same id fall out."""
    for frame in frames:
        texts = [plain_words(t) for t in frame["text"]]
        for part, (a, b) in shingle_sets(frame["id"], texts, WIDTH):
            part.insert(1, "node", np.array([digest64(t) for t in texts[a:b]], dtype=np.int64))
            yield part


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id; of repeated
    rows one. Documents without words all stay."""
    found = stored(near_duplicates(docs, doc_id, text, threshold), "classed")
    kept = (
        found.where("first and node is not null")
        .groupBy("doc_id", "label")
        .agg(F.min("text_hash").alias("kept_hash"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("doc_id").alias("kept_id"), F.col("label").alias("kept_label"), "kept_hash")
    )
    several = stored(kept, "several")
    others = found.where("first").join(
        several,
        F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("label") == F.col("kept_label")) & (F.col("text_hash") != F.col("kept_hash")),
    )
    gone = stored(
        found.where("not first").select("doc_id", "text_hash").union(others.select("doc_id", "text_hash")).toDF("gone_id", "gone_hash").distinct(),
        "gone",
    )
    left = drop_rows(docs, gone, doc_id, text)
    if several.isEmpty():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = left.select(row.alias("row"), F.col(doc_id).alias("row_id"), _hash(text).alias("row_hash"))
    again = F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    single = tagged.join(several, again, "left_anti")
    one = tagged.join(several, again, "left_semi").dropDuplicates(["row_id", "row_hash"])
    return single.union(one).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op9_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near-duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "first")
