"""Final outputs: records, per-year texts and corpora.

Ordering where the original has none (listing order, random shuffles) is made deterministic with
a seeded hash key, so results do not depend on partitioning (D9). Global orders are range-
partitioned sorts; the top-k forms plan as TakeOrderedAndProject (per-task top-k, then merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docflow import constants as C
from docflow.functions.text import repair_mojibake, strip_text
from docflow.operators.rows import filter_computed


def records(routed: DataFrame, root: str = "tracker") -> DataFrame:
    """K3 rows: one record per document with the token path its status implies."""
    path = F.concat_ws("/", F.lit(root), F.col("status"), F.col("year").cast("string"),
                       F.concat(F.col("ack_id"), F.lit(".txt")))
    return routed.select("ack_id", "year", "status", path.alias("path"))


def non_null_text(df: DataFrame, col: str = C.OCR_TEXT_COL) -> DataFrame:
    """Drop rows without text."""
    return df.where(F.col(col).isNotNull())


def year_texts(routed: DataFrame, text: str = "text", repair: bool = True) -> DataFrame:
    """K4 rows: processed documents with their text; the text is put through the mojibake
    repair of the original output step unless ``repair`` is off (D8: it deletes non-Latin-1)."""
    t = F.when(F.col("status") == C.PROCESSED, F.col(text))
    t = repair_mojibake(t) if repair else t
    out = routed.select("ack_id", "year", "status", t.alias(C.OCR_TEXT_COL))
    # P19 on a computed column: select without letting the optimizer re-run the routing
    return filter_computed(out, C.OCR_TEXT_COL, lambda c: c.isNotNull())


def project_corpus(df: DataFrame) -> DataFrame:
    """P20: the corpus columns."""
    return df.select("ack_id", "year", C.OCR_TEXT_COL)


def semi_train(texts: DataFrame, train_ids: DataFrame, col: str = "ack_id") -> DataFrame:
    """Texts whose (trimmed) id is in the training list."""
    t = texts.withColumn(col, strip_text(F.col(col)))
    ids = train_ids.select(strip_text(F.col(col).cast("string")).alias(col)).where(F.col(col).isNotNull())
    return t.join(ids, col, "left_semi")


def anti_oos(texts: DataFrame, train_ids: DataFrame, col: str = "ack_id") -> DataFrame:
    """Texts whose id is not in the training list."""
    t = texts.withColumn(col, strip_text(F.col(col)))
    ids = train_ids.select(strip_text(F.col(col).cast("string")).alias(col)).where(F.col(col).isNotNull())
    return t.join(ids, col, "left_anti")


def merge_text(universe: DataFrame, texts: DataFrame, col: str = "ack_id") -> DataFrame:
    """The universe with the extracted text attached (null where none)."""
    return universe.join(texts.select(col, C.OCR_TEXT_COL), col, "left")


def shuffle_key(col: str = "ack_id", seed: int = C.SHUFFLE_SEED):
    """Seeded, partitioning-independent sort key."""
    return F.md5(F.concat(F.col(col).cast("string"), F.lit(f":{seed}")))


def stable_shuffle(df: DataFrame, col: str = "ack_id", seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """L1: a seeded full permutation (every chunk representative), the same for any input
    partitioning. Range-partitioned sort on (key, id); ``shuffle_key`` is kept as a column."""
    return df.withColumn("shuffle_key", shuffle_key(col, seed)).orderBy("shuffle_key", col)


def shuffle_rank(df: DataFrame, col: str = "ack_id", seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """``df`` with ``shuffle_key`` and ``shuffle_rank``, the place from 1 that ``stable_shuffle`` gives a
    row, without a global sort: rows are ranked inside the first four digits of the key, after the
    counted rows of the smaller ones (at most 65,536 counts, so they are broadcast)."""
    keyed = df.withColumn("shuffle_key", shuffle_key(col, seed)).withColumn("_prefix", F.coalesce(F.substring("shuffle_key", 1, 4), F.lit("")))
    counts = keyed.groupBy("_prefix").count()
    before = F.sum("count").over(Window.orderBy("_prefix")) - F.col("count")
    smaller = counts.select("_prefix", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_prefix").orderBy("shuffle_key", col))
    ranked = keyed.withColumn("_inside", inside).join(F.broadcast(smaller), "_prefix")
    return ranked.withColumn("shuffle_rank", F.col("_before") + F.col("_inside")).select(*df.columns, "shuffle_key", "shuffle_rank")


def sample_k(df: DataFrame, k: int = C.SAMPLE_K, col: str = "path", seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """L2: min(k, n) pseudo-random rows for a preview (the limit is the feature)."""
    return df.withColumn("shuffle_key", shuffle_key(col, seed)).orderBy("shuffle_key", col).limit(k)


def preview_first(df: DataFrame, n: int = C.PREVIEW_TOKENS, col: str = "path") -> DataFrame:
    """L3: the first n tokens by path."""
    return df.orderBy(col).limit(n)


def build_corpora(texts: DataFrame, train_ids: DataFrame, exclude_train: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training corpus (rows in the training list) and full corpus. As in the original the full
    corpus keeps the training rows; ``exclude_train`` removes them (D1). The full corpus is
    put in its seeded order (L1) by ``write_corpora``, after its emptiness check."""
    corpus = project_corpus(texts)
    train = semi_train(corpus, train_ids)
    full = anti_oos(corpus, train_ids) if exclude_train else corpus
    return train, full
