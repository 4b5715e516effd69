"""Ranked lexical search over document FP-trees.

Every document keeps the terms that occur in some query item (its restricted vector). Terms are
ordered by document frequency, the most frequent first, so documents that begin alike share the
paths of a prefix tree. Each node holds the largest frequency of every term and the smallest
length figure ``m`` below it; the score grows with the one and falls with the other, so the score of
these two is a bound for the whole subtree. For each item the tree is walked depth-first, the best
bound first, and subtrees whose bound is under the item's worst kept score are left out.

Spark deals the documents: a task builds trees over the vectors that it reads and keeps the best
documents of each item, whose number does not grow with the task; a ranking merges them.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

TOP = 50
# Items are dealt to blocks of about this many terms; a block's terms reach every task, and the
# documents are read once a block. An item of more terms is a block of its own.
BLOCK_TERMS = 100_000
# Cells (documents x terms) of one tree, four bytes each.
TREE_CELLS = 8_000_000
# Terms of one tree: the items of a block are searched group by group.
TREE_TERMS = 4_000
# A subtree of at most so many documents is one leaf; its documents are scored together.
LEAF = 64
# The tasks' rows of an item meet in so many first rankings, and these in one.
MERGES = 64
TASK_DOCS = 10_000
PIECE = 1_000_000

_KEPT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def term_counts(text: str | None) -> tuple[int, Counter]:
    """Number of terms and the count of each, a piece of the text at a time."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_KEPT)
    total, counts, at = 0, Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        found = raw[at:end].split()
        total += len(found)
        counts.update(found)
        at = end
    return total, counts


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item, terms`` (distinct, in UTF-8): rows with one id, the null id too, are one item."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda x: x != "")
    rows = items.select(F.col(item_id).alias("item"), F.explode(F.array_distinct(found)).alias("term"))
    return rows.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _deal(items: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Items with a ``block`` number; blocks hold at most ``limit`` terms, or one item."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = max(1, -(-total // limit))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item", F.lit(5)), F.lit(n)).cast("int"))
        over = dealt.groupBy("block").agg(F.sum(F.size("terms")).alias("n"), F.count("*").alias("items"))
        if over.where((F.col("n") > limit) & (F.col("items") > 1)).isEmpty():
            return dealt, n
        n *= 2


def restricted_vectors(docs: DataFrame, number: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """``doc_id, n`` (terms with repeats), ``terms`` (numbers of the item terms it holds, ascending) and
    ``tfs`` for every row with a term."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, ns, terms, tfs = [], [], [], []
            for i, t in zip(frame["doc_id"], frame["text"], strict=True):
                n, counts = term_counts(t)
                if n:
                    own = sorted((number[w], c) for w, c in counts.items() if w in number)
                    ids.append(i)
                    ns.append(n)
                    terms.append([k for k, _ in own])
                    tfs.append([c for _, c in own])
            yield pd.DataFrame({"doc_id": pd.Series(ids, dtype=object), "n": ns, "terms": terms, "tfs": tfs})

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return source.mapInPandas(run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


class Tree:
    """Documents in trie order with the nodes over them. ``tf``: documents x terms, columns by falling
    document frequency; ``m``: length figures."""

    def __init__(self, tf: np.ndarray, m: np.ndarray):
        held = np.packbits(tf > 0, axis=1)
        keys = held.view(f"S{held.shape[1]}").ravel() if held.shape[1] else np.zeros(len(tf), dtype="S1")
        # falling bit patterns: documents with the most frequent term first, and so on along the path
        order = np.argsort(keys, kind="stable")[::-1]
        self.order, self.tf, self.m = order, tf[order], m[order]
        rows, cols = np.nonzero(self.tf)
        self.starts = np.searchsorted(rows, np.arange(len(tf) + 1))
        self.path = cols
        self._shared()
        self.nodes: list[tuple[int, int, list[int]]] = []
        self._build()
        self.top = np.stack([self.tf[a:b].max(axis=0) for a, b, _ in self.nodes])
        self.least = np.array([self.m[a:b].min() for a, b, _ in self.nodes])

    def _shared(self) -> None:
        """Length of the path that each document shares with the one before."""
        held = self.tf > 0
        differ = held[1:] != held[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), held.shape[1])
        upto = np.cumsum(held[1:], axis=1, dtype=np.int32)
        before = np.where(first > 0, upto[np.arange(len(first)), np.maximum(first, 1) - 1], 0)
        self.lcp = np.concatenate(([0], before)) if len(self.tf) else np.zeros(0, dtype=int)

    def _build(self) -> None:
        """Nodes from the root: the documents below a node share a path; its children begin where the
        shared path is no longer than the node's. Small neighbours are one leaf."""
        pending = [(0, len(self.tf), -1)]
        while pending:
            a, b, parent = pending.pop()
            number = len(self.nodes)
            self.nodes.append((a, b, []))
            if parent >= 0:
                self.nodes[parent][2].append(number)
            if b - a <= LEAF:
                continue
            inner = self.lcp[a + 1 : b]
            depth = inner.min()
            cuts = np.flatnonzero(inner == depth) + a + 1
            if depth == self.starts[a + 1] - self.starts[a] and depth == inner.max():
                cuts = np.arange(a + LEAF, b, LEAF)  # equal paths: pieces of one leaf
            bounds = [a, *cuts.tolist(), b]
            start = a
            for k in range(1, len(bounds)):
                if k + 1 == len(bounds) or bounds[k + 1] - start > LEAF:
                    pending.append((start, bounds[k], number))
                    start = bounds[k]

    def search(self, cols: np.ndarray, weights: np.ndarray, best: Best) -> None:
        def score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
            tf = tf.astype(np.int64)
            return (weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[:, None]))).sum(axis=1)

        stack = [(int(score(self.top[:1, cols], self.least[:1])[0]), 0)]
        while stack:
            bound, k = stack.pop()
            if bound <= 0 or bound < best.worst:
                continue
            a, b, children = self.nodes[k]
            if children:
                under = np.array(children)
                bounds = score(self.top[np.ix_(under, cols)], self.least[under])
                for j in np.argsort(bounds, kind="stable"):
                    if bounds[j] >= best.worst:
                        stack.append((int(bounds[j]), children[j]))
            else:
                got = score(self.tf[a:b][:, cols], self.m[a:b])
                for j in np.flatnonzero((got >= best.worst) & (got > 0)):
                    best.add(int(got[j]), self.order[a + j])


class Best:
    """The best ``top`` documents of an item: highest score, then smallest id, null ids last."""

    def __init__(self, top: int):
        self.top, self.kept, self.worst, self.ids = top, [], 1, None

    def add(self, score: int, row: int) -> None:
        i = self.ids[row]
        entry = (-score, i is None, 0 if i is None else i)
        if len(self.kept) < self.top or entry < self.kept[-1]:
            bisect.insort(self.kept, entry)
            del self.kept[self.top :]
            if len(self.kept) == self.top:
                self.worst = -self.kept[-1][0]


def _groups(items: list[tuple[int, list[int]]], limit: int) -> Iterator[tuple[np.ndarray, list[tuple[int, np.ndarray]]]]:
    """Items in groups of at most ``limit`` terms (or one item): the group's term numbers, ascending,
    and each item's terms as places among them."""
    group: list[tuple[int, list[int]]] = []
    seen: set[int] = set()

    def closed():
        terms = np.array(sorted(seen), dtype=np.int64)
        return terms, [(i, np.searchsorted(terms, np.array(sorted(t)))) for i, t in group]

    for i, t in items:
        if group and len(seen.union(t)) > limit:
            yield closed()
            group, seen = [], set()
        group.append((i, t))
        seen.update(t)
    if group:
        yield closed()


def _matrix(frame: pd.DataFrame, terms: np.ndarray) -> np.ndarray:
    """Frequencies of the given terms in each document of the frame."""
    sizes = frame["terms"].map(len).to_numpy()
    out = np.zeros((len(frame), len(terms)), dtype=np.uint32)
    if sizes.sum() and len(terms):
        found, tfs = np.concatenate(frame["terms"].to_numpy()), np.concatenate(frame["tfs"].to_numpy())
        rows = np.repeat(np.arange(len(frame)), sizes)
        at = np.minimum(np.searchsorted(terms, found), len(terms) - 1)
        hit = terms[at] == found
        out[rows[hit], at[hit]] = tfs[hit]
    return out


def _searcher(items: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
    """A task's search: the items are numbers and term numbers, ascending by falling frequency."""
    groups = list(_groups(items, TREE_TERMS))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = {i: Best(top) for i, _ in items}
        for frame in frames:
            m = np.array([50 + (50 * n * n_docs) // n_terms for n in frame["n"].tolist()], dtype=np.int64)
            ids = [None if pd.isna(i) else i for i in frame["doc_id"].tolist()]
            for terms, members in groups:
                step = max(1, TREE_CELLS // max(1, len(terms)))
                for a in range(0, len(frame), step):
                    tree, own = Tree(_matrix(frame.iloc[a : a + step], terms), m[a : a + step]), ids[a : a + step]
                    for i, cols in members:
                        best[i].ids = own
                        tree.search(cols, weights[terms[cols]], best[i])
        rows = [(i, None if none else d, -s) for i, b in best.items() for s, none, d in b.kept]
        made = pd.DataFrame(rows, columns=["item_no", "doc_id", "score"])
        made["doc_id"] = made["doc_id"].astype(object)
        yield made

    return run


def _best(rows: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _weight(n: Column, df: Column) -> Column:
    """floor(1000 ln((2N + 2) / (2 df + 1))), in doubles."""
    return F.floor(1000 * F.log((2 * n + 2).cast("double") / (2 * df + 1).cast("double"))).cast("long")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents with the highest score above 0 of each
    item; equal scores by ascending id, null ids last; repeated rows are documents of their own.

    Rows of ``items`` with one id are one item. Null and blank texts have no terms: such documents
    count nowhere, such items have no rows, and an empty table on either side gives no rows.
    Other columns are ignored, whatever their names. Ids are numbers or strings."""
    dealt, n_blocks = _deal(stored(item_terms(items, item_id, item_text), "items"), block_terms)
    out = None
    for block in range(n_blocks):
        # bounded by block_terms, or one item
        own = dealt.where(F.col("block") == block).select("item", "terms").collect()
        found = _rank_block(docs, own, doc_id, text, items.schema[item_id].dataType.simpleString(), top)
        out = found if out is None else out.union(found)
    return out


def _rank_block(docs: DataFrame, own: list, doc_id: str, text: str, kind: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for r in own for t in r["terms"]})
    number = {t.encode("utf-8", "surrogatepass"): k for k, t in enumerate(vocabulary)}
    vectors = stored(restricted_vectors(docs, number, doc_id, text), "vectors")
    whole = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = whole["n"], whole["terms"] or 1
    # one row a term of the block
    seen = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weighed = seen.select("term", "df", _weight(F.lit(n_docs).cast("long"), F.col("df")).alias("w")).collect()
    ranked = sorted(weighed, key=lambda r: (-r["df"], r["term"]))
    place = {r["term"]: k for k, r in enumerate(ranked)}
    weights = np.array([r["w"] for r in ranked], dtype=np.int64)
    by_frequency = np.full(len(vocabulary), -1, dtype=np.int64)
    for t, k in place.items():
        by_frequency[t] = k
    plain = [(i, sorted(place[n] for t in r["terms"] if (n := number[t.encode("utf-8", "surrogatepass")]) in place)) for i, r in enumerate(own)]
    # a task searches 10,000 documents, however small their vectors are
    vectors = vectors.repartition(max(1, -(-n_docs // TASK_DOCS)))
    search = _searcher([p for p in plain if p[1]], weights, n_docs, n_terms, top)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def placed():
            for frame in frames:
                yield frame.assign(terms=[by_frequency[np.asarray(t, dtype=np.int64)] for t in frame["terms"]])

        return search(placed())

    id_kind = docs.schema[doc_id].dataType.simpleString()
    found = vectors.mapInPandas(run, f"item_no int, doc_id {id_kind}, score long")
    # every task sends at most `top` rows an item; many tasks meet in two steps
    first = _best(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGES))), top, "item_no", "part")
    names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(own)], f"item_no int, item_id {kind}")
    last = _best(first.drop("rank"), top, "item_no")
    return last.join(F.broadcast(names), "item_no").select("item_id", "rank", "doc_id", "score")


def op13_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
terms AS (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM words),
lengths AS (SELECT doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths),
tfs AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM terms GROUP BY doc_id, t),
weights AS (SELECT t, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tfs, whole GROUP BY t, all_docs),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
ms AS (SELECT doc_id, 50 + (50 * n * all_docs) // all_terms AS m FROM lengths, whole),
scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM items JOIN tfs USING (t) JOIN weights USING (t) JOIN ms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r
           FROM scores WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= 50
"""
