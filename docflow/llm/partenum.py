"""Exact Jaccard join of shingle sets by PartEnum signatures.

Two sets of a and b shingles with a Jaccard similarity of at least p percent differ in at most
k = (100 - p)(a + b) / (100 + p) shingles. Sizes are cut into bands; a pair belongs to the band of its
larger set. Every band deals the shingle domain by a hash to more than k partitions, so a similar
pair has equal content in at least one of them. Where k is small, all subsets of partitions of
a size that must agree are enumerated, which makes longer signatures; elsewhere the
subsets are the single partitions, of which the first k + 1 that hold anything are enough: before the first
partition in which both agree, each one that holds anything differs.

Sets that share a signature are compared, so no similar pair is lost by the signatures. Where more than two
sets share one, all are compared with the one that has the most such signatures, as the text has of which the others
are changed copies; if that leaves several components, members of different ones are compared with
eight of them, then with eight times as many, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docflow.operators import bloom

from .clusters import components, similar
from .common import discard, releasing, stored, table, text_hash
from .textbytes import U, batches, digest64, distinct, mix, parities, shingles, sketches

PERCENT = 80
WIDTH = 5
# Largest set of the bands: 4, 6, 9, ...; each is half as large again as the one before.
FIRST_BAND = 4
GROWTH = (3, 2)
# Up to this many differences all subsets of partitions are enumerated: partitions by differences.
PARTITIONS = {1: 3, 2: 4, 3: 5, 4: 6}
HUBS = 8
# A pair of members is left out at a code if both hold one of this many codes before it.
EARLIER = 16
# 64-bit words of a sketch: bits of MinHash values, then parities of bins of shingles, which tell sets of up to
# two thousand shingles apart more sharply.
MINHASH = 16
PARITY = 16
SKETCH = MINHASH + PARITY
# The codes meet in so many turns; the shuffle files of one are gone before the next makes its own.
TURNS = 2


def band_limits(largest: int) -> list[int]:
    limits = [FIRST_BAND]
    while limits[-1] < largest:
        limits.append(max(limits[-1] + 1, limits[-1] * GROWTH[0] // GROWTH[1]))
    return limits


def differences(a: int, b: int, percent: int = PERCENT) -> int:
    """The most elements in which sets of these sizes may differ at the threshold."""
    return (100 - percent) * (a + b) // (100 + percent)


def _plan(size: int, limits: list[int], percent: int) -> list[tuple[int, int, int]]:
    """For a set of this size: each band it may meet a larger (or equal) partner in, the differences
    that the band's partitions allow for, and those this set may have there."""
    most = size * 100 // percent
    out = []
    for t, limit in enumerate(limits):
        lower = limits[t - 1] if t else 0
        if limit >= size and lower < most:
            out.append((t, differences(limit, limit, percent), differences(size, min(limit, most), percent)))
    return out


def signatures(owner: np.ndarray, hashes: np.ndarray, n: int, percent: int = PERCENT) -> list[np.ndarray]:
    """The signatures of each of ``n`` sets; ``owner`` is sorted, hashes are distinct in a set."""
    sizes = np.bincount(owner, minlength=n)
    out: list[list[np.ndarray]] = [[] for _ in range(n)]
    limits = band_limits(int(sizes.max(initial=1)) * 100 // percent + 1)
    plans = {s: _plan(s, limits, percent) for s in np.unique(sizes[sizes > 0]).tolist()}
    values = mix(hashes ^ U(0x5851F42D4C957F2D))
    for turn in range(max((len(p) for p in plans.values()), default=0)):
        picked = [plans[s][turn] if s and turn < len(plans[s]) else None for s in sizes.tolist()]
        on = np.array([p is not None and p[2] > 0 for p in picked])
        if not on.any():
            continue
        band = np.array([p[0] if p else 0 for p in picked])
        most = np.array([p[1] if p else 0 for p in picked])
        own = np.array([p[2] if p else 0 for p in picked])
        parts = np.array([PARTITIONS.get(m, m + 1) for m in most.tolist()])
        take = on[owner]
        o, h, v = owner[take], hashes[take], values[take]
        place = (mix(h ^ mix(band[o].astype(U) + U(77))) % parts[o].astype(U)).astype(np.int64)
        firsts = np.concatenate(([0], np.cumsum(parts)))
        order = np.argsort(firsts[o] + place, kind="stable")
        key = (firsts[o] + place)[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        content = np.add.reduceat(v[order], new)
        set_of, part_of = o[order][new], place[order][new]
        cuts = np.searchsorted(set_of, np.arange(n + 1))
        codes = mix(content + mix((band[set_of] * 1_000_003 + part_of + 1).astype(U)))
        for i in np.flatnonzero(on).tolist():
            a, b = cuts[i], cuts[i + 1]
            if most[i] in PARTITIONS:
                out[i].append(_subsets(int(band[i]), int(most[i]), int(own[i]), part_of[a:b], content[a:b]))
            else:
                out[i].append(codes[a : min(b, a + own[i] + 1)])
                if b - a <= own[i]:
                    empty = np.setdiff1d(np.arange(parts[i]), part_of[a:b])
                    out[i].append(mix(mix((band[i] * 1_000_003 + empty + 1).astype(U)) ^ U(0x9E6D)))
    none = np.zeros(0, dtype=U)
    return [np.unique(np.concatenate(c)) if c else none for c in out]


def _subsets(band: int, most: int, own: int, held: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Signatures of all subsets of partitions that leave ``most`` out. Those without any element
    serve only sets that might differ in every partition they hold."""
    parts = PARTITIONS[most]
    whole = np.zeros(parts, dtype=U)
    whole[held] = mix(content + mix((held + 1).astype(U)))
    chosen = np.array(list(combinations(range(parts), parts - most)))
    sums = whole[chosen].sum(axis=1, dtype=U)
    codes = mix(sums + mix(U(band * 1_000_003) + np.arange(len(chosen), dtype=U) + U(500_000)))
    if len(held) > own:
        codes = codes[np.isin(chosen, held).any(axis=1)]
    return codes


def plain(text: str | None) -> bytes:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, joined by blanks."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def _sets(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Batches of texts with the owners and hashes of their distinct shingles."""
    for a, b in batches([len(t) for t in texts]):
        owner, hashes, _ = distinct(*shingles(texts[a:b], WIDTH)) if any(texts[a:b]) else (np.zeros(0, dtype=int), np.zeros(0, dtype=U), None)
        yield a, b, owner, hashes


def _signer(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [plain(t) for t in frame["text"]]
            for a, b, owner, hashes in _sets(texts):
                cuts = np.searchsorted(owner, np.arange(b - a + 1))
                codes = signatures(owner, hashes, b - a, percent)
                nodes = [digest64(hashes[cuts[i] : cuts[i + 1]].tobytes()) if cuts[i] < cuts[i + 1] else None for i in range(b - a)]
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[a:b].reset_index(drop=True),
                        "text_hash": frame["text_hash"].iloc[a:b].reset_index(drop=True),
                        "n": np.diff(cuts),
                        "node": pd.array(nodes, dtype="Int64"),
                        "codes": [c.view(np.int64) for c in codes],
                    }
                )

    return run


def _grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [plain(t) for t in frame["text"]]
        for a, b, owner, hashes in _sets(texts):
            cuts = np.searchsorted(owner, np.arange(b - a + 1))
            yield pd.DataFrame(
                {
                    "id": frame["id"].iloc[a:b].reset_index(drop=True),
                    "node": [digest64(hashes[cuts[i] : cuts[i + 1]].tobytes()) for i in range(b - a)],
                    "n": np.diff(cuts),
                    "grams": [hashes[cuts[i] : cuts[i + 1]].view(np.int64) for i in range(b - a)],
                    "sketch": list(np.hstack((sketches(owner, hashes, b - a, MINHASH), parities(owner, hashes, b - a, PARITY)))),
                }
            )


def _may_be_similar(percent: int) -> Column:
    """Sizes and sketches of both sides allow the threshold. A pair at the threshold differs in more
    bits of MinHash values than this once in a billion, and never in more parities than in shingles."""
    share = (100 - percent) / 200
    bits = 64 * MINHASH
    most = int(bits * share + 6 * (bits * share * (1 - share)) ** 0.5)
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    odd = (100 + percent) * _different_bits(MINHASH, SKETCH) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return sizes & odd & (_different_bits(0, MINHASH) <= most)


def _different_bits(start: int, end: int) -> Column:
    """Bits in which these words of two sketches differ."""
    out = F.lit(0)
    for k in range(start, end):
        out = out + F.bit_count(F.col(f"sketch_a.w{k}").bitwiseXOR(F.col(f"sketch_b.w{k}")))
    return out


def _compared(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``sketch`` as a struct of words that are never null. Reading words of arrays makes
    the code of a join longer than the JVM compiles (8,000 bytes), and every pair is then interpreted."""
    words = [F.coalesce(F.get("sketch", F.lit(k)), F.lit(0)).alias(f"w{k}") for k in range(SKETCH)]
    return rows.withColumn("sketch", F.struct(*words))


def _sided(rows: DataFrame, side: str) -> DataFrame:
    return _compared(rows).select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "sketch")])


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``, the smallest doc_id that links lead to.

    Null and blank texts have no shingles and no links; a text of fewer than five words is one
    shingle. Equal sets are one node. Null ids take part but name a component only if it has no
    other id. Repeated rows are members like others; an empty table gives no rows. Other columns are
    ignored. Shingles and sets are known by 64-bit hashes."""
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    signed = stored(source.mapInPandas(releasing(_signer(percent)), f"doc_id {kind}, text_hash long, n long, node long, codes array<long>"), "signed")
    items = stored(signed.drop("codes"), "sets")
    met, members = _meetings(signed)
    discard(signed)
    labels = _link(met, members, items, source.select("text_hash", "text"), percent)
    nodes = items.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    labelled = stored(labelled, "labelled")
    # most nodes are alone: only the members of components meet again
    linked = labelled.join(labels.select(F.col("id").alias("node")), "node", "left_semi")
    names = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    named = stored(linked.join(names, "label").select("node", "component_id"), "named")
    alone = labelled.join(named, "node", "left_anti").select("node", F.col("least").alias("component_id"))
    by_node = named.union(alone)
    return items.join(by_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _meetings(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``a, b, code, two`` of the codes that several nodes share (two: only ``a`` and ``b`` do), and
    ``code, node, degree`` of all members of the others; the degree is the node's number of them."""
    rows = signed.where("node is not null").select("node", F.explode("codes").alias("code"))
    # a code of one node, of two, or of more: of two nodes all bits are in their OR and AND
    two = (F.col("any") == F.col("a").bitwiseOR(F.col("b"))) & (F.col("all") == F.col("a").bitwiseAND(F.col("b")))
    turns = []
    for k in range(TURNS):
        found = (
            rows.where(F.pmod("code", F.lit(TURNS)) == k)
            .groupBy("code")
            .agg(F.min("node").alias("a"), F.max("node").alias("b"), F.bit_or("node").alias("any"), F.bit_and("node").alias("all"))
            .where(F.col("a") < F.col("b"))
        )
        turns.append(stored(found.select("code", "a", "b", two.alias("two")), "met"))
    met = reduce(DataFrame.union, turns)
    crowded = met.where("not two").select("code")
    maybe = bloom.build(crowded, "code").split(rows, "code").where("_maybe").select("node", "code")
    members = stored(maybe.join(crowded, "code").distinct(), "members")
    return met, stored(members.join(members.groupBy("node").agg(F.count("*").alias("degree")), "node"), "ranked")


def _with_earlier(rows: DataFrame) -> DataFrame:
    """``rows(code, node, ...)`` with up to ``EARLIER`` codes of the node just below this one, as ``earlier``.
    Two members that share one of these meet there, or at a lower one still, and need not meet at this one:
    at the lowest code that two have in common they share none."""
    below = Window.partitionBy("node").orderBy("code").rowsBetween(-EARLIER, -1)
    return rows.withColumn("earlier", F.collect_list("code").over(below))


def _meet(first: DataFrame, known: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the members ``first`` and those of ``known`` (``code, node, degree, label``) that come after
    them in a code, with different labels, and may be similar."""
    columns = ["label", "degree", "earlier", "n", "sketch"]

    def side(rows: DataFrame, key: str) -> DataFrame:
        sized = _with_earlier(rows).join(_compared(small).withColumnRenamed("id", "node"), "node")
        return sized.select("code", F.col("node").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in columns])

    # a pair meets from one side, the same in every code
    after = F.struct("degree_b", "b") < F.struct("degree_a", "a")
    differ = (F.col("label_a") != F.col("label_b")) & after & _may_be_similar(percent)
    met = side(known, "b").join(side(first, "a"), "code").where(differ & ~F.arrays_overlap("earlier_a", "earlier_b"))
    # large codes are cut into pieces of both sides: few tasks take several, or the driver keeps account of thousands
    return met.select("a", "b").coalesce(int(small.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _link(met: DataFrame, members: DataFrame, items: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """``id, label`` of every node with a link."""
    tops = members.groupBy("code").agg(F.max_by("node", F.struct("degree", "node")).alias("top"))
    star = members.join(tops, "code").where(F.col("node") != F.col("top")).select(F.least("node", "top").alias("a"), F.greatest("node", "top").alias("b"))
    pairs = stored(met.where("two").select("a", "b").union(star).distinct(), "pairs")
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = stored(_sets_of(items, source, ids), "shingle_sets")
    small = sets.select("id", "n", "sketch")
    threshold = percent / 100

    def verified(found: DataFrame) -> DataFrame:
        return stored(similar(stored(found.distinct(), "candidates"), sets, threshold), "links")

    likely = pairs.join(_sided(small, "a"), "a").join(_sided(small, "b"), "b").where(_may_be_similar(percent))
    links = verified(likely.select("a", "b"))
    labels = components(links)
    # the first member of each code has met all others above
    compared, hubs, left = 1, HUBS, members
    while True:
        known = left.join(labels.withColumnRenamed("id", "node"), "node", "left").select("code", "node", "degree", F.coalesce("label", "node").alias("label"))
        state = known.groupBy("code").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("members"))
        still = state.where((F.col("lo") < F.col("hi")) & (F.col("members") > compared)).select("code")
        known = stored(known.join(still, "code"), "open")
        if known.isEmpty():
            return labels
        left = known.select("code", "node", "degree")
        order = Window.partitionBy("code").orderBy(F.desc("degree"), F.desc("node"))
        ranked = known.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= hubs)
        # the first `compared` members have met all others
        first = ranked.where(F.col("rank") > compared)
        near = _meet(first, known, small, percent)
        more = verified(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        if not more.isEmpty():
            links = stored(links.union(more), "links")
            labels = components(links)
        compared, hubs = hubs, hubs * 8


def _sets_of(items: DataFrame, source: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, n, grams, sketch`` of the given nodes, from one text of each; texts without a wanted node
    stay out of the shuffle."""
    wanted = items.join(ids, items["node"] == ids["id"]).groupBy("id").agg(F.min("text_hash").alias("text_hash"))
    wanted = stored(wanted, "wanted")
    own = bloom.build(wanted, "text_hash").split(source, "text_hash").where("_maybe").select("text_hash", "text")
    found = own.dropDuplicates(["text_hash"]).join(wanted, "text_hash").select("id", "text")
    made = found.mapInPandas(releasing(_grams), "id long, node long, n long, grams array<long>, sketch array<long>")
    return made.where("id = node").select("id", "n", "grams", "sketch")


def op11_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of shingles and its component."""
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
  FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*)::BIGINT AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""
