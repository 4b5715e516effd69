"""From colliding bands to connected components, as joins and grouped aggregates.

Members of a bucket are first compared with a few members, the smallest by different hashes. Buckets whose members
then lie in one component are done; in the others members of different components are compared
too, in the first band that they share, by 1,024-bit sketches whose error lets a similar pair go
once in 2,000; what passes is verified like the rest. Intermediate tables are written to the shared
folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators import bloom

from .common import stored
from .textbytes import SKETCH_WORDS, most_different_bits


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links(a, b)``: the smallest id that it is connected with.
    Smallest labels move along links and, by way of the old labels, along whole chains."""
    both = stored(
        links.select("a", "b").union(links.select("b", "a")).toDF("a", "b").distinct(), "links"
    )
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        moved = stored(
            labels.join(near, labels["id"] == near["a"], "left").select(
                "id", "label", F.least("label", "near").alias("new")
            ),
            "moved",
        )
        if moved.where(F.col("new") < F.col("label")).isEmpty():
            return labels
        roots = moved.groupBy(F.col("label").alias("root")).agg(F.min("new").alias("root_new"))
        hooked = moved.join(roots, F.col("label") == F.col("root"))
        labels = stored(
            hooked.select("id", F.least("new", "root_new").alias("label")), "labels"
        )


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets ``id, grams`` (distinct values) have a Jaccard similarity
    of at least ``threshold``. Sets without a pair stay out of the shuffles; ``pairs`` is a stored table."""

    def side(key: str, name: str) -> DataFrame:
        rows = sets.select(F.col("id").alias(key), F.col("grams").alias(name))
        return bloom.build(pairs, key).split(rows, key).where("_maybe").drop("_maybe")

    one, two = side("a", "x"), side("b", "y")
    joined = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("x", "y"))
    return (
        joined.select("a", "b", common.alias("n"), (F.size("x") + F.size("y")).alias("total"))
        .where(F.col("n") >= threshold * (F.col("total") - F.col("n")))
        .select("a", "b")
    )


def link_buckets(
    items: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: float = 0.8, n_hubs: int = 1
) -> DataFrame:
    """``id, label`` of all ids with a verified link. ``items``: ``id`` (long) and ``bands`` (array of
    codes); repeated rows do no harm. ``sets_of`` gets the ids that collide with another one and
    returns their sets, ``id, grams, sketch``."""
    rows = items.select("id", F.posexplode("bands").alias("band", "code"))
    # most codes have one id: two columns a code tell, and only the rest is gathered
    shared = stored(
        rows.groupBy("band", "code")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where(F.col("least") < F.col("most"))
        .select("band", "code"),
        "shared",
    )
    maybe = bloom.build(shared, "band", "code").split(rows, "band", "code").where("_maybe").drop("_maybe")
    gathered = stored(maybe.join(shared, ["band", "code"]).distinct(), "gathered")
    hubs = gathered.groupBy("band", "code").agg(
        F.array_distinct(F.array(*[F.min_by("id", F.xxhash64("id", F.lit(k))) for k in range(n_hubs)])).alias("hubs")
    )
    members = stored(gathered.join(hubs, ["band", "code"]).select("band", "code", "id", "hubs"), "members")
    pairs = members.select("id", F.explode("hubs").alias("hub")).where(F.col("id") != F.col("hub"))
    first = stored(pairs.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct(), "pairs")
    ids = stored(members.select("id").distinct(), "ids")
    sets = stored(sets_of(ids), "sets")
    found = stored(similar(first, sets, threshold), "found")
    labels = components(found)
    known = members.join(labels, "id", "left").select(
        "band", "code", "id", F.coalesce("label", "id").alias("label")
    )
    open_keys = (
        known.groupBy("band", "code")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where(F.col("lo") < F.col("hi"))
        .select("band", "code")
    )
    unlinked = stored(known.join(open_keys, ["band", "code"]), "unlinked")
    bands = items.join(unlinked.select("id").distinct(), "id", "left_semi").select("id", "bands").dropDuplicates(["id"])
    left = stored(unlinked.join(bands, "id").join(sets.select("id", "sketch"), "id"), "open")

    def side(k: str) -> DataFrame:
        return left.select("band", "code", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "label", "bands", "sketch")])

    n = len(items.select("bands").head()["bands"]) if not left.isEmpty() else 1
    rest = (
        side("a")
        .join(side("b"), ["band", "code"])
        .where((F.col("label_a") < F.col("label_b")) & _first_shared(n) & (_different_bits() <= most_different_bits(threshold)))
        .select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b"))
        .join(first, ["a", "b"], "left_anti")
    )
    more = stored(similar(stored(rest, "rest"), sets, threshold), "more")
    if more.isEmpty():
        return labels
    return components(found.union(more))


def _first_shared(n: int) -> Column:
    """Whether no earlier one of ``n`` bands holds both members: each pair then comes up once."""
    out = F.lit(True)
    for k in reversed(range(n - 1)):
        differ = F.get("bands_a", F.lit(k)) != F.get("bands_b", F.lit(k))
        out = (F.col("band") == k) | (differ & out)
    return out


def _different_bits() -> Column:
    out = F.lit(0)
    for k in range(SKETCH_WORDS):
        out = out + F.bit_count(F.get("sketch_a", F.lit(k)).bitwiseXOR(F.get("sketch_b", F.lit(k))))
    return out
