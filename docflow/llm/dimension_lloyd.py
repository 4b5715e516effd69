"""Lloyd's clustering sharded by dimensions.

Vectors are cut into chunks of rows and column blocks; one shard is one block of one chunk. A round
takes the distances of every shard to its slice of the centroids, adds the blocks of a chunk by its
key, takes the argmin, and sums each block's columns by cluster, so that every block updates its own
slice of the centroids. Components are integers, so all sums are exact and do not depend on
order. Shards and partial distances travel packed, in the smallest integer type that holds them.

What reaches the driver are the centroids alone, K x D integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
BLOCK = 32
CHUNK = 1024
# Beyond this a squared distance over 64 dimensions does not fit in a long.
LARGEST = 2**27
# Centroids go to every task; so many components at most (8 bytes each).
MAX_MODEL = 4_000_000

_TYPES = {t.__name__: t for t in (np.int8, np.int16, np.int32, np.int64)}


def pack(values: np.ndarray) -> tuple[str, bytes]:
    """The values in the smallest integer type, with its name."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for name, kind in _TYPES.items():
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return name, values.astype(kind).tobytes()
    raise OverflowError("no integer type holds the values")


def unpack(kind: str, raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=_TYPES[kind]).reshape(-1, width).astype(np.int64)


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the vectors with ``dimensions`` components, all of them numbers: the integers
    floor(scale * component)."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).where(F.size("v") == dimensions)
    doubles = rows.select("vec_id", F.transform("v", lambda c: c.cast("double")).alias("v"))
    numbers = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    small = F.forall("v", lambda c: F.abs(c) * scale < LARGEST)
    # one condition: separate filters could be tested in another order, the error before the rest
    kept = F.when(~F.coalesce(numbers, F.lit(False)), False).when(small, True).otherwise(F.raise_error(F.lit("a component is too large for long distances")).cast("boolean"))
    return doubles.where(kept).select("vec_id", F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c)).alias("x"))


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``1:<vec_id>``, in that order; equal ids by their
    components, null ids last."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    found = rows.select(key.alias("key"), "x").orderBy(F.asc_nulls_last("key"), "x").limit(k).collect()
    return np.array([r["x"] for r in found], dtype=np.int64)


def shards(rows: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``chunk, block, kind, data, ids``: one row a column block of up to ``chunk`` vectors. The ids go
    with block 0. Chunk numbers hold the task and are final once the table is written."""
    id_kind = rows.schema["vec_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for frame in frames:
            for a in range(0, len(frame), chunk):
                part = frame.iloc[a : a + chunk]
                x = np.stack(part["x"].to_numpy()).astype(np.int64)
                ids = [None if pd.isna(i) else i for i in part["vec_id"].tolist()]
                made = [(number, b, *pack(x[:, c : c + block]), ids if b == 0 else None) for b, c in enumerate(range(0, x.shape[1], block))]
                number += 1
                yield pd.DataFrame(made, columns=["chunk", "block", "kind", "data", "ids"])

    return rows.mapInPandas(run, f"chunk long, block int, kind string, data binary, ids array<{id_kind}>")


def partial_distances(parts: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """The shards with ``pkind, partial``: the squared distances of their rows to their slice of each
    centroid."""
    k = len(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for b, kind, raw in zip(frame["block"], frame["kind"], frame["data"], strict=True):
                own = centroids[:, b * block : (b + 1) * block]
                x = unpack(kind, raw, own.shape[1])
                far = np.empty((len(x), k), dtype=np.int64)
                for j in range(k):
                    d = x - own[j]
                    far[:, j] = (d * d).sum(axis=1)
                made.append(pack(far))
            yield frame.assign(pkind=[p for p, _ in made], partial=[d for _, d in made])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return parts.mapInPandas(run, f"{kinds}, pkind string, partial binary")


def _nearest(group: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number and distance of each row's nearest centroid, the smallest number first."""
    total = sum(unpack(p, d, k) for p, d in zip(group["pkind"], group["partial"], strict=True))
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def update(parts: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """One round: the blocks of a chunk are added by its key, and each block sums its own columns by
    cluster; clusters without vectors stay."""
    k, width = centroids.shape

    def assigned(group: pd.DataFrame) -> pd.DataFrame:
        cluster, _ = _nearest(group, k)
        counts = np.bincount(cluster, minlength=k)
        out = []
        for b, kind, raw in zip(group["block"], group["kind"], group["data"], strict=True):
            x = unpack(kind, raw, min(block, width - b * block))
            sums = np.zeros((k, x.shape[1]), dtype=np.int64)
            np.add.at(sums, cluster, x)
            out += [(b, j, int(counts[j]), sums[j]) for j in range(k) if counts[j]]
        return pd.DataFrame(out, columns=["block", "cluster", "n", "sums"])

    far = partial_distances(parts, centroids, block).select("chunk", "block", "kind", "data", "pkind", "partial")
    own = far.groupBy("chunk").applyInPandas(assigned, "block int, cluster int, n long, sums array<long>")
    total = F.col("total")
    slices = (
        own.select("block", "cluster", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("block", "cluster", "at")
        .agg(F.sum("s").alias("total"), F.sum("n").alias("n"))
        .select("block", "cluster", "at", F.expr("(total - pmod(total, n)) div n").alias("mean"))
    )
    out = centroids.copy()
    for r in slices.collect():  # at most K x D rows
        out[r["cluster"], r["block"] * block + r["at"]] = r["mean"]
    return out


def cluster_vectors(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    block: int = BLOCK,
    chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector with
    ``dimensions`` finite components.

    Null vectors, vectors of another length, and vectors with a null, NaN or infinite component are
    left out. Repeated rows and null ids are vectors like others. With fewer vectors than ``k``
    each is a centroid at first; an empty table gives no rows. Other columns are ignored.
    Distances are longs: components beyond 2^27 in size raise an error."""
    if k * dimensions > MAX_MODEL:
        raise ValueError(f"more than {MAX_MODEL} centroid components")
    rows = whole_vectors(vectors, vec_id, embedding, dimensions, scale)
    parts = stored(shards(rows, block, chunk), "shards")
    centroids = first_centroids(rows, k)
    id_kind = vectors.schema[vec_id].dataType.simpleString()
    if not len(centroids):
        none = f"vec_id {id_kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], none)
    for _ in range(rounds):
        centroids = update(parts, centroids, block)
    n = len(centroids)

    def assigned(group: pd.DataFrame) -> pd.DataFrame:
        cluster, distance = _nearest(group, n)
        ids = next(i for i in group["ids"] if i is not None)
        return pd.DataFrame({"vec_id": pd.Series(list(ids), dtype=object), "cluster": cluster, "distance": distance})

    far = partial_distances(parts, centroids, block).select("chunk", "ids", "pkind", "partial")
    found = stored(far.groupBy("chunk").applyInPandas(assigned, f"vec_id {id_kind}, cluster int, distance long"), "assigned")
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    digest = F.element_at(F.array(*[F.lit(s) for s in names]), F.col("cluster") + 1)
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in by_cluster.collect()}  # at most k rows
    own = F.element_at(F.array(*[F.lit(sums.get(j, 0)).cast("long") for j in range(n)]), F.col("cluster") + 1)
    return found.select(
        "vec_id", "cluster", "distance", own.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), digest.alias("centroid_sha256")
    )


def op12_dimension_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its cluster after three rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _round(number: int) -> str:
    old, new = f"c{number}", f"c{number + 1}"
    return f"""
a{number} AS MATERIALIZED (SELECT v.r, v.vec_id, v.x, c.k, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS d,
       row_number() OVER (PARTITION BY v.r ORDER BY d, c.k) AS place FROM v, {old} c),
u{number} AS (SELECT k, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS n FROM a{number}, range(1, 65) t(i) WHERE place = 1 GROUP BY k, i),
m{number} AS (SELECT k, list(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END ORDER BY i) AS x FROM u{number} GROUP BY k),
{new} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM {old} c LEFT JOIN m{number} m USING (k)),"""


ORACLE = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c::DOUBLE))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), x) - 1 AS k, x FROM v QUALIFY k < 16),
{"".join(_round(i) for i in range(ROUNDS))}
a{ROUNDS} AS (SELECT v.r, v.vec_id, c.k, c.x AS cx, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS d,
       row_number() OVER (PARTITION BY v.r ORDER BY d, c.k) AS place FROM v, c{ROUNDS} c)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(cx, ',')) AS centroid_sha256
FROM a{ROUNDS} WHERE place = 1
"""
