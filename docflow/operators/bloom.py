"""A Bloom filter as a table: built by one grouped aggregation, applied by one broadcast join.

A key sets two bits in each of the four 64-bit words of one block, so a test reads one row. The
number of blocks is bounded, and with it what is broadcast; a fuller filter lets more rows
through, never fewer, and callers finish with an exact join. Filters of one size merge by OR, so a
stored filter takes new keys batch by batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 4
BITS_PER_KEY = 16
# 2^18 blocks of 32 bytes: 8 MB of bits, some 25 MB as a broadcast hash table. Room for four million
# keys at BITS_PER_KEY.
MAX_BLOCKS = 1 << 18

_W = [f"w{i}" for i in range(WORDS)]


def _block(keys: list[Column], n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(11)), F.lit(n_blocks)).cast("int")


def _masks(keys: list[Column]) -> list[Column]:
    """Two bits of each word, taken from 12 bits of a second hash."""
    h = F.xxhash64(*keys, F.lit(23))

    def bit(k: int) -> Column:
        at = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), at)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(WORDS)]


@dataclass
class BloomFilter:
    """``bits``: a table ``block, w0..w3``; blocks without a key are absent."""

    bits: DataFrame
    n_blocks: int

    def split(self, rows: DataFrame, *keys: str) -> DataFrame:
        """``rows`` with ``_maybe``: false for keys that are surely not in the filter."""
        cols = [F.col(k) for k in keys]
        tagged = rows.withColumn("_block", _block(cols, self.n_blocks))
        bits = self.bits.select(F.col("block").alias("_b"), *[F.col(w).alias(f"_{w}") for w in _W])
        held = F.lit(True)
        for w, m in zip(_W, _masks(cols), strict=True):
            held = held & (F.col(f"_{w}").bitwiseAND(m) == m)
        joined = tagged.join(F.broadcast(bits), F.col("_block") == F.col("_b"), "left")
        return joined.withColumn("_maybe", F.coalesce(held, F.lit(False))).drop("_block", "_b", *[f"_{w}" for w in _W])

    def merge(self, other: BloomFilter) -> BloomFilter:
        if self.n_blocks != other.n_blocks:
            raise ValueError("only filters with the same number of blocks merge")
        return BloomFilter(_or(self.bits.unionByName(other.bits)), self.n_blocks)

    def save(self, path: str) -> None:
        """Write the filter; the number of blocks goes with every row, and one row always exists."""
        spark = self.bits.sparkSession
        none = spark.range(1).select(F.lit(0).alias("block"), *[F.lit(0).cast("long").alias(w) for w in _W])
        whole = _or(self.bits.unionByName(none))
        whole.withColumn("n_blocks", F.lit(self.n_blocks)).write.mode("overwrite").parquet(path)


def _or(bits: DataFrame) -> DataFrame:
    return bits.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _W])


def build(rows: DataFrame, *keys: str, n_blocks: int | None = None, max_blocks: int = MAX_BLOCKS) -> BloomFilter:
    """The filter of the key columns of ``rows``: partial aggregates first, then one row a block is
    shuffled by every task. Without ``n_blocks`` the rows are counted for its size. Nulls are keys like
    others (equal to each other), as in a null-safe join."""
    if n_blocks is None:
        n_blocks = blocks_for(rows.count(), max_blocks)
    cols = [F.col(k) for k in keys]
    bits = rows.select(_block(cols, n_blocks).alias("block"), *[m.alias(w) for w, m in zip(_W, _masks(cols), strict=True)])
    return BloomFilter(_or(bits), n_blocks)


def blocks_for(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    return max(1, min(max_blocks, -(-n_keys * BITS_PER_KEY // (64 * WORDS))))


def load(spark: SparkSession, path: str) -> BloomFilter:
    whole = spark.read.parquet(path)
    return BloomFilter(whole.drop("n_blocks"), whole.select("n_blocks").first()["n_blocks"])


def anti_join(rows: DataFrame, gone: DataFrame, keys: list[str], filt: BloomFilter | None = None) -> DataFrame:
    """``rows`` whose keys (null-safe) are not in ``gone``, a stored table with columns of the same
    names. Rows that the filter rules out skip the shuffle; only the others are joined."""
    filt = filt or build(gone, *keys)
    cols = rows.columns
    tagged = filt.split(rows, *keys)
    known = gone.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_g{i}"))
    surely = tagged.where(~F.col("_maybe")).select(*cols)
    return surely.unionByName(tagged.where("_maybe").join(known, same, "left_anti").select(*cols))
